"""Settlement of sessions from the landing zone itself, poll by poll, with the clock as an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logharbor.operators.sequence import blocked_streams
from logharbor.operators.sessions import channel_state, tmp_newest_mtime
from logharbor.schemas import SESSION, STREAM
from logharbor.sources.landing import list_windows, scan_acks, scan_losses


def observed_channels(
    entries: DataFrame, sessions: DataFrame, cursors: DataFrame, owners: DataFrame, producer: str
) -> DataFrame:
    """What one listing shows of each configured channel of ``sessions``, as ``channel_state`` wants it.

    ``next_index`` is where the channel resumes; ``next_present`` says that this window's file or its
    acknowledgement is there. A session without a row in ``owners`` has the owner state UNKNOWN. A channel without
    any file counts too: it waits for window 1.
    """
    streams = sessions.select(*SESSION, F.explode("log_types").alias("channel")).distinct()
    index = F.greatest(F.lit(1), F.coalesce("file_index", F.lit(0))).cast("bigint")
    resumed = streams.join(cursors.select(*STREAM, "file_index"), STREAM, "left").select(*STREAM, index.alias("next_index"))
    acks = scan_acks(entries, producer)
    there = list_windows(entries).select(*STREAM, "window_sequence").union(acks.select(*STREAM, "window_sequence")).distinct()
    there = there.select(*STREAM, F.col("window_sequence").alias("next_index"), F.lit(True).alias("next_present"))
    failed = blocked_streams(streams, cursors, scan_losses(entries, producer)).select(*STREAM, F.lit(True).alias("has_failure"))
    path = F.concat_ws("/", "folder", "session_dir")
    working = tmp_newest_mtime(entries).select(
        F.regexp_replace(path, r"/[^/]*$", "").alias("folder"), F.element_at(F.split(path, "/"), -1).alias("session_id"),
        F.lit(True).alias("tmp_present"), "tmp_mtime_ms")
    rows = resumed.join(there, [*STREAM, "next_index"], "left").join(failed, STREAM, "left")
    rows = rows.join(working, SESSION, "left").join(owners.select(*SESSION, "owner_state").distinct(), SESSION, "left")
    no = F.lit(False)
    return rows.withColumns({
        **{c: F.coalesce(c, no) for c in ("next_present", "has_failure", "tmp_present")},
        "owner_state": F.coalesce("owner_state", F.lit("UNKNOWN")),
    })


def quiet_channels(channels: DataFrame, before: DataFrame | None, now_ms: Column) -> DataFrame:
    """Add ``quiet_since_ms``: since which poll the channel has shown no next window, working directory or owner.

    ``before`` holds the rows of the poll before; a channel that was quiet there, at the same window, keeps its
    time. Any sign of life in between starts the time anew, and a channel with one now has none.
    """
    quiet = ~F.col("next_present") & ~F.col("tmp_present") & ~F.col("owner_state").isin("ACTIVE", "UNKNOWN")
    if before is None:
        return channels.withColumn("quiet_since_ms", F.when(quiet, now_ms.cast("bigint")))
    kept = before.select(*STREAM, "next_index", F.col("quiet_since_ms").alias("_since"))
    known = channels.join(kept, [*STREAM, "next_index"], "left")
    return known.withColumn("quiet_since_ms", F.when(quiet, F.coalesce("_since", now_ms.cast("bigint")))).drop("_since")


def settlement_poll(
    entries: DataFrame,
    sessions: DataFrame,
    cursors: DataFrame,
    owners: DataFrame,
    producer: str,
    now_ms: Column,
    before: DataFrame | None = None,
) -> DataFrame:
    """State of each configured channel at this poll; store the rows and give them to the next as ``before``."""
    seen = observed_channels(entries, sessions, cursors, owners, producer)
    return channel_state(quiet_channels(seen, before, now_ms), now_ms)
