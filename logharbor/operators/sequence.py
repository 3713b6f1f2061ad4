"""Numbering of log windows: choice of file, resume position, gaps, readiness, offsets.

A *log window* is one rotated file with a sequence number, not a time window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logharbor.operators.skew import lookup, previous_value, running_total
from logharbor.schemas import STREAM, WINDOW

# Sequence numbers, or lines, that one task compares as a unit.
SEQUENCE_BUCKET = 4096
LINE_BUCKET = 65536


def prefer_plain(windows: DataFrame) -> DataFrame:
    """One file per window: the plain one if the compressed one exists as well."""
    others = [c for c in windows.columns if c not in WINDOW]
    chosen = windows.groupBy(*WINDOW).agg(F.min_by(F.struct(*others), "is_gz").alias("_file"))
    return chosen.select(*WINDOW, "_file.*").select(windows.columns)


def attach_cursors(rows: DataFrame, cursors: DataFrame) -> DataFrame:
    """Add ``start_index`` and ``start_offset``, where the stream of each window or line
    resumes.

    A stream without cursor, or whose cursor names no window yet, starts at window 1.
    """
    index = F.coalesce("file_index", F.lit(0)).cast("bigint")
    spread_by = [c for c in ("window_sequence", "line_no") if c in rows.columns]
    known = lookup(rows, cursors.select(*STREAM, "file_index", "read_offset"), STREAM, spread_by)
    return known.withColumns({
        "start_index": F.greatest(F.lit(1).cast("bigint"), index),
        "start_offset": F.when(index >= 1, F.coalesce("read_offset", F.lit(0)))
        .otherwise(F.lit(0))
        .cast("bigint"),
    }).drop("file_index", "read_offset")


def resume_windows(windows: DataFrame, cursors: DataFrame) -> DataFrame:
    """Windows not yet sent completely. Applied to the catalog, so that skipped windows
    are never opened."""
    return attach_cursors(windows, cursors).where("window_sequence >= start_index")


def resume_lines(lines: DataFrame, cursors: DataFrame | None = None) -> DataFrame:
    """Lines from the resume position on; lines come with ``byte_start``.

    Inside the window in progress only whole lines from the offset on are kept.
    """
    if cursors is not None:
        lines = attach_cursors(lines, cursors)
    return lines.where(
        "window_sequence > start_index"
        " or (window_sequence = start_index and byte_start >= start_offset)"
    )


def _sequences(windows: DataFrame, done: DataFrame | None) -> DataFrame:
    """Distinct sequence numbers from the resume index on, present or settled before."""
    found = windows.select(*WINDOW)
    if done is not None:
        found = found.unionByName(done.select(*WINDOW))
    return found.distinct()


def sequence_gaps(
    windows: DataFrame, cursors: DataFrame | None = None, done: DataFrame | None = None
) -> DataFrame:
    """Missing ranges of sequence numbers from the resume index up to the last window."""
    found = _sequences(windows, done)
    if cursors is not None:
        found = resume_windows(found, cursors).drop("start_offset")
    else:
        found = found.withColumn("start_index", F.lit(1).cast("bigint"))
    linked = previous_value(found, STREAM, "window_sequence", "_previous", SEQUENCE_BUCKET)
    before = F.coalesce(F.col("_previous"), F.col("start_index") - 1)
    return linked.where(F.col("window_sequence") - before > 1).select(
        *STREAM,
        (before + 1).alias("gap_from"),
        (F.col("window_sequence") - 1).alias("gap_to"),
    )


def ready_prefix(
    windows: DataFrame, cursors: DataFrame, done: DataFrame | None = None
) -> DataFrame:
    """Windows that may be processed now: the gap-free run from the resume index on.

    Windows in ``done`` (acknowledged, payload gone) fill gaps. Windows after the first
    missing number are held back.
    """
    pending = resume_windows(windows, cursors)
    found = pending if done is None else pending.select(*WINDOW, "start_index").unionByName(
        resume_windows(done.select(*WINDOW), cursors).select(*WINDOW, "start_index"))
    # The first number missing is the start or follows one that is there.
    here, number = F.struct(F.col("window_sequence").alias("at"), F.lit(True).alias("here")), F.lit(False).alias("here")
    after = [F.struct(c.alias("at"), number) for c in (F.col("window_sequence") + 1, F.col("start_index"))]
    numbers = found.select(*STREAM, F.explode(F.array(here, *after)).alias("_n")).select(*STREAM, "_n.*")
    missing = numbers.groupBy(*STREAM, "at").agg(F.max("here").alias("here")).where(~F.col("here"))
    first = missing.groupBy(*STREAM).agg(F.min("at").alias("first_missing"))
    held = lookup(pending, first, STREAM, ["window_sequence"])
    return held.where("window_sequence < first_missing").drop("first_missing")


def tombstone_skip(windows: DataFrame, acked: DataFrame) -> DataFrame:
    """Status of each known sequence number: a payload to send, or one that is done
    because its payload is gone after its acknowledgement."""
    present = windows.select(*WINDOW).distinct().withColumn("_present", F.lit(True))
    settled = acked.select(*WINDOW).distinct().withColumn("_acked", F.lit(True))
    return present.join(settled, WINDOW, "full").select(
        *WINDOW, F.when(F.col("_present"), "present").otherwise("done").alias("status")
    )


def blocked_streams(streams: DataFrame, cursors: DataFrame, losses: DataFrame) -> DataFrame:
    """Streams whose current window already has a loss record; without cursor that is window 1."""
    known = streams.select(*STREAM).union(cursors.select(*STREAM)).distinct()
    start = F.greatest(F.lit(1), F.coalesce("file_index", F.lit(0))).cast("bigint")
    current = known.join(cursors.select(*STREAM, "file_index"), STREAM, "left").select(*STREAM, start.alias("window_sequence"))
    return current.join(losses.select(*WINDOW).distinct(), WINDOW, "left_semi").select(*WINDOW)


def unreadable_sessions(files: DataFrame, windows: DataFrame) -> DataFrame:
    """Sessions with log files none of which carries a readable number."""
    keys = ["folder", "session_id"]
    return files.select(*keys).distinct().join(windows.select(*keys).distinct(), keys, "left_anti")


def line_offsets(lines: DataFrame) -> DataFrame:
    """Add ``byte_start`` and ``byte_end`` of each line within its window.

    Lines end with a newline; a last line without one has ``terminated`` = false.
    """
    size = F.octet_length("line").cast("bigint")
    ended = (
        F.col("terminated").cast("int") if "terminated" in lines.columns else F.lit(1)
    )
    summed = running_total(lines, WINDOW, "line_no", size + ended, "byte_end", LINE_BUCKET)
    return summed.withColumn("byte_start", F.col("byte_end") - size - ended)


def line_order(lines: DataFrame) -> DataFrame:
    """Lines in delivery order: sessions by name, windows by number, lines as written."""
    return lines.orderBy(*WINDOW, "line_no")
