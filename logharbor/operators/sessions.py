"""Session discovery, liveness and outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logharbor.functions.checks import since_cutoff, tmp_is_stale
from logharbor.functions.paths import is_hidden
from logharbor.schemas import (
    CHANNEL_FILE,
    CHANNELS,
    FAILED_MARKER,
    FLAT_FILE,
    SESSION,
    SESSION_END_GRACE_MS,
    SESSION_SIDECAR,
    TMP_DIR,
    UPLOADED_MARKER,
)


def union_sources(*ranked: DataFrame) -> DataFrame:
    """Source folders from several settings; the first setting of a folder wins.

    Each frame has ``folder``, ``log_types`` and ``position`` within its setting.
    """
    parts = [df.withColumn("_rank", F.struct(F.lit(n).alias("setting"), "position"))
             for n, df in enumerate(ranked)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    types = F.when(
        F.coalesce(F.size("log_types"), F.lit(0)) > 0, F.col("log_types")
    ).otherwise(F.array(*map(F.lit, CHANNELS)))
    return merged.groupBy("folder").agg(F.min_by(types, "_rank").alias("log_types"))


def drop_hidden_dirs(dirs: DataFrame, name: str = "session_id") -> DataFrame:
    return dirs.where(~is_hidden(F.col(name)))


def legacy_flat_files(entries: DataFrame) -> DataFrame:
    """Folders that hold old flat log files, with the first such file of each."""
    flat = entries.where("rel_dir = '' and not is_dir").where(F.col("name").rlike(FLAT_FILE))
    return flat.groupBy("folder").agg(F.min("name").alias("file_name"))


def _candidate_dirs(entries: DataFrame, producer: str | None) -> DataFrame:
    """Directories at depth one or two that directly hold a channel file or a sidecar."""
    sidecar = F.col("name").rlike(SESSION_SIDECAR)
    if producer is not None:
        sidecar = sidecar & F.col("name").startswith(f".{producer}-")
    evidence = ~F.col("is_dir") & (F.col("name").rlike(CHANNEL_FILE) | sidecar)
    settled = ~F.col("is_dir") & F.col("name").isin(UPLOADED_MARKER, FAILED_MARKER)
    return (
        entries.where("rel_dir <> ''")
        .groupBy("folder", "rel_dir")
        .agg(F.bool_or(evidence).alias("is_session"), F.bool_or(settled).alias("settled"))
        .where("is_session")
        .withColumn("_parts", F.split("rel_dir", "/"))
        .where(F.size("_parts") <= 2)
        .where(~F.exists("_parts", lambda part: part.startswith(".")))
    )


def session_catalog(
    entries: DataFrame, sources: DataFrame | None = None, producer: str | None = None
) -> DataFrame:
    """Sessions below the source folders: ``<folder>/<session>``, or one level deeper below
    a directory that is not itself a session.

    ``folder`` of the result is the session's parent directory. With ``producer``, a sidecar
    shows a session only if it carries that name.
    """
    found = _candidate_dirs(entries, producer)
    flat = found.where(F.size("_parts") == 1)
    nested = found.where(F.size("_parts") == 2).withColumn("_group", F.col("_parts")[0])
    taken = flat.select("folder", F.col("rel_dir").alias("_group"))
    nested = nested.join(taken, ["folder", "_group"], "left_anti")
    catalog = flat.select(
        F.col("folder").alias("source"), "folder", F.col("rel_dir").alias("session_id"), "settled"
    ).unionByName(
        nested.select(
            F.col("folder").alias("source"),
            F.concat_ws("/", "folder", "_group").alias("folder"),
            F.col("_parts")[1].alias("session_id"),
            "settled",
        )
    )
    if sources is None:
        return catalog.withColumn("log_types", F.array(*map(F.lit, CHANNELS)))
    from logharbor.operators.skew import lookup

    types = sources.select(F.col("folder").alias("source"), "log_types")
    return lookup(catalog, types, ["source"], ["session_id"], how="inner")


def pending_sessions(sessions: DataFrame, settled: DataFrame) -> DataFrame:
    return sessions.join(settled.select(*SESSION).distinct(), SESSION, "left_anti")


def new_sessions(sessions: DataFrame, started: DataFrame) -> DataFrame:
    """Sessions that no earlier round has started, each once."""
    return sessions.dropDuplicates(SESSION).join(
        started.select(*SESSION).distinct(), SESSION, "left_anti"
    )


def sessions_with_loss(sessions: DataFrame, losses: DataFrame) -> DataFrame:
    """Sessions with a loss record, and those whose directory could not be read."""
    lost = losses.select(*SESSION).distinct().withColumn("_lost", F.lit(True))
    unread = ~F.coalesce(F.col("readable"), F.lit(False)) if "readable" in sessions.columns else F.lit(False)
    return (
        sessions.join(lost, SESSION, "left")
        .where(F.coalesce("_lost", F.lit(False)) | unread)
        .select(sessions.columns)
    )


def tmp_newest_mtime(entries: DataFrame) -> DataFrame:
    """Newest change of each session's working directory and its direct entries."""
    own = F.when(F.col("is_dir") & (F.col("name") == TMP_DIR), F.col("rel_dir"))
    child = F.when(
        F.element_at(F.split("rel_dir", "/"), -1) == TMP_DIR,
        F.regexp_replace("rel_dir", r"/?\.tmp$", ""),
    )
    return (
        entries.withColumn("session_dir", F.coalesce(own, child))
        .where("session_dir is not null")
        .groupBy("folder", "session_dir")
        .agg(F.max("mtime_ms").alias("tmp_mtime_ms"))
    )


def channel_state(channels: DataFrame, now_ms: Column) -> DataFrame:
    """State of each channel whose ready windows are all sent, or not.

    Uses ``has_failure``, ``next_present``, ``tmp_present``, ``tmp_mtime_ms``,
    ``owner_state`` and ``quiet_since_ms``, since when nothing new has been seen.
    """
    owned = F.col("owner_state").isin("ACTIVE", "UNKNOWN")
    stale = F.coalesce(tmp_is_stale(now_ms, F.col("tmp_mtime_ms")), F.lit(False))
    rested = (now_ms - F.col("quiet_since_ms")) >= SESSION_END_GRACE_MS
    state = (
        F.when(F.col("has_failure"), "finished_orphaned")
        .when(F.col("next_present"), "draining")
        .when(owned, "waiting")
        .when(F.col("tmp_present") & ((F.col("owner_state") == "UNOWNED") | stale), "finished_orphaned")
        .when(F.col("tmp_present"), "waiting")
        .when(rested, "finished_clean")
        .otherwise("waiting")
    )
    return channels.withColumn("state", state)


def session_completion(states: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions all of whose configured channels are finished, and whether any of them
    ended without the producer closing it."""
    per_channel = states.groupBy(*SESSION, "channel").agg(
        F.bool_and(F.col("state").startswith("finished")).alias("done"),
        F.bool_or(F.col("state") == "finished_orphaned").alias("orphaned"),
    )
    # A finished channel that isn't configured says nothing about one that is and still waits.
    configured = sessions.select(*SESSION, F.explode("log_types").alias("channel"))
    folded = configured.join(per_channel, [*SESSION, "channel"], "left").groupBy(*SESSION).agg(
        F.count_if(F.coalesce("done", F.lit(False))).alias("channels_done"),
        F.bool_or(F.coalesce("orphaned", F.lit(False))).alias("orphaned"),
    )
    readable = [c for c in ("readable",) if c in sessions.columns]
    return sessions.select(*SESSION, F.size("log_types").cast("bigint").alias("channels_expected"), *readable).join(
        folded, SESSION
    ).withColumn("complete", F.col("channels_done") >= F.col("channels_expected"))


def settle_sessions(
    completion: DataFrame, losses: DataFrame, stream_mode: bool = True, prune_failed: bool = False
) -> DataFrame:
    """Outcome of each complete session, and whether its completion is signalled.

    A session with loss has failed, is never pruned and never signalled; so has one whose directory could
    not be read (``readable``), as losses may lie in it. An orphaned one without loss has failed (or is
    pruned) but is signalled, as all its windows are sent.
    """
    lost = losses.select(*SESSION).distinct().withColumn("has_loss", F.lit(True))
    judged = completion.where("complete").join(lost, SESSION, "left").withColumn(
        "has_loss", F.coalesce("has_loss", F.lit(False))
    )
    if "readable" in completion.columns:
        judged = judged.withColumn("has_loss", F.col("has_loss") | ~F.coalesce("readable", F.lit(False)))
    outcome = (
        F.when(F.col("has_loss"), "failed")
        .when(F.col("orphaned"), "pruned" if prune_failed else "failed")
        .otherwise("uploaded")
    )
    return judged.select(
        *SESSION, "orphaned", "has_loss", outcome.alias("outcome"),
        (F.lit(stream_mode) & ~F.col("has_loss")).alias("complete_signal"),
    )


def any_active(sessions: DataFrame, now_ms: Column, since_ms: int = 0) -> DataFrame:
    """One row: whether some visible session within the cutoff is still being written."""
    live = (
        ~is_hidden(F.col("session_id"))
        & since_cutoff(F.col("mtime_ms"), since_ms)
        & F.col("tmp_present")
        & ~F.coalesce(tmp_is_stale(now_ms, F.col("tmp_mtime_ms")), F.lit(False))
    )
    return sessions.agg(F.coalesce(F.bool_or(live), F.lit(False)).alias("any_active"))


def drain_status(
    started: DataFrame, states: DataFrame, cleanup: DataFrame, sessions: DataFrame, now_ms: Column,
    since_ms: int = 0,
) -> DataFrame:
    """One row: whether a one-shot run may stop, with the four conditions it rests on."""
    parts = [
        started.agg((F.count("*") > 0).alias("started_any")),
        states.agg((F.count_if(~F.col("state").startswith("finished")) == 0).alias("channels_closed")),
        cleanup.agg((F.count("*") == 0).alias("cleanup_idle")),
        any_active(sessions, now_ms, since_ms),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    row = rows.agg(*[F.bool_or(c).alias(c) for c in rows.columns])
    return row.withColumn(
        "drained",
        F.col("started_any") & F.col("channels_closed") & F.col("cleanup_idle") & ~F.col("any_active"),
    )
