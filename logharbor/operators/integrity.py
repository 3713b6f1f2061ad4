"""Windows against their sidecars and acknowledgements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logharbor.functions.checks import checksum_ok, sidecar_is_valid
from logharbor.operators.sequence import attach_cursors, prefer_plain
from logharbor.schemas import SESSION, WINDOW

SIDECAR_COLUMNS = [
    "schema_version", "type", "window_id", "meta_session_id", "meta_channel",
    "meta_window_sequence", "payload_file", "payload_bytes", "payload_crc32",
]


def attach_sidecars(windows: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Every window with its sidecar, if there is one (``has_sidecar``).

    ``malformed`` tells a sidecar whose text could not be read.
    """
    flag = F.col("malformed") if "malformed" in sidecars.columns else F.lit(False)
    known = sidecars.select(
        *WINDOW, *SIDECAR_COLUMNS, flag.alias("malformed"), F.lit(True).alias("has_sidecar")
    )
    return windows.join(known, WINDOW, "left").withColumns({
        "has_sidecar": F.coalesce("has_sidecar", F.lit(False)),
        "malformed": F.coalesce("malformed", F.lit(False)),
    })


def acked_windows(sidecars: DataFrame, acks: DataFrame) -> DataFrame:
    """Sidecars whose own window id was acknowledged for their channel and number."""
    own = sidecars.where(
        (F.col("meta_channel") == F.col("channel"))
        & (F.col("meta_window_sequence") == F.col("window_sequence"))
    )
    return own.join(
        acks.select(*WINDOW, "window_id").distinct(), [*WINDOW, "window_id"], "left_semi"
    )


def cleanup_manifest(
    windows: DataFrame, sidecars: DataFrame, acks: DataFrame, archived: DataFrame | None = None
) -> DataFrame:
    """Which payloads may be deleted, and why the others are kept.

    Only a compressed payload whose valid sidecar was acknowledged by its own id may go.
    With ``archived``, the rows that ``archive_windows`` gave, its copy must be there too.
    """
    acked = acked_windows(sidecars, acks).select(*WINDOW, F.lit(True).alias("acked"))
    judged = attach_sidecars(windows, sidecars).join(acked, WINDOW, "left")
    if archived is None:
        judged = judged.withColumn("_copied", F.lit(True))
    else:
        whole = archived.where(F.col("status").isin("copied", "present")).select(*WINDOW).distinct()
        judged = judged.join(whole.withColumn("_copied", F.lit(True)), WINDOW, "left")
    reason = (
        F.when(~F.col("is_gz"), "not_compressed")
        .when(~F.col("has_sidecar"), "no_sidecar")
        .when(~sidecar_is_valid(), "sidecar_mismatch")
        .when(F.col("acked").isNull(), "not_acknowledged")
        .when(F.col("_copied").isNull(), "not_archived")
        .otherwise("acknowledged")
    )
    return judged.select(*WINDOW, "file_name", reason.alias("reason")).withColumn(
        "delete", F.col("reason") == "acknowledged"
    )


def requeue_acked(
    windows: DataFrame, sidecars: DataFrame, acks: DataFrame, cursors: DataFrame
) -> DataFrame:
    """Compressed payloads before the resume index that were acknowledged but not yet
    cleaned up when the last run stopped."""
    passed = attach_cursors(prefer_plain(windows).where("is_gz"), cursors).where("window_sequence < start_index")
    acked = acked_windows(sidecars, acks).select(*WINDOW)
    return passed.join(acked, WINDOW, "left_semi").select(*WINDOW, "file_name")


def window_decision(
    windows: DataFrame,
    sidecars: DataFrame,
    sessions: DataFrame,
    losses: DataFrame | None = None,
    stream_mode: bool = True,
) -> DataFrame:
    """How each ready window is to be sent.

    ``windows`` carries ``length`` and, where it was computed, ``crc32`` of the stored
    bytes; ``sessions`` carries ``owner_state``. Where the bytes could not be read, the
    window waits. Only a verified window is sent under its identity. Permanent decisions
    come with the reason text of the loss record.
    """
    judged = attach_sidecars(windows, sidecars)
    owners = sessions.select(*SESSION, "owner_state")
    from logharbor.operators.skew import lookup

    judged = lookup(judged, owners, SESSION, ["channel", "window_sequence"])
    if losses is None:
        failed = F.lit(False)
    else:
        prior = losses.select(*WINDOW).distinct().withColumn("_lost", F.lit(True))
        judged = judged.join(prior, WINDOW, "left")
        failed = F.coalesce("_lost", F.lit(False))
    same = checksum_ok(F.col("has_sidecar"), F.col("length"), F.col("crc32"))
    decision = (
        F.when(failed, "prior_failure")
        .when(~(F.col("is_gz") & F.lit(stream_mode)), "line_path")
        .when(~F.col("has_sidecar") & (F.col("owner_state") == "LEGACY_NO_LOCK"), "legacy_send")
        .when(~F.col("has_sidecar"), "retry_wait")
        .when(F.col("malformed"), "permanent_malformed")
        .when(~sidecar_is_valid(), "permanent_mismatch")
        .when(same.isNull(), "retry_wait")
        .when(~same, "permanent_checksum")
        .otherwise("verified_send")
    )
    # Reason texts of the loss records.
    reason = (
        F.when(F.col("decision") == "permanent_malformed",
               F.concat(F.lit("window identity metadata is malformed for "), "file_name"))
        .when(F.col("decision") == "permanent_mismatch",
              F.concat(F.lit("window metadata does not match payload "), "file_name"))
        .when(F.col("decision") == "permanent_checksum",
              F.concat(F.lit("payload_checksum_mismatch:"), "file_name"))
    )
    identity = F.when(F.col("decision") == "verified_send", F.col("window_id"))
    return judged.withColumn("decision", decision).select(
        *WINDOW, "file_name", identity.alias("window_id"), "decision", reason.alias("reason")
    )
