"""Integrity checks of log windows and liveness checks of sessions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from logharbor.schemas import (
    HEAD_SIGNATURE_BYTES,
    SIDECAR_SCHEMA_VERSION,
    SIDECAR_TYPE,
    STALE_TMP_MS,
)


def payload_checksum(content: Column) -> Column:
    """CRC32 of the stored (compressed) bytes."""
    return F.crc32(content)


def head_signature(text: Column) -> Column:
    """CRC32 of the first bytes of the uncompressed content; 0 stands for no content, so
    a checksum of 0 becomes 1."""
    head = F.substring(text.cast("binary"), 1, HEAD_SIGNATURE_BYTES)
    crc = F.crc32(head)
    return (
        F.when(text.isNull() | (F.octet_length(text) == 0), F.lit(0))
        .when(crc == 0, F.lit(1))
        .otherwise(crc)
        .cast("bigint")
    )


def sidecar_is_valid() -> Column:
    """Whether a window's sidecar (``meta_*`` columns) describes this very payload."""
    return F.coalesce(
        (F.col("schema_version") == SIDECAR_SCHEMA_VERSION)
        & (F.col("type") == SIDECAR_TYPE)
        & ~F.col("window_id").rlike(r"(?U)^\s*$")
        & (F.col("meta_session_id") == F.col("session_id"))
        & (F.col("meta_channel") == F.col("channel"))
        & (F.col("meta_window_sequence") == F.col("window_sequence"))
        & (F.col("payload_file") == F.col("file_name"))
        & (F.col("payload_bytes") >= 0),
        F.lit(False),
    )


def checksum_ok(has_sidecar: Column, length: Column, crc32: Column) -> Column:
    """Stored bytes match the sidecar; a window without sidecar has nothing to match.

    Null where the stored bytes are not known: that is no mismatch, unless the length already tells.
    """
    stated = F.col("payload_bytes").isNotNull() & F.col("payload_crc32").isNotNull()
    same = (F.col("payload_bytes") == length) & (F.col("payload_crc32") == crc32)
    return F.when(has_sidecar, F.when(stated, same).otherwise(F.lit(False))).otherwise(F.lit(True))


def tmp_is_stale(now_ms: Column, newest_mtime_ms: Column) -> Column:
    return (now_ms - newest_mtime_ms) > STALE_TMP_MS


def since_cutoff(mtime_ms: Column, since_ms: int) -> Column:
    """Sessions changed at or after the cutoff; a cutoff of 0 means all."""
    return F.lit(since_ms <= 0) | (mtime_ms >= since_ms)
