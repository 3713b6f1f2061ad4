"""Responses, ledgers and outgoing requests."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from logharbor.functions.lines import is_blank
from logharbor.functions.paths import endpoint_url
from logharbor.operators.skew import join_keys
from logharbor.schemas import (
    COMPLETE_FIRST_DELAY_S,
    COMPLETE_MAX_TRIES,
    LOSS_SCHEMA_VERSION,
    STREAM,
    WINDOW,
)


def _acknowledges(body: Column) -> Column:
    """Whether a response body says ``window_acknowledged``."""
    value = F.get_json_object(body, "$.window_acknowledged")
    return F.coalesce(
        ~is_blank(body) & ((value == "true") | (value.try_cast("bigint") != 0)), F.lit(False)
    )


def classify_stream_response(responses: DataFrame) -> DataFrame:
    """Outcome of a window or batch request from ``status``, ``body`` and ``window_id``.

    Acceptance advances the cursor; only an acknowledged identity also allows deletion.
    No status means that the request failed; an empty payload counts as accepted without
    being sent, where ``payload_bytes`` is known.
    """
    status, body = F.col("status"), F.coalesce("body", F.lit(""))
    identified = F.col("window_id").isNotNull()
    success = status.between(200, 299)
    outcome = (
        F.when(success & identified & _acknowledges(body), "accepted_identity")
        .when(success, "accepted_legacy")
        .when((status == 409) & identified & body.contains("window_identity_conflict"), "retry")
        .when(status.isin(402, 409), "accepted_legacy")
        .otherwise("retry")
    )
    if "payload_bytes" in responses.columns:
        outcome = F.when(F.col("payload_bytes") == 0, "accepted_legacy").otherwise(outcome)
    return responses.withColumn("outcome", outcome).withColumns({
        "accepted": F.col("outcome") != "retry",
        "identity_acknowledged": F.col("outcome") == "accepted_identity",
    })


def classify_event_response(responses: DataFrame) -> DataFrame:
    """Outcome of a single-line request: unlike for windows, 409 is tried again."""
    status = F.col("status")
    return responses.withColumn(
        "outcome", F.when(status.between(200, 299) | (status == 402), "advance").otherwise("retry")
    )


def classify_complete_response(responses: DataFrame) -> DataFrame:
    """Outcome of a session-complete request with its ``attempt`` number: done, to be tried
    again after ``next_delay_s``, or given up."""
    status, attempt = F.col("status"), F.col("attempt")
    outcome = (
        F.when(status.between(200, 299) | status.between(400, 499), "done")
        .when(attempt < COMPLETE_MAX_TRIES, "retry")
        .otherwise("give_up")
    )
    delay = F.lit(COMPLETE_FIRST_DELAY_S) * F.pow(F.lit(2), attempt - 1)
    return responses.withColumn("outcome", outcome).withColumn(
        "next_delay_s", F.when(F.col("outcome") != "done", delay.cast("bigint"))
    )


def advance_cursor(results: DataFrame, cursors: DataFrame) -> DataFrame:
    """Cursors after the window results of one round.

    ``results`` holds, per window, ``accepted`` and, for a window that was not accepted,
    the ``retry_offset`` of its first unaccepted line. Each stream moves past its leading
    accepted windows and stops at the first other one. Acceptance must only be reported
    once an identity acknowledgement is recorded. Streams without results keep theirs.
    """
    stop = F.struct("window_sequence", F.coalesce("retry_offset", F.lit(0)).alias("read_offset"))
    folded = results.groupBy(*STREAM).agg(
        F.min(F.when(~F.col("accepted"), stop)).alias("_stop"),
        F.max("window_sequence").alias("_last"),
    )
    moved = folded.select(
        *STREAM,
        F.coalesce(F.col("_stop.window_sequence"), F.col("_last") + 1).cast("bigint").alias("file_index"),
        F.coalesce(F.col("_stop.read_offset"), F.lit(0)).cast("bigint").alias("read_offset"),
    )
    kept = cursors.select(
        *STREAM, F.col("file_index").cast("bigint"), F.col("read_offset").cast("bigint")
    )
    return join_keys(kept, moved.select(*STREAM), STREAM, "left_anti").unionByName(moved)


def line_results(windows: DataFrame, requests: DataFrame, outcomes: DataFrame, faults: DataFrame | None = None) -> DataFrame:
    """Per window ``accepted`` and ``retry_offset``, from the outcomes of the requests that carry its lines.

    A window is through once all its requests are accepted, or if nothing of it was to be sent. Otherwise it
    resumes at the first line of its first request that was refused or has no outcome: all before that is
    accepted. A fault (``byte_start``) counts like a refused request from there on.
    """
    key = [*WINDOW, "batch_id"]
    judged = join_keys(requests.select(*key, "start_offset"), outcomes.select(*key, "accepted"), key, "left")
    open_at = judged.where(~F.coalesce("accepted", F.lit(False))).select(*WINDOW, "start_offset")
    if faults is not None:
        open_at = open_at.unionByName(faults.select(*WINDOW, F.col("byte_start").alias("start_offset")))
    first = open_at.groupBy(*WINDOW).agg(F.min("start_offset").alias("retry_offset"))
    results = join_keys(windows.select(*WINDOW), first, WINDOW, "left")
    return results.withColumn("accepted", F.col("retry_offset").isNull())


def record_acks(responses: DataFrame, acks: DataFrame | None = None) -> DataFrame:
    """New acknowledgement records, one per window; a recorded one is never replaced."""
    new = (
        responses.where("identity_acknowledged")
        .groupBy(*WINDOW)
        .agg(F.min("window_id").alias("window_id"))
    )
    return new if acks is None else new.join(acks.select(*WINDOW), WINDOW, "left_anti")


def loss_record(channel: Column, sequence: Column, reason: Column, source: str) -> Column:
    """JSON text of a loss record. A missing channel or reason is written as empty text."""
    return F.to_json(F.struct(
        F.lit(LOSS_SCHEMA_VERSION).alias("schema_version"),
        F.lit(source).alias("source"),
        F.coalesce(channel, F.lit("")).alias("channel"),
        sequence.alias("window_sequence"),
        F.coalesce(reason, F.lit("")).alias("reason"),
    ))


def loss_marker_name(channel: Column, sequence: Column, producer: str) -> Column:
    """File name of an agent's loss record."""
    safe = F.coalesce(F.regexp_replace(channel, "[^A-Za-z0-9_-]", "_"), F.lit("unknown"))
    return F.concat(
        F.lit(f".{producer}-transport-loss.agent-"), safe, F.lit("."), sequence.cast("string"), F.lit(".json")
    )


def record_losses(
    decisions: DataFrame, losses: DataFrame | None, producer: str
) -> DataFrame:
    """New loss records for windows with a permanent decision, one per window."""
    new = decisions.where(F.col("decision").startswith("permanent_")).dropDuplicates(WINDOW)
    if losses is not None:
        new = new.join(losses.select(*WINDOW).distinct(), WINDOW, "left_anti")
    source = f"{producer}-agent"
    return new.select(
        *WINDOW,
        F.lit(source).alias("source"),
        "reason",
        loss_marker_name(F.col("channel"), F.col("window_sequence"), producer).alias("marker"),
        loss_record(F.col("channel"), F.col("window_sequence"), F.col("reason"), source).alias("body"),
    )


def request_headers(host: str, header_prefix: str) -> Column:
    """Headers of a window request; the identity ones only where there is a sidecar.

    ``header_prefix`` is the receiving service's own, as in ``X-<prefix>-Session-Id``.
    """
    x = f"X-{header_prefix}-"
    base = F.create_map(
        F.lit("Content-Type"), F.lit("application/x-ndjson"),
        F.lit("Content-Encoding"), F.lit("gzip"),
        F.lit(x + "Session-Id"), F.col("session_id"),
        F.lit(x + "Hostname"), F.lit(host),
    )
    identity = F.create_map(
        F.lit(x + "Window-Id"), F.col("window_id"),
        F.lit(x + "Window-Channel"), F.col("channel"),
        F.lit(x + "Window-Sequence"), F.col("window_sequence").cast("string"),
        F.lit(x + "Window-CRC32"), F.col("payload_crc32").cast("string"),
    )
    return F.when(F.col("window_id").isNotNull(), F.map_concat(base, identity)).otherwise(base)


def outbox_lines(bodies: DataFrame, endpoint_host: str, version: str | None = None) -> DataFrame:
    """Requests of the line path: address and body, which ``gzip_bodies`` puts into the form
    that goes over the wire."""
    return bodies.withColumn("url", endpoint_url(endpoint_host, F.lit("stream"), version))


def gzip_bodies(requests: DataFrame) -> DataFrame:
    """Add ``body_gz``, the compressed body."""

    @F.pandas_udf("binary")
    def compressed(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda body: gzip.compress(body.encode(), mtime=0))

    return requests.withColumn("body_gz", compressed("body"))


def outbox_windows(
    decisions: DataFrame, payloads: DataFrame, endpoint_host: str, version: str | None = None
) -> DataFrame:
    """Requests that carry a compressed window verbatim.

    ``payloads`` names the file of each window. The bytes never travel through this join:
    the task that sends them reads them, or ``files.read_payloads`` for an outbox table.
    """
    sendable = decisions.where(F.col("decision").isin("verified_send", "legacy_send"))
    return sendable.join(payloads, WINDOW).withColumn(
        "url", endpoint_url(endpoint_host, F.lit("stream"), version)
    )


def outbox_complete(outcomes: DataFrame, endpoint_host: str, version: str | None = None) -> DataFrame:
    """One completion request per session that may be reported complete."""
    return outcomes.where("complete_signal").select(
        "folder", "session_id", endpoint_url(endpoint_host, F.lit("session-complete"), version).alias("url")
    )
