"""One delivery round of compressed windows: gate, verify, send, record, advance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from logharbor.operators.delivery import (
    advance_cursor,
    classify_stream_response,
    record_acks,
    record_losses,
)
from logharbor.operators.integrity import acked_windows, window_decision
from logharbor.operators.sequence import prefer_plain, ready_prefix
from logharbor.operators.skew import lookup
from logharbor.schemas import STREAM, WINDOW
from logharbor.session import materialize

SENDABLE = ["verified_send", "legacy_send", "line_path"]


def decide_round(
    windows: DataFrame,
    sidecars: DataFrame,
    acks: DataFrame,
    losses: DataFrame,
    cursors: DataFrame,
    sessions: DataFrame,
) -> DataFrame:
    """How each window that is next in its stream is to be sent.

    A window that cannot be sent ends its stream's round: the ones after it are left out.
    """
    done = acked_windows(sidecars, acks)
    ready = ready_prefix(prefer_plain(windows), cursors, done)
    decisions = materialize(window_decision(ready, sidecars, sessions, losses), "decisions")
    stops = decisions.where(~F.col("decision").isin(SENDABLE)).groupBy(*STREAM).agg(
        F.min("window_sequence").alias("_stop")
    )
    limited = lookup(decisions, stops, STREAM, ["window_sequence"])
    return limited.where("_stop is null or window_sequence <= _stop").drop("_stop")


def sendable(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("decision").isin(SENDABLE))


def record_round(
    decisions: DataFrame,
    responses: DataFrame,
    acks: DataFrame,
    losses: DataFrame,
    cursors: DataFrame,
    producer: str,
) -> dict[str, DataFrame]:
    """New ledger rows and cursors from the responses to the sent windows.

    A window without response, or not accepted, stops its stream at its number.
    """
    outcomes = classify_stream_response(responses)
    results = decisions.select(*WINDOW).join(
        outcomes.select(*WINDOW, "accepted"), WINDOW, "left"
    ).select(
        *WINDOW, F.coalesce("accepted", F.lit(False)).alias("accepted"), F.lit(0).alias("retry_offset")
    )
    return {
        "outcomes": outcomes,
        "acks": record_acks(outcomes, acks),
        "losses": record_losses(decisions, losses, producer),
        "cursors": advance_cursor(results, cursors),
    }


def window_round(
    windows: DataFrame,
    sidecars: DataFrame,
    acks: DataFrame,
    losses: DataFrame,
    cursors: DataFrame,
    sessions: DataFrame,
    send: Callable[[DataFrame], DataFrame],
    producer: str,
) -> dict[str, DataFrame]:
    """A whole round. Decisions and responses are stored, so each request is sent once.

    ``send`` takes the sendable windows and returns them with ``status`` and ``body`` of
    the response. Windows with decision ``line_path`` go out as lines (``line_requests``),
    the others verbatim. It sends a stream's windows in order and leaves out those after a
    refused one.
    """
    decisions = decide_round(windows, sidecars, acks, losses, cursors, sessions)
    responses = materialize(send(sendable(decisions)), "responses")
    return {"decisions": decisions, **record_round(decisions, responses, acks, losses, cursors, producer)}
