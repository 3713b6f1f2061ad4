"""Outcome of sessions whose channels are all finished."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from logharbor.operators.delivery import outbox_complete
from logharbor.operators.sessions import channel_state, session_completion, settle_sessions
from logharbor.schemas import SESSION


def settlement(
    channels: DataFrame,
    sessions: DataFrame,
    losses: DataFrame,
    now_ms: Column,
    endpoint_host: str,
    stream_mode: bool = True,
    prune_failed: bool = False,
) -> DataFrame:
    """Settled sessions with their outcome and, where completion is signalled, the address."""
    completion = session_completion(channel_state(channels, now_ms), sessions)
    outcomes = settle_sessions(completion, losses, stream_mode, prune_failed)
    signals = outbox_complete(outcomes, endpoint_host)
    return outcomes.select(*SESSION, "outcome").join(signals, SESSION, "left")
