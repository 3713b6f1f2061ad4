"""From raw lines to requests: clean, type, drop unchanged samples, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logharbor.operators.clean import clean_lines, dedup_lines
from logharbor.operators.delivery import outbox_lines
from logharbor.operators.packing import batch_bodies, line_size, pack_batches
from logharbor.operators.sequence import resume_lines
from logharbor.schemas import MAX_BYTES, MAX_LINES
from logharbor.session import materialize


def line_events(lines: DataFrame, time_col: str, cursors: DataFrame | None = None) -> DataFrame:
    """Lines to send one by one. With cursors, lines already sent are left out."""
    if cursors is not None:
        lines = resume_lines(lines, cursors)
    return dedup_lines(clean_lines(lines), time_col)


def line_requests(
    lines: DataFrame,
    endpoint_host: str,
    time_col: str,
    max_lines: int = MAX_LINES,
    max_bytes: int = MAX_BYTES,
    cursors: DataFrame | None = None,
    with_offsets: bool = False,
) -> DataFrame:
    """Line-batch requests of each log window, ``with_offsets`` as in ``batch_bodies``."""
    # Packing reads the sizes several times and the texts once; the lines are prepared once.
    events = line_events(lines, time_col, cursors).withColumn("size", line_size())
    packed = pack_batches(materialize(events, "lines"), max_lines, max_bytes)
    return outbox_lines(batch_bodies(packed, with_offsets=with_offsets), endpoint_host)
