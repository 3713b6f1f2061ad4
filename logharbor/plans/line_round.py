"""One delivery round of the line path over files: resume, read, clean, pack, send, advance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from logharbor.operators.delivery import advance_cursor, classify_stream_response, line_results
from logharbor.operators.sequence import prefer_plain, ready_prefix, resume_lines
from logharbor.plans.line_path import line_requests
from logharbor.schemas import MAX_BYTES, MAX_LINES, WINDOW
from logharbor.session import materialize
from logharbor.sources.files import read_lines


def round_requests(
    windows: DataFrame,
    cursors: DataFrame,
    endpoint_host: str,
    time_col: str = "mtime_ms",
    max_lines: int = MAX_LINES,
    max_bytes: int = MAX_BYTES,
    done: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The windows whose turn it is, their requests and the faults met in reading them.

    Only windows of the gap-free run from the cursor on are opened; in the window in progress, lines before
    the cursor's offset are skipped. Each table is stored, as what comes after must see the same requests.
    Deduplication starts anew with the round's first line.
    """
    ready = ready_prefix(prefer_plain(windows), cursors, done)
    ready = materialize(ready.select(*WINDOW, time_col, "start_index", "start_offset", "path", "is_gz"), "ready")
    lines = materialize(read_lines(ready, with_faults=True), "read")
    # A fault before the offset hides what comes after it as well.
    faults = lines.where("fault is not null").withColumn("byte_start", F.greatest(
        "byte_start", F.when(F.col("window_sequence") == F.col("start_index"), F.col("start_offset")).otherwise(0)))
    fresh = resume_lines(lines.where("fault is null").drop("fault"))
    requests = line_requests(fresh, endpoint_host, time_col, max_lines, max_bytes, with_offsets=True)
    return {"ready": ready, "faults": faults, "requests": materialize(requests, "requests")}


def line_round(
    windows: DataFrame,
    cursors: DataFrame,
    send: Callable[[DataFrame], DataFrame],
    endpoint_host: str,
    time_col: str = "mtime_ms",
    max_lines: int = MAX_LINES,
    max_bytes: int = MAX_BYTES,
    done: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """A whole round; ``cursors`` of the result are those to start the next round with.

    ``windows`` are listed windows (``list_windows``). ``send`` takes the requests and returns, by window and
    ``batch_id``, ``status`` and ``body`` of the responses. It sends a stream's requests in order and gives no
    response for those after a refused one, so nothing overtakes. A refused window resumes at the first line
    of the refused request, and so does a window that could be read in part only at the fault. Delivery is at
    least once: a round that is lost after sending is sent again.
    """
    found = round_requests(windows, cursors, endpoint_host, time_col, max_lines, max_bytes, done)
    responses = materialize(send(found["requests"]), "responses")
    outcomes = classify_stream_response(responses.withColumn("window_id", F.lit(None).cast("string")))
    results = line_results(found["ready"], found["requests"], outcomes, found["faults"])
    return {**found, "outcomes": outcomes, "results": results, "cursors": advance_cursor(results, cursors)}
