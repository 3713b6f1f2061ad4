"""Grouping of lines into size-bounded delivery requests."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from logharbor.operators.ordered import Columns, State, ordered_fold
from logharbor.operators.skew import join_keys
from logharbor.schemas import MAX_BYTES, MAX_LINES, WINDOW


class SizeCollector:
    def __init__(self, fold: "PackFold"):
        self.fold = fold
        self.pieces: list[np.ndarray] = []

    def add(self, columns: Columns) -> None:
        self.pieces.append(columns[0])

    def tail(self) -> State:
        return self.fold.run([np.concatenate(self.pieces)], None)[1]

    def table(self) -> np.ndarray:
        """Row 0: line and byte count. Row n: bytes up to line n, and the state at the end
        if the request open at the start closes with line n."""
        total = np.cumsum(np.concatenate(self.pieces))
        count = len(total)
        reach = min(count, self.fold.max_lines, int(np.searchsorted(total, self.fold.max_bytes)) + 1)
        begin = np.arange(1, reach + 1)
        closed = np.ones(reach, dtype=np.int64)
        ends = self.fold.closing(total, begin)
        open_ends = ends <= count
        while open_ends.any():
            begin = np.where(open_ends, ends, begin)
            closed += open_ends
            ends = self.fold.closing(total, begin)
            open_ends = ends <= count
        body = np.stack(
            [total[:reach], count - begin, total[-1] - total[begin - 1], closed], axis=1
        )
        return np.vstack([[count, total[-1], 0, 0], body]).ravel()


class PackFold:
    """Close a request once it holds ``max_lines`` lines or ``max_bytes`` bytes.

    The state is (lines, bytes) of the open request and its number.
    """

    inputs = ["_size"]

    def __init__(self, max_lines: int, max_bytes: int):
        self.max_lines = max_lines
        self.max_bytes = max_bytes

    def collector(self) -> SizeCollector:
        return SizeCollector(self)

    def closing(self, total: np.ndarray, begin):
        """Number of lines up to the one that closes a request begun after ``begin``
        lines; more than there are if it stays open. ``total`` is the running size."""
        before = np.where(begin > 0, total[np.maximum(begin, 1) - 1], 0)
        by_bytes = np.searchsorted(total, before + self.max_bytes) + 1
        return np.minimum(begin + self.max_lines, by_bytes)

    def advance(self, state: State, table: np.ndarray) -> State:
        lines, size, number = state
        rows = table.reshape(-1, 4)
        count, total = rows[0, 0], rows[0, 1]
        ends = min(
            self.max_lines - lines,
            int(np.searchsorted(rows[1:, 0], self.max_bytes - size)) + 1,
        )
        if ends >= len(rows):
            return [lines + int(count), size + int(total), number]
        _, lines, size, closed = rows[ends].tolist()
        return [lines, size, number + closed]

    def run(self, columns: Columns, state: State | None) -> tuple[np.ndarray, State]:
        lines, size, number = state if state is not None else (0, 0, 0)
        total = np.cumsum(columns[0])
        count = len(total)
        numbers = np.empty(count, dtype=np.int64)
        at, spent = 0, 0
        while at < count:
            ends = min(
                at + self.max_lines - lines,
                int(np.searchsorted(total, spent + self.max_bytes - size)) + 1,
            )
            full = ends <= count
            ends = min(ends, count)
            numbers[at:ends] = number
            if full:
                lines, size, number = 0, 0, number + 1
            else:
                lines, size = lines + ends - at, size + int(total[-1]) - spent
            at, spent = ends, int(total[ends - 1])
        return numbers, [lines, size, number]


def line_size() -> Column:
    """Bytes that a line takes in a request: UTF-8 text and separator."""
    return F.octet_length("line") + 1


def pack_batches(
    lines: DataFrame,
    max_lines: int = MAX_LINES,
    max_bytes: int = MAX_BYTES,
    keys: Sequence[str] = tuple(WINDOW),
    order: Sequence[str] = ("line_no",),
) -> DataFrame:
    """Add ``batch_id``, the number of the request within its log window.

    A line is added first and the limits are tested after, so a request may exceed
    ``max_bytes`` by its last line. Limits of zero or less mean the defaults. A ``size``
    column, if present, is taken as the ``line_size`` of the lines. The lines are read
    several times, so costly preparation should be stored before (``session.materialize``).
    """
    fold = PackFold(
        max_lines if max_lines > 0 else MAX_LINES, max_bytes if max_bytes > 0 else MAX_BYTES
    )
    # The line texts stay out of the ordered passes; only their sizes are folded.
    size = F.col("size") if "size" in lines.columns else line_size()
    sized = lines.select(*keys, *order, size.alias("_size"))
    numbered = ordered_fold(sized, list(keys), list(order), fold, result="batch_id")
    return join_keys(lines, numbered.drop("_size"), [*keys, *order])


def batch_summary(packed: DataFrame, keys: Sequence[str] = tuple(WINDOW)) -> DataFrame:
    """Line count, bytes and byte range of each request."""
    return packed.groupBy(*keys, "batch_id").agg(
        F.count("*").alias("line_count"),
        F.sum(line_size()).alias("bytes"),
        F.min("byte_start").alias("start_offset"),
        F.max("byte_end").alias("end_offset"),
    )


def batch_bodies(packed: DataFrame, keys: Sequence[str] = tuple(WINDOW), with_offsets: bool = False) -> DataFrame:
    """Request bodies: the lines of each request, each ended by a newline.

    A request is bounded by the packing limits, so collecting its lines is too. ``with_offsets`` adds the
    request's byte positions, ``start_offset`` and ``end_offset``, from those of its lines.
    """
    span = [F.min("byte_start").alias("start_offset"), F.max("byte_end").alias("end_offset")] if with_offsets else []
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return packed.groupBy(*keys, "batch_id").agg(
        F.count("*").alias("line_count"),
        *span,
        F.concat(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n"), F.lit("\n")).alias(
            "body"
        ),
    )
