"""Suppression of device samples that have not meaningfully changed."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from logharbor.operators.ordered import Columns, State, ordered_fold
from logharbor.operators.skew import lookup
from logharbor.session import cut_lineage
from logharbor.schemas import FORCE_EMIT_MS, POWER_THRESHOLD_PCT, TEMP_THRESHOLD_C

EXACT = ["gpu_util", "mem_util", "used_mib", "clock_sm"]
INPUTS = ["ts_ms", "temp_c", "power_mw", *EXACT]
TS, TEMP, POWER = 0, 1, 2


def power_moved(power, base):
    """Whether the whole-percent change against ``base`` exceeds the threshold.

    The percentage is truncated, so it must reach the next whole percent. A base of
    zero counts any other value as a change; a negative base counts none.
    """
    step = POWER_THRESHOLD_PCT + 1
    return ((base > 0) & (abs(power - base) * 100 >= step * base)) | ((base == 0) & (power != 0))


def drifted(ts, temp, power, base_ts, base_temp, base_power):
    """Reasons to keep a sample whose exactly compared metrics equal the base's."""
    return (
        (ts - base_ts > FORCE_EMIT_MS)
        | (abs(temp - base_temp) > TEMP_THRESHOLD_C)
        | power_moved(power, base_power)
    )


def certain(columns: Columns) -> np.ndarray:
    """Rows kept whatever was kept before: their exact metrics differ from those of the
    sample just before, or they come after more than the forced interval.

    A suppressed sample equals its base in the exact metrics and is not older than it,
    so differing from the sample before means differing from the base too.
    """
    sure = np.zeros(len(columns[TS]), dtype=bool)
    if len(sure) > 1:
        sure[1:] = np.diff(columns[TS]) > FORCE_EMIT_MS
        for column in columns[3:]:
            sure[1:] |= column[1:] != column[:-1]
    return sure


class SampleCollector:
    def __init__(self, fold: "ChangeFold"):
        self.fold = fold
        self.pieces: list[Columns] = []
        self.reset_seen = False

    def add(self, columns: Columns) -> None:
        if self.pieces:
            last = [c[-1:] for c in self.pieces[-1]]
            sure = certain([np.concatenate(pair) for pair in zip(last, columns)])[1:]
        else:
            sure = certain(columns)
        resets = np.flatnonzero(sure)
        if len(resets):
            # From a row that is always kept on, the past no longer matters.
            self.reset_seen = True
            self.pieces = [[c[resets[-1]:] for c in columns]]
        else:
            self.pieces.append(columns)

    def rows(self) -> Columns:
        return [np.concatenate(column) for column in zip(*self.pieces)]

    def tail(self) -> State:
        state = None
        for piece in self.pieces:
            _, state = self.fold.run(piece, state)
        return state

    def table(self) -> np.ndarray:
        """Either the one state in which every entry ends, or (sample, end state) for each
        sample that can be the first one kept."""
        if self.reset_seen:
            return np.array(self.tail(), dtype=np.int64)
        rows = np.stack(self.rows(), axis=1)
        ts, temp, power = rows[:, TS], rows[:, TEMP], rows[:, POWER]
        # Any base is at least as old as row 0, so the first row that is more than the
        # forced interval after row 0 is kept at the latest. Of equal samples only the
        # first can be the first one kept.
        late = np.flatnonzero(ts - ts[0] > FORCE_EMIT_MS)
        stop = late[0] + 1 if len(late) else len(rows)
        _, heads = np.unique(rows[:stop], axis=0, return_index=True)
        heads.sort()
        base = self.last_kept(ts, temp, power, heads)
        return np.hstack([rows[heads], rows[base]]).ravel()

    @staticmethod
    def last_kept(ts: np.ndarray, temp: np.ndarray, power: np.ndarray, start: np.ndarray) -> np.ndarray:
        """For each row of ``start``, taken as kept: the last row kept from there on.

        All chains advance by one kept row at a time, and chains that meet go on as one.
        """
        values, kind = np.unique(np.stack([temp, power], axis=1), axis=0, return_inverse=True)
        successor = np.full(len(ts), -1)

        def following(at: np.ndarray) -> np.ndarray:
            # Successors are found for all rows of one temperature and power together.
            unknown = successor[at] < 0
            for k in np.unique(kind[at[unknown]]).tolist() if unknown.any() else ():
                alike = np.flatnonzero(kind == k)
                changed = np.append(np.flatnonzero(drifted(0, temp, power, 0, *values[k])), len(ts))
                late = np.searchsorted(ts, ts[alike] + FORCE_EMIT_MS, side="right")
                successor[alike] = np.minimum(late, changed[np.searchsorted(changed, alike, side="right")])
            return successor[at]

        chains, member = np.unique(start, return_inverse=True)
        for step in itertools.count(1):
            after = following(chains)
            moving = after < len(ts)
            if not moving.any():
                return chains[member]
            chains = np.where(moving, after, chains)
            if step % 16 == 0:
                chains, merged = np.unique(chains, return_inverse=True)
                member = merged[member]


class ChangeFold:
    """Keep the first sample, then each that differs from the last kept one."""

    inputs = INPUTS
    # Leaping is for data that keeps at most one sample in so many.
    leap_share = 20

    def collector(self) -> SampleCollector:
        return SampleCollector(self)

    def advance(self, state: State, table: np.ndarray) -> State:
        width = len(self.inputs)
        if len(table) == width:
            return table.tolist()
        heads = table.reshape(-1, 2 * width)
        first = heads[:, :width].T
        kept = drifted(first[TS], first[TEMP], first[POWER], *state[:3])
        for column, value in zip(first[3:], state[3:]):
            kept = kept | (column != value)
        hits = np.flatnonzero(kept)
        return heads[hits[0], width:].tolist() if len(hits) else state

    def run(self, columns: Columns, state: State | None) -> tuple[np.ndarray, State]:
        keep = certain(columns)
        if state is None:
            keep[0] = True
        else:
            keep[0] = any(c[0] != v for c, v in zip(columns[3:], state[3:]))
        base = tuple(state[:3]) if state is not None else None
        # Long idle stretches keep few samples: leap from one to the next as long as that
        # pays, and look at every row from there on.
        resets = np.flatnonzero(keep)
        at, latest = 0, -1
        if len(resets) * self.leap_share < len(keep):
            at, latest, base = self.leap(columns, keep, resets, base)
        if at < len(keep):
            ts, temp, power = (c[at:].tolist() for c in columns[:3])
            base_ts, base_temp, base_power = base if base is not None else (0, 0, 0)
            for row, sure in enumerate(keep[at:].tolist()):
                if sure or drifted(ts[row], temp[row], power[row], base_ts, base_temp, base_power):
                    keep[at + row] = True
                    base_ts, base_temp, base_power = ts[row], temp[row], power[row]
                    latest = at + row
        if latest >= 0:
            state = [int(c[latest]) for c in columns]
        return keep, state

    def leap(self, columns: Columns, keep: np.ndarray, resets: np.ndarray, base):
        """Mark kept rows by going from each to the next. Returns the row at which this no
        longer pays (or the end), the last row kept, and its time, temperature and power."""
        ts, temp, power = columns[:3]
        count = len(ts)
        changes: dict[tuple, np.ndarray] = {}
        at, latest = 0, -1

        def next_in(positions: np.ndarray) -> int:
            found = int(np.searchsorted(positions, at))
            return int(positions[found]) if found < len(positions) else count

        for _ in range(count // self.leap_share + 1):
            row = next_in(resets)
            if base is not None:
                level = base[TEMP], base[POWER]
                if level not in changes:
                    changes[level] = np.flatnonzero(drifted(0, temp, power, 0, *level))
                late = max(at, int(np.searchsorted(ts, base[TS] + FORCE_EMIT_MS, side="right")))
                row = min(row, late, next_in(changes[level]))
            if row >= count:
                return count, latest, base
            keep[row] = True
            base = int(ts[row]), int(temp[row]), int(power[row])
            at, latest = row + 1, row
        return at, latest, base


def metric_dedup(
    samples: DataFrame,
    key_cols: Sequence[str] = ("session_id", "device_id"),
    order_cols: Sequence[str] = ("ts_ms", "row_no"),
) -> DataFrame:
    """Keep the samples of each device that changed since the last kept sample.

    ``order_cols`` starts with ``ts_ms`` (epoch milliseconds) and orders a device's
    samples totally.
    """
    if order_cols[0] != "ts_ms":
        raise ValueError("samples must be ordered by ts_ms first")
    filled = samples.withColumns({c: F.coalesce(c, F.lit(0)) for c in INPUTS})
    return ordered_fold(
        filled.withColumns({c: F.col(c).cast(samples.schema[c].dataType) for c in INPUTS}),
        list(key_cols),
        list(order_cols),
        ChangeFold(),
        result=None,
    )


def metric_dedup_from(
    samples: DataFrame,
    last_kept: DataFrame,
    key_cols: Sequence[str] = ("session_id", "device_id"),
    order_cols: Sequence[str] = ("ts_ms", "row_no"),
) -> tuple[DataFrame, DataFrame]:
    """Continue from the last kept sample per device: the kept samples, and the new last
    ones.

    The earlier samples take part as the first of their devices. A sample older than its
    device's last kept one is compared as if taken at the same time.
    """
    names, keys = samples.columns, list(key_cols)
    floor = last_kept.select(*keys, F.col("ts_ms").alias("_floor"))
    raised = lookup(samples, floor, keys, [c for c in order_cols if c not in keys]).withColumns({
        "_own_ts": F.col("ts_ms"), "ts_ms": F.greatest("ts_ms", "_floor"), "_new": F.lit(1),
    })
    first = last_kept.withColumns({"_own_ts": F.col("ts_ms"), "_new": F.lit(0)})
    order = ["ts_ms", "_new", "_own_ts", *[c for c in order_cols if c != "ts_ms"]]
    kept = cut_lineage(metric_dedup(raised.drop("_floor").unionByName(first), keys, order))
    newest = kept.groupBy(*keys).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("_s"))
    return (
        kept.where("_new = 1").withColumn("ts_ms", F.col("_own_ts")).select(names),
        newest.select("_s.*").select(names),
    )
