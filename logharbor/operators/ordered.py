"""Order-dependent folds over keyed rows, spread evenly over tasks.

A fold such as "keep a sample if it differs from the last *kept* sample" needs each
key's rows in order. Grouping by key would hand a hot key to one task, so the rows are
range-partitioned by (key, order) instead: a hot key simply spans many partitions. Each
partition then reports, for the key it shares with its successor, how the fold leaves
it; a small pass per key chains these reports into the state in which each partition
begins; and a last pass folds all partitions at the same time from these states.

The reports hold one row per partition and partition edge, whatever the data size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logharbor.session import cut_lineage

State = list[int]
Columns = list[np.ndarray]


class Collector(Protocol):
    """What one partition must remember of the key that it may share with the next."""

    def add(self, columns: Columns) -> None:
        """Take the key's next rows."""

    def tail(self) -> State:
        """State after the rows when the key starts in this partition."""

    def table(self) -> np.ndarray:
        """For a partition that holds this key only: what ``Fold.advance`` needs to find
        the state after the partition from any state before it."""


class Fold(Protocol):
    """The rule of one fold. ``inputs`` names the integer columns that it reads."""

    inputs: Sequence[str]

    def collector(self) -> Collector: ...

    def advance(self, state: State, table: np.ndarray) -> State:
        """State after a whole partition entered in ``state``."""

    def run(self, columns: Columns, state: State | None) -> tuple[np.ndarray, State]:
        """Result value per row for consecutive rows of one key, and the state after."""


def key_starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Row numbers at which a new key begins within the batch (without row 0)."""
    changed = np.zeros(max(batch.num_rows - 1, 0), dtype=bool)
    for key in keys:
        codes = batch.column(key).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        changed |= codes[1:] != codes[:-1]
    return np.flatnonzero(changed) + 1


def numbers(batch: pa.RecordBatch, names: Sequence[str]) -> Columns:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def key_of(batch: pa.RecordBatch, keys: Sequence[str], row: int) -> tuple:
    return tuple(batch.column(k)[row].as_py() for k in keys)


def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task that turns a partition's Arrow batches into one row each, in order.

    The partitions are stored and read again by two passes; a batch is stored and handed
    over as one value, where single rows would be converted one by one each time.
    """
    for batch in batches:
        if batch.num_rows:
            sink = pa.BufferOutputStream()
            rows = batch.drop_columns(["_part"])
            with pa.ipc.new_stream(sink, rows.schema) as writer:
                writer.write_batch(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_part")[:1], pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                names=["_part", "_rows"],
            )


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.RecordBatch]]:
    """The stored batches, each with the other values of its row."""
    for batch in batches:
        for n, rows in enumerate(batch.column("_rows")):
            beside = {c: batch.column(c)[n].as_py() for c in batch.schema.names if c != "_rows"}
            yield beside, pa.ipc.open_stream(rows.as_buffer()).read_next_batch()


def runs(
    batch: pa.RecordBatch, keys: Sequence[str], inputs: Sequence[str]
) -> Iterator[tuple[tuple, Columns]]:
    """Consecutive rows of one key; a key may go on in the next batch."""
    columns = numbers(batch, inputs)
    edges = [0, *key_starts(batch, keys).tolist(), batch.num_rows]
    for lo, hi in zip(edges, edges[1:]):
        yield key_of(batch, keys, lo), [c[lo:hi] for c in columns]


def report_edges(fold: Fold, keys: Sequence[str], schema: pa.Schema):
    """Task of the first pass: what the partition's first and last key need to know."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = part = None
        for beside, batch in unpacked(batches):
            for key, columns in runs(batch, keys, fold.inputs):
                if first is None:
                    first, part = key, beside["_part"]
                if key != last:
                    last, seen = key, fold.collector()
                seen.add(columns)
        if first is None:
            return
        if first == last:
            rows = [(*first, part, True, seen.tail(), seen.table().tolist())]
        else:
            rows = [(*first, part, True, None, None), (*last, part, False, seen.tail(), None)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, type=field.type) for column, field in zip(zip(*rows), schema)],
            schema=schema,
        )

    return task


def chain_edges(fold: Fold, keys: Sequence[str], schema: pa.Schema):
    """Task of the second pass: entry states from the reports, in partition order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if key != current:
                    current, state = key, None
                if row["_enters"] and state is not None:
                    found.append((row["_part"], state))
                if row["_table"] is not None and state is not None:
                    state = fold.advance(state, np.array(row["_table"], dtype=np.int64))
                else:
                    state = row["_exit"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in found], pa.int32()),
                 pa.array([s for _, s in found], pa.list_(pa.int64()))],
                schema=schema,
            )

    return task


def fold_rows(fold: Fold, keys: Sequence[str], schema: pa.Schema, keep_marked: bool):
    """Task of the last pass: append the result column, or keep only the marked rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, started = None, None, False
        for beside, batch in unpacked(batches):
            results = []
            for key, columns in runs(batch, keys, fold.inputs):
                if key != current:
                    state = None if started else beside["_entry"]
                    current, started = key, True
                values, state = fold.run(columns, state)
                results.append(values)
            result = pa.array(np.concatenate(results))
            if keep_marked:
                yield batch.filter(result).select(schema.names).cast(schema)
            else:
                arrays = [batch.column(n) for n in schema.names[:-1]] + [result]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names).cast(schema)

    return task


def ordered_fold(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fold: Fold,
    result: str | None,
) -> DataFrame:
    """Fold the rows of each key in ``order``, which must be a total order per key.

    With ``result`` the fold's value is added under that name; without it the rows
    whose value is true are kept.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(partitions, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_part", F.spark_partition_id())
        .mapInArrow(pack_partition, "_part int, _rows binary")
    )
    # All passes must see the same partitions. Range bounds are sampled anew when a plan is
    # run again, hence the reliable checkpoint.
    ranged = cut_lineage(ranged)

    longs = ArrayType(LongType())
    key_fields = [df.schema[k] for k in keys]
    report_schema = StructType([
        *key_fields,
        StructField("_part", IntegerType()),
        StructField("_enters", BooleanType()),
        StructField("_exit", longs),
        StructField("_table", longs),
    ])
    entry_schema = StructType([StructField("_part", IntegerType()), StructField("_entry", longs)])

    reports = ranged.mapInArrow(
        report_edges(fold, keys, to_arrow_schema(report_schema)), report_schema
    )
    entries = (
        reports.repartition(*keys)
        .sortWithinPartitions(*keys, "_part")
        .mapInArrow(chain_edges(fold, keys, to_arrow_schema(entry_schema)), entry_schema)
    )
    # At most one entry per range partition, so the size is bounded by the partition count;
    # a broadcast join also leaves the stored batches and their order as they are.
    seeded = ranged.join(F.broadcast(entries), "_part", "left")
    out_schema = df.schema if result is None else df.schema.add(result, LongType())
    return seeded.mapInArrow(
        fold_rows(fold, keys, to_arrow_schema(out_schema), keep_marked=result is None), out_schema
    )
