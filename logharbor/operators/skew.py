"""Keyed operations that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

SPREAD = 16


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal key parts, null being equal to null: a row whose key has a null part is a row like others."""
    others = {key: f"_key{n}" for n, key in enumerate(keys)}
    renamed = right.withColumnsRenamed(others)
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(other)) for key, other in others.items()])
    joined = left.join(renamed, same, how)
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys]
    return joined.select(*keys, *[c for c in left.columns if c not in keys], *added)


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    spread: int = SPREAD,
) -> DataFrame:
    """Join ``rows`` to a ``table`` that has at most one row per key; keys match as in ``join_keys``.

    No side is hinted for broadcast: Spark broadcasts the table by itself when its
    measured size is below the session threshold. Beyond that, the rows of one key go
    to ``spread`` different shuffle partitions, chosen from the columns that differ
    within a key, so that a retried task makes the same choice.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(spread)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return join_keys(salted, copies, [*keys, "_salt"], how).drop("_salt")


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    out: str,
    bucket_size: int,
) -> DataFrame:
    """The next lower ``position`` of the same key, as ``lag`` would give it.

    ``position`` is unique per key. Rows are compared inside buckets of positions, and
    only one row per bucket is needed to link a bucket to the one before it.
    """
    bucketed = df.withColumn("_bucket", F.floor(F.col(position) / bucket_size))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(position)
    tops = bucketed.groupBy(*keys, "_bucket").agg(F.max(position).alias("_top"))
    across = Window.partitionBy(*keys).orderBy("_bucket")
    links = tops.select(*keys, "_bucket", F.lag("_top").over(across).alias("_before"))
    return (
        join_keys(bucketed.withColumn("_lag", F.lag(position).over(inside)), links, [*keys, "_bucket"])
        .withColumn(out, F.coalesce("_lag", "_before"))
        .drop("_bucket", "_lag", "_before")
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    amount: Column,
    out: str,
    bucket_size: int,
) -> DataFrame:
    """Inclusive running sum of ``amount`` by ``position`` within each key.

    Sums run inside buckets of positions; the totals of the earlier buckets are added
    from one row per bucket.
    """
    bucketed = df.withColumn("_amount", amount).withColumn(
        "_bucket", F.floor(F.col(position) / bucket_size)
    )
    inside = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = bucketed.groupBy(*keys, "_bucket").agg(F.sum("_amount").alias("_total"))
    bases = sums.select(
        *keys, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base")
    )
    return (
        join_keys(bucketed.withColumn("_inside", F.sum("_amount").over(inside)), bases, [*keys, "_bucket"])
        .withColumn(out, F.col("_base") + F.col("_inside"))
        .drop("_bucket", "_amount", "_inside", "_base")
    )
