"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logharbor import prepare
from logharbor.session import remove_scratch, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ready(spark: SparkSession) -> SparkSession:
    """Session options of these operators.

    Arrow batches stay small in rows and in bytes. An operator of several jobs writes each intermediate table
    to the shared folder, so shuffle files of a job that is done only fill disks: Spark removes them then.
    """
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that the frame doesn't have yet."""
    taken = {name.lower() for name in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, for functions whose arrays are many times the size of a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt_table(df: DataFrame, key: str, label: str) -> tuple[DataFrame, str]:
    """The rows as a bucketed table in the shared folder, and the table's path.

    Joins and aggregates by ``key`` read it where it lies, without a shuffle. The frame should come in
    ``shuffle_partitions`` parts by the key, or every task writes a file for every bucket.
    """
    path = scratch_path(df.sparkSession, label)
    parts = shuffle_partitions(df.sparkSession)
    df.write.format("parquet").option("path", path).bucketBy(parts, key).saveAsTable(dealt_name(path))
    return df.sparkSession.table(dealt_name(path)), path


def dealt_name(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


def drop_dealt(spark: SparkSession, path: str) -> None:
    """Remove a table of ``dealt_table`` that nothing reads any more, with its files."""
    spark.sql(f"DROP TABLE {dealt_name(path)}")
    remove_scratch(spark, path)


def bounded_sample(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """At most ``rows`` rows, those first by hash of the keys; the same rows however the frame is split.

    A first cut by hash leaves about twice as many as asked for in all partitions together, so what meets to
    be ordered doesn't grow with the frame. The frame is read twice.
    """
    total = df.count()
    hashed = F.xxhash64(*keys)
    if total > 2 * rows:
        df = df.where(F.shiftrightunsigned(hashed, 1) < F.lit(int(2.0 * rows / total * (2**63 - 1))))
    return df.orderBy(hashed, *keys).limit(rows)
