"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Least number of tasks among which Spark deals the files that it looks up.
LISTING_TASKS = 32


def prepare(spark: SparkSession) -> SparkSession:
    """Set the SQL options that the operators rely on; safe to call repeatedly."""
    # Tasks carry the package's functions along, so executors need no installed copy.
    cloudpickle.register_pickle_by_value(sys.modules["logharbor"])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # JSON lines may repeat a key; the last value counts and the line stays valid.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    # Spark looks up the files of a stream's trigger once more, by default in a task per file.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listing_tasks(spark)))
    return spark


def listing_tasks(spark: SparkSession) -> int:
    """Number of tasks for rows that only name files, many more than fit one task's time."""
    return max(LISTING_TASKS, 2 * spark.sparkContext.defaultParallelism)


@contextmanager
def planned_ahead(spark: SparkSession) -> Iterator[None]:
    """For many jobs over few rows: planning each stage anew takes longer than the stage, so its plan is kept, in
    no more tasks than cores."""
    tasks = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(tasks)}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local session may fall back to a temporary folder: on a cluster such a
    folder would exist on one machine and its loss would lose the lineage cut.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="logharbor-")
    spark.conf.set(CHECKPOINT_CONF, fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/logharbor/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table made at a ``scratch_path`` that nothing reads any more."""
    if not path.startswith(f"{shared_dir(spark)}/logharbor/"):
        raise ValueError(f"{path} is no scratch path of this session")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later passes see the same rows in the same partitions."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_dir(spark)}/logharbor")
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to a table in the shared folder and read them back.

    For rows that several later passes read: unlike a checkpoint the table is columnar, so
    each pass reads only the columns that it needs.
    """
    return materialize_as(df, scratch_path(df.sparkSession, label))


def materialize_as(df: DataFrame, path: str) -> DataFrame:
    """As ``materialize``, at a path that the caller may remove."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
