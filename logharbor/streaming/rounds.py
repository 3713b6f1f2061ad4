"""Tables that carry state from one micro-batch to the next.

Every write replaces the folder of its own micro-batch, so a repeated micro-batch ends
in the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from logharbor.operators.dedup import metric_dedup_from
from logharbor.operators.sequence import ready_prefix, resume_windows
from logharbor.operators.skew import join_keys, lookup
from logharbor.plans.window_path import decide_round, record_round, sendable
from logharbor.schemas import STREAM, WINDOW
from logharbor.session import planned_ahead
from logharbor.sources.files import hash_payloads


def _fields(names, kinds) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])


TEXT, LONG = T.StringType(), T.LongType()
WINDOWS = _fields(
    [*WINDOW, "file_name", "path", "is_gz", "length", "crc32"],
    [TEXT, TEXT, TEXT, LONG, TEXT, TEXT, T.BooleanType(), LONG, LONG],
)
CURSORS = _fields([*STREAM, "file_index", "read_offset"], [TEXT, TEXT, TEXT, LONG, LONG])
ACKS = _fields([*WINDOW, "window_id"], [TEXT, TEXT, TEXT, LONG, TEXT])
LOSSES = _fields(
    [*WINDOW, "source", "reason", "marker", "body"], [TEXT, TEXT, TEXT, LONG, TEXT, TEXT, TEXT, TEXT]
)


#: Numbers of delivery rounds per micro-batch: the micro-batch's own and those of repeats without new input.
SPAN = 1_000_000


class RoundTables:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def epochs(self, table: str) -> list[int]:
        """Micro-batches whose rows of the table are complete, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{table}")
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        done = [str(s.getPath().getParent().getName()) for s in files.globStatus(
            self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{table}/epoch=*/_SUCCESS")) or []]
        return sorted(int(name.removeprefix("epoch=")) for name in done)

    def stored(self, table: str, epoch: int, schema: T.StructType) -> DataFrame:
        """The rows that one micro-batch wrote."""
        return self.spark.read.schema(schema).parquet(f"{self.base}/{table}/epoch={epoch}")

    def write(self, df: DataFrame, table: str, epoch: int) -> DataFrame:
        """Store the rows of this micro-batch and read them back."""
        path = f"{self.base}/{table}/epoch={epoch}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def snapshot(self, table: str, epoch: int, schema: T.StructType) -> DataFrame:
        """The table as the previous micro-batch left it; that it is missing after the first is an error."""
        if epoch == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.base}/{table}/epoch={epoch - 1}")

    def history(self, table: str, epoch: int, schema: T.StructType) -> DataFrame:
        """All rows that earlier micro-batches added; a missing table after the first is an error."""
        return self.dated(table, epoch, schema).drop("epoch")

    def dated(self, table: str, epoch: int, schema: T.StructType) -> DataFrame:
        """As ``history``, with the micro-batch that added each row as ``epoch``."""
        dated = T.StructType([*schema.fields, T.StructField("epoch", LONG)])
        if epoch == 0:
            return self.spark.createDataFrame([], dated)
        return self.spark.read.schema(dated).parquet(f"{self.base}/{table}").where(f"epoch < {epoch}")

    def all(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{table}").drop("epoch")


#: Gives the current sidecars and sessions of a round. Instead of all sidecars it may give a function that
#: looks up those of the windows it is handed, so that a round doesn't open every control file there is.
Control = Callable[[SparkSession], tuple[DataFrame | Callable[[DataFrame], DataFrame], DataFrame]]


def dedup_rounds(samples: DataFrame, base: str, key_cols, order_cols) -> DataStreamWriter:
    """Keep changed samples of a stream in table ``kept``.

    The last kept sample per device is table ``last``; each micro-batch is folded with the
    batch operator, so a device with most of the rows does not end up in one task.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        tables = RoundTables(batch.sparkSession, base)
        last = tables.snapshot("last", epoch, batch.schema)
        kept, newest = metric_dedup_from(batch, last, key_cols, order_cols)
        tables.write(kept, "kept", epoch)
        tables.write(newest, "last", epoch)

    return samples.writeStream.foreachBatch(each)


def window_rounds(
    windows: DataFrame,
    base: str,
    control: Control,
    send: Callable[[DataFrame], DataFrame],
    producer: str,
) -> DataStreamWriter:
    """Deliver the windows of a stream round by round.

    ``control`` gives the current sidecars, or how to look them up, and the sessions. Windows that cannot go yet (a gap
    before them, no sidecar, a refused request) wait: those that a round would try in table ``windows``, those behind
    a missing number in ``held``, to which a round only adds. ``retry_round`` tries them again when no new file comes.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        tables = RoundTables(batch.sparkSession, base)
        before = [e for e in tables.epochs("windows") if e < epoch * SPAN]
        if epoch and (not before or before[-1] // SPAN != epoch - 1):
            raise FileNotFoundError(f"the tables of micro-batch {epoch - 1} are missing below {base}")
        with planned_ahead(tables.spark):
            _deliver(tables, batch, epoch * SPAN, before[-1] if before else None, control, send, producer)

    return windows.writeStream.foreachBatch(each)


def retry_round(
    spark: SparkSession,
    base: str,
    control: Control,
    send: Callable[[DataFrame], DataFrame],
    producer: str,
) -> bool:
    """One more round over the waiting windows, without new input; false if none wait.

    Call it on a timer and after a restart while no micro-batch runs. The bytes are hashed
    anew, as a file that couldn't be read before may be whole now.
    """
    tables = RoundTables(spark, base)
    rounds = tables.epochs("windows")
    if not rounds:
        return False
    windows, cursors = tables.stored("windows", rounds[-1], WINDOWS), tables.stored("cursors", rounds[-1], CURSORS)
    known = windows.unionByName(still_held(tables.dated("held", rounds[-1] + 1, WINDOWS), edges(windows, cursors)))
    if known.isEmpty():
        return False
    with planned_ahead(spark):
        _deliver(tables, hash_payloads(known), rounds[-1] + 1, rounds[-1], control, send, producer)
    return True


def edges(windows: DataFrame, cursors: DataFrame) -> DataFrame:
    """The first missing number (``edge``) of the streams that have a cursor or waiting windows in reach. The latter
    are a gap-free run from the cursor on, so what is held of a stream lies behind its edge."""
    at = windows.select(*STREAM, (F.col("window_sequence") + 1).alias("edge")).unionByName(
        cursors.select(*STREAM, F.greatest(F.lit(1).cast("bigint"), "file_index").alias("edge")))
    return at.groupBy(*STREAM).agg(F.max("edge").alias("edge"))


def still_held(held: DataFrame, edges: DataFrame, how: str = "left") -> DataFrame:
    """Held windows behind the edge of their stream, as they were hashed last; a stream without one begins at 1.

    ``how`` "inner" gives only those of the streams in ``edges``.
    """
    behind = lookup(held, edges, STREAM, ["window_sequence"], how).where(F.col("window_sequence") >= F.coalesce("edge", F.lit(1)))
    others = [c for c in WINDOWS.names if c not in (*WINDOW, "is_gz")]
    last = behind.groupBy(*WINDOW, "is_gz").agg(F.max_by(F.struct(*others), "epoch").alias("_file"))
    return last.select(*WINDOW, "is_gz", "_file.*").select(WINDOWS.names)


def in_reach(new: DataFrame, windows: DataFrame, held: DataFrame, cursors: DataFrame, acked: DataFrame) -> DataFrame:
    """The windows that would be ready if every acknowledgement counted: those ``in reach`` before, the new ones, and
    what was held behind a number that came."""
    begin = lookup(new, edges(windows, cursors), STREAM, ["window_sequence"])
    edge = F.coalesce("edge", F.lit(1).cast("bigint"))
    filled = begin.where(F.col("window_sequence") == edge).select(*STREAM, edge.alias("edge")).distinct()
    known = windows.unionByName(still_held(held, filled, "inner"))
    known = join_keys(known, new.select(*WINDOW, "is_gz"), [*WINDOW, "is_gz"], "left_anti")
    pool = known.select(WINDOWS.names).unionByName(new.select(WINDOWS.names))
    return ready_prefix(pool, cursors, acked).select(WINDOWS.names)


def _together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """The results of steps that run side by side: their jobs are small, most of the time goes into starting them."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [step.result() for step in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


def _deliver(
    tables: RoundTables, batch: DataFrame, number: int, before: int | None, control, send, producer: str
) -> None:
    """Round ``number`` over new windows and those left by round ``before``. ``windows`` is
    written last, so a round that broke off doesn't count and is done again.

    Windows behind a missing number are read again only once that number comes, and never rewritten."""
    spark = tables.spark

    def left(table: str, schema: T.StructType) -> DataFrame:
        return spark.createDataFrame([], schema) if before is None else tables.stored(table, before, schema)

    def ledger(table: str, schema: T.StructType) -> DataFrame:
        return tables.dated(table, 0 if before is None else number, schema)

    # One row per file: a repeated listing must not double a window. What was hashed last counts.
    new = batch.select(WINDOWS.names)
    new = tables.write(new.dropDuplicates([*WINDOW, "is_gz"]), "new", number)
    # The round reads these several times; listing and hashing must happen once.
    sidecars, sessions = control(spark)
    cursors = left("cursors", CURSORS)
    acks = ledger("acks", ACKS).drop("epoch")
    losses = ledger("losses", LOSSES).drop("epoch")
    acked = resume_windows(acks.select(*WINDOW).distinct(), cursors).select(*WINDOW)
    near = tables.write(in_reach(new, left("windows", WINDOWS), ledger("held", WINDOWS), cursors, acked), "near", number)
    held = join_keys(resume_windows(new, cursors), near.select(*WINDOW), WINDOW, "left_anti")

    def decide() -> DataFrame:
        asked = near.select(*WINDOW).distinct().unionByName(acked)
        known = tables.write(sidecars(asked) if callable(sidecars) else sidecars, "sidecars", number)
        return tables.write(decide_round(near, known, acks, losses, cursors, sessions), "decisions", number)

    decisions, _ = _together(spark, decide, lambda: tables.write(held.select(WINDOWS.names), "held", number))
    # Requests go out once: everything after reads the stored responses.
    responses = tables.write(send(sendable(decisions)), "responses", number)
    recorded = record_round(decisions, responses, acks, losses, cursors, producer)
    moved, _, _ = _together(
        spark,
        lambda: tables.write(recorded["cursors"].select(CURSORS.names), "cursors", number),
        lambda: tables.write(recorded["acks"].select(ACKS.names), "acks", number),
        lambda: tables.write(recorded["losses"].select(LOSSES.names), "losses", number),
    )
    waiting = join_keys(near, moved.select(*STREAM, "file_index"), STREAM, "left").where(
        "file_index is null or window_sequence >= file_index"
    )
    tables.write(waiting.select(WINDOWS.names), "windows", number)
