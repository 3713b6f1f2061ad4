"""The landing zone as a stream: every entry once, directories that rest are not listed again."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from logharbor.functions.paths import parse_window_path
from logharbor.schemas import PAYLOAD_FILE
from logharbor.sources.landing import GROUPS, SESSIONS, dir_depth, in_zone, open_dirs, open_folders, with_content

#: A directory changed less than this ago is listed again, as clocks are coarse and may differ.
RESTING_MS = 10_000


class Folder(InputPartition):
    def __init__(self, folder: str, polled_ms: int):
        self.folder = folder
        self.polled_ms = polled_ms


class PollReader(DataSourceStreamReader):
    """One row per source folder and trigger; the offset is the time of the poll."""

    def __init__(self, options: dict):
        self.folders = [f.rstrip("/") for f in json.loads(options["folders"])]

    def initialOffset(self) -> dict:
        return {"polled_ms": 0}

    def latestOffset(self) -> dict:
        return {"polled_ms": time.time_ns() // 1_000_000}

    def partitions(self, start: dict, end: dict) -> list[Folder]:
        return [Folder(folder, end["polled_ms"]) for folder in self.folders]

    def read(self, partition: Folder) -> Iterator[tuple]:
        yield partition.folder, partition.polled_ms


class LandingPolls(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landing_polls"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("folder", T.StringType()), T.StructField("polled_ms", T.LongType())])

    def streamReader(self, schema: T.StructType) -> PollReader:
        return PollReader(dict(self.options))


def stream_landing_zone(
    spark: SparkSession, folders: list[str], content: str | None = None, resting_ms: int = RESTING_MS
) -> DataFrame:
    """New entries of the source folders, as ``scan_landing_zone`` gives them, empty files included.

    Every path comes once, and a dot-file again when its size or time changes. All listing
    happens in tasks. A session of a group whose directory hasn't changed since it was last
    listed, and not within ``resting_ms`` before that, is not opened again; what is known lies in
    the query's state store, so a restart repeats nothing. Stores without times of directories
    are listed whole. ``content`` as in ``scan_landing_zone``, read for new entries only.
    """
    spark.dataSource.register(LandingPolls)
    polls = spark.readStream.format("landing_polls").option("folders", json.dumps([f.rstrip("/") for f in folders])).load()
    above = open_dirs(open_folders(polls), GROUPS)
    # What tells whether a session is to be opened: its time, and for a recent or unknown one the poll itself.
    now = F.unix_millis(F.current_timestamp())
    rests = F.coalesce(F.col("mtime_ms") < now - resting_ms, F.lit(False))
    opened = dir_depth() == SESSIONS
    state = F.concat_ws("|", "mtime_ms", F.when(~rests, now))
    changed = above.withColumn("seen_as", F.when(opened, state).otherwise(version()))
    changed = changed.dropDuplicates(["folder", "rel_dir", "name", "seen_as"]).drop("seen_as")
    found = open_dirs(changed, SESSIONS).withColumn("seen_as", version())
    new = found.dropDuplicates(["folder", "rel_dir", "name", "seen_as"]).drop("seen_as")
    return with_content(new, content) if content else new


def version():
    """Control files are rewritten in place; all else is written once."""
    return F.when(F.col("name").startswith(".") & ~F.col("is_dir"), F.concat_ws("|", "size", "mtime_ms")).otherwise("")


def stream_listed_windows(entries: DataFrame, folders: list[str]) -> DataFrame:
    """Log windows among the new entries, empty ones included; the columns of ``stream_windows``."""
    files = entries.where(~F.col("is_dir") & F.col("name").rlike(PAYLOAD_FILE)).select(
        F.concat_ws("/", "folder", "rel_dir", "name").alias("path"), F.col("size").alias("length"), "mtime_ms",
        F.col("name").alias("file_name"))
    return parse_window_path(files.where(in_zone(F.col("path"), folders)))
