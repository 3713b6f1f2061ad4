"""Listing of the landing zone and the control records found in it."""

from __future__ import annotations

import os
import re
import stat
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from logharbor.functions.paths import parse_window_path
from logharbor.operators.sessions import session_catalog
from logharbor.operators.skew import lookup
from logharbor.schemas import (
    ACK_FILE,
    AGENT_LOSS_FILE,
    CHANNELS,
    CURSOR_FILE,
    FAILED_MARKER,
    LOSS,
    LOSS_FILE,
    PAYLOAD_FILE,
    SESSION,
    SIDECAR,
    SIDECAR_FILE,
    TMP_DIR,
    UPLOADED_MARKER,
    WINDOW,
)
from logharbor.sources.files import locate, spread_files

ENTRY = T.StructType([
    T.StructField("folder", T.StringType()),
    T.StructField("rel_dir", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("is_dir", T.BooleanType()),
    T.StructField("size", T.LongType()),
    T.StructField("mtime_ms", T.LongType()),
    T.StructField("content", T.StringType()),
])
ROWS_PER_BATCH = 4096
#: Directories of a folder: those in it, and those in them. Only the latter are many within one directory.
GROUPS, SESSIONS = 1, 2


def listing(path: str) -> Iterator[tuple[str, bool, int | None, int | None]]:
    """Name, whether a directory, size and time in ns of what lies in a directory.

    A local directory is walked entry by entry, so a session of many windows costs no memory.
    """
    system, inner = locate(path)
    if isinstance(system, fs.LocalFileSystem):
        yield from local_listing(inner)
        return
    for entry in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        yield entry.base_name, entry.type == fs.FileType.Directory, entry.size, entry.mtime_ns


def local_listing(path: str) -> Iterator[tuple[str, bool, int | None, int | None]]:
    try:
        entries = os.scandir(path)
    except FileNotFoundError:
        return
    with entries:
        for entry in entries:
            try:
                found = entry.stat()
            except FileNotFoundError:  # gone since, or a link to nothing
                yield entry.name, False, None, None
                continue
            yield entry.name, stat.S_ISDIR(found.st_mode), found.st_size if stat.S_ISREG(found.st_mode) else None, found.st_mtime_ns


def children(folder: str, rel_dir: str, depth: int) -> Iterator[tuple]:
    """Entries of a directory, and below a session those of its working directory."""
    for name, is_dir, size, mtime_ns in listing(f"{folder}/{rel_dir}" if rel_dir else folder):
        mtime = mtime_ns // 1_000_000 if mtime_ns else None
        yield folder, rel_dir, name, is_dir, None if is_dir else size, mtime, None
        if is_dir and depth == SESSIONS and name == TMP_DIR and "/" in rel_dir:
            yield from children(folder, f"{rel_dir}/{name}", depth + 1)


def entry_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(ENTRY)
    while part := list(islice(rows, ROWS_PER_BATCH)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*part), schema)], schema=schema)


def dir_depth() -> Column:
    """Level of a directory's entries: 1 for those directly in the folder, 0 for files."""
    inside = F.when(F.col("rel_dir") == "", GROUPS).when(~F.col("rel_dir").contains("/"), SESSIONS).otherwise(0)
    return F.when(F.col("is_dir"), inside).otherwise(0)


def open_dirs(entries: DataFrame, depth: int, since_ms: int = 0) -> DataFrame:
    """The entries, and after each directory at ``depth`` what is in it.

    The directories are dealt to the tasks by name, with an explicit count: their rows are tiny, so a count
    chosen from their size would put all the listing into one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(ENTRY.names).cast(to_arrow_schema(ENTRY))
            for folder, rel_dir, name, mtime, level in zip(
                    *(batch.column(c).to_pylist() for c in ("folder", "rel_dir", "name", "mtime_ms", "depth"))):
                if level == depth and (mtime is None or mtime >= since_ms):
                    yield from entry_batches(children(folder, f"{rel_dir}/{name}" if rel_dir else name, depth))

    return spread_files(entries.withColumn("depth", dir_depth()), ["folder", "rel_dir", "name"]).mapInArrow(run, ENTRY)


def open_folders(folders: DataFrame) -> DataFrame:
    """What lies directly in the source folders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                yield from entry_batches(children(folder, "", 0))

    return folders.select("folder").mapInArrow(run, ENTRY)


def with_content(entries: DataFrame, wanted: str) -> DataFrame:
    """The (small) texts of the files whose names match the pattern ``wanted``.

    A column of its own, so that no file is opened where nobody asks for the texts.
    """

    @F.arrow_udf(T.StringType())
    def texts(paths: pa.Array, names: pa.Array, dirs: pa.Array) -> pa.Array:
        named = re.compile(wanted)
        rows = zip(paths.to_pylist(), names.to_pylist(), dirs.to_pylist())
        return pa.array([None if is_dir or not named.match(name) else read_text(path) for path, name, is_dir in rows], pa.string())

    parts = [F.nullif(F.col(c), F.lit("")) for c in ("folder", "rel_dir", "name")]
    return entries.withColumn("content", texts(F.concat_ws("/", *parts), "name", "is_dir")).select(*ENTRY.names)


def read_text(path: str) -> str | None:
    """Text of a file; null if it has gone since it was listed."""
    system, inner = locate(path)
    try:
        with system.open_input_stream(inner, compression=None) as stream:
            return stream.read().decode("utf-8", "replace")
    except FileNotFoundError:
        return None


def is_file(path: str) -> bool:
    system, inner = locate(path)
    return system.get_file_info(inner).type == fs.FileType.File


CONTROL_FILES = "|".join(p.strip("^").rstrip("$") + "$" for p in (SIDECAR_FILE, ACK_FILE, LOSS_FILE))


def scan_landing_zone(
    spark: SparkSession, folders: list[str], content: str | None = None, since_ms: int = 0
) -> DataFrame:
    """Entries of the source folders down to ``<folder>/<group>/<session>/<file>``, dot-files
    included, which Spark's own file sources hide.

    ``content`` is a pattern of file names whose (small) text is read along. Sessions of a group
    whose directory was last changed before ``since_ms`` are named, but not opened. Directories
    are listed level by level, each level dealt anew, so a group of many sessions is spread.
    """
    roots = spark.createDataFrame([(f.rstrip("/"),) for f in folders], "folder string")
    entries = open_dirs(open_dirs(open_folders(spread_files(roots, "folder", len(folders) or 1)), GROUPS), SESSIONS, since_ms)
    return with_content(entries, content) if content else entries


def in_session(entries: DataFrame) -> DataFrame:
    """Replace folder and rel_dir by the session's parent directory and name."""
    parts = F.split(F.concat_ws("/", "folder", "rel_dir"), "/")
    return entries.withColumns({
        "folder": F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"),
        "session_id": F.element_at(parts, -1),
    }).drop("rel_dir")


def _named(entries: DataFrame, pattern: str) -> DataFrame:
    return in_session(entries.where(~F.col("is_dir") & F.col("name").rlike(pattern)))


def _numbered(pattern: str, channel: int, sequence: int) -> list[Column]:
    return [
        F.regexp_extract("name", pattern, channel).alias("channel"),
        F.regexp_extract("name", pattern, sequence).try_cast("bigint").alias("window_sequence"),
    ]


def list_windows(entries: DataFrame, producer: str | None = None) -> DataFrame:
    """Log windows of the listing's sessions, without opening them.

    Files elsewhere (beside the sessions, in hidden or working directories, below a
    session) are no windows. ``producer`` as in ``session_catalog``.
    """
    found = entries.where(~F.col("is_dir") & F.col("name").rlike(PAYLOAD_FILE) & (F.col("rel_dir") != ""))
    paths = found.withColumn("path", F.concat_ws("/", "folder", "rel_dir", "name"))
    windows = parse_window_path(paths.drop("folder")).select(
        *WINDOW, F.col("name").alias("file_name"), "path", "is_gz",
        F.col("size").alias("length"), "mtime_ms",
    )
    known = session_catalog(entries, producer=producer).select(*SESSION)
    return lookup(windows, known, SESSION, ["channel", "window_sequence"], how="left_semi")


def in_zone(path: Column, folders: list[str]) -> Column:
    """Whether a file lies where a session's files do: ``<folder>/[<group>/]<session>/<file>``."""
    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    roots = "|".join(re.escape(re.sub(scheme, "", folder).rstrip("/")) for folder in folders)
    return F.regexp_replace(path, scheme, "").rlike(rf"^(?:{roots})/+(?:[^/.][^/]*/+){{1,2}}[^/]+$")


def scan_windows(spark: SparkSession, folders: list[str], with_content: bool = False) -> DataFrame:
    """Log windows by Spark's own binary file source; the bytes are read only on request.

    Windows below a directory that itself holds windows are left out, as in ``list_windows``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.log*")
        .load(folders)
        .where(in_zone(F.col("path"), folders))
    )
    columns = [F.unix_millis("modificationTime").alias("mtime_ms"), "length"]
    named = files.select(
        F.regexp_replace("path", "^file:/+", "/").alias("path"), *columns,
        *(["content"] if with_content else []),
    )
    windows = parse_window_path(named).withColumn("file_name", F.element_at(F.split("path", "/"), -1))
    above = parse_window_path(files.select(F.regexp_replace("path", "^file:/+", "/").alias("path")))
    above = above.where(F.col("channel").isin(CHANNELS)).select(F.concat_ws("/", *SESSION).alias("folder")).distinct()
    return lookup(windows, above, ["folder"], ["session_id", "window_sequence"], how="left_anti")


def written_by(entries: DataFrame, producer: str) -> DataFrame:
    """Entries that carry the producer's name, so that no other program's marker counts."""
    return entries.where(F.col("name").startswith(f".{producer}-"))


def scan_sidecars(entries: DataFrame, producer: str) -> DataFrame:
    """Sidecars (entries with content) of a producer, by the window that their name refers to.

    Unreadable text gives a row flagged ``malformed``; absent numbers are 0.
    """
    found = _named(written_by(entries, producer), SIDECAR_FILE)
    return _sidecars(found.select(*SESSION, *_numbered(SIDECAR_FILE, 2, 3), "content"))


def sidecars_of(windows: DataFrame, producer: str) -> DataFrame:
    """The sidecars of the given windows as ``scan_sidecars`` gives them, opened by their names without a listing."""
    name = F.concat_ws(".", F.lit(f".{producer}-window"), "channel", "window_sequence", F.lit("json"))
    schema = T.StructType([*[windows.schema[c] for c in WINDOW], T.StructField("content", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([read_text(path) if is_file(path) else None for path in batch.column("path").to_pylist()], pa.string())
            columns = [*(batch.column(c) for c in WINDOW), texts]
            yield pa.RecordBatch.from_arrays(columns, names=arrow.names).cast(arrow).filter(texts.is_valid())

    named = windows.select(*WINDOW).distinct().withColumn("name", name).where(F.col("name").rlike(SIDECAR_FILE))
    paths = named.select(*WINDOW, F.concat_ws("/", *SESSION, "name").alias("path"))
    return _sidecars(spread_files(paths).mapInArrow(run, schema))


def _sidecars(found: DataFrame) -> DataFrame:
    schema = T.StructType([*SIDECAR.fields, T.StructField("_corrupt", T.StringType())])
    record = F.from_json("content", schema, {"columnNameOfCorruptRecord": "_corrupt"})
    read = found.select(
        *WINDOW,
        (record.isNull() | record["_corrupt"].isNotNull()
         | ~F.coalesce(F.ltrim("content").startswith("{"), F.lit(False))).alias("malformed"),
        record.alias("_record"),
    )
    renamed = {"session_id": "meta_session_id", "channel": "meta_channel", "window_sequence": "meta_window_sequence"}
    fields = []
    for field in SIDECAR.fields:
        value = F.col("_record")[field.name]
        if not isinstance(field.dataType, T.StringType):
            value = F.coalesce(value, F.lit(0).cast(field.dataType))
        fields.append(value.alias(renamed.get(field.name, field.name)))
    return read.select(*WINDOW, "malformed", *fields)


def scan_acks(entries: DataFrame, producer: str) -> DataFrame:
    """A producer's acknowledgement markers; their text is the acknowledged window id."""
    return _named(written_by(entries, producer), ACK_FILE).select(
        *SESSION, *_numbered(ACK_FILE, 2, 3),
        F.regexp_replace("content", r"^[\x00-\x20]+|[\x00-\x20]+$", "").alias("window_id"),
    )


def scan_losses(entries: DataFrame, producer: str) -> DataFrame:
    """A producer's loss markers; channel and number are known for the agent's own ones."""
    record = F.from_json("content", LOSS)
    return _named(written_by(entries, producer), LOSS_FILE).select(
        *SESSION,
        F.nullif(F.regexp_extract("name", AGENT_LOSS_FILE, 1), F.lit("")).alias("channel"),
        F.regexp_extract("name", AGENT_LOSS_FILE, 2).try_cast("bigint").alias("window_sequence"),
        record["source"].alias("source"),
        record["reason"].alias("reason"),
    )


def scan_settled(entries: DataFrame) -> DataFrame:
    """Outcome markers of sessions."""
    found = in_session(entries.where(~F.col("is_dir") & F.col("name").isin(UPLOADED_MARKER, FAILED_MARKER)))
    return found.select(*SESSION, F.regexp_replace("name", r"^\.", "").alias("outcome"))


def parse_cursors(texts: DataFrame, text: str = "value") -> DataFrame:
    """Stream positions of cursor files; empty or corrupt text gives no rows."""
    streams = F.from_json(text, CURSOR_FILE)["streams"]
    pairs = texts.select(F.explode(F.map_entries(streams)).alias("_entry"))
    key, position = F.col("_entry.key"), F.col("_entry.value")
    return pairs.select(
        F.regexp_extract(key, r"^(.*)\.([^.]*)$", 1).alias("session_id"),
        F.regexp_extract(key, r"^(.*)\.([^.]*)$", 2).alias("channel"),
        F.coalesce(position["fileIndex"], F.lit(0)).cast("bigint").alias("file_index"),
        F.coalesce(position["offset"], F.lit(0)).alias("read_offset"),
        F.coalesce(position["fileSize"], F.lit(0)).alias("file_size"),
        F.coalesce(position["headSig"], F.lit(0)).alias("head_sig"),
    )


def scan_cursors(spark: SparkSession, path: str, sessions: DataFrame) -> DataFrame:
    """Cursor file of another agent run. Its keys lack the folder, so a position goes to
    every session of that name."""
    positions = parse_cursors(spark.read.text(path, wholetext=True))
    return sessions.select(*SESSION).distinct().join(positions, "session_id")
