"""File access inside tasks: reading windows, writing markers, copying payloads.

Paths may be plain or URIs of any file system that Arrow knows. Work is spread by path,
with an explicit partition count: the rows that name the files are tiny, so a count
chosen from their size would put all the reading into one task.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from logharbor.schemas import HEAD_SIGNATURE_BYTES, WINDOW

BLOCK = 4 << 20


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path; ``file:/x`` as Spark writes it means ``/x``."""
    local = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(local)


def spread_files(df: DataFrame, path: str | list[str] = "path", tasks: int | None = None) -> DataFrame:
    """Deal the rows anew to ``tasks`` tasks; 0 leaves them where they are."""
    if tasks == 0:
        return df
    count = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(count, *([path] if isinstance(path, str) else path))


# -- lines ---------------------------------------------------------------------------


def _line_array(block: bytes, ends: np.ndarray) -> pa.Array:
    """Lines of a block as strings, without their newlines; ``ends`` are the positions
    after each line."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    lines = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(block))
    try:
        lines.validate(full=True)
    except pa.ArrowInvalid:
        texts = [block[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])]
        lines = pa.array(texts, pa.string())
    return pc.ascii_rtrim(lines, characters="\n")


def _file_lines(path: str, is_gz: bool) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Blocks of (lines, byte starts, byte ends) counted in uncompressed bytes."""
    system, inner = locate(path)
    base, rest = 0, b""
    with system.open_input_stream(inner, compression="gzip" if is_gz else None) as stream:
        while True:
            chunk = stream.read(BLOCK)
            block = rest + chunk
            cut = len(block) if not chunk else block.rfind(b"\n") + 1
            block, rest = block[:cut], block[cut:]
            if block:
                ends = np.flatnonzero(np.frombuffer(block, np.uint8) == 10) + 1
                if not len(ends) or ends[-1] != len(block):
                    ends = np.append(ends, len(block))
                starts = np.concatenate([[0], ends[:-1]])
                yield _line_array(block, ends), base + starts, base + ends
                base += len(block)
            if not chunk:
                return


LINE_FIELDS = [
    T.StructField("line_no", T.LongType()),
    T.StructField("byte_start", T.LongType()),
    T.StructField("byte_end", T.LongType()),
    T.StructField("line", T.StringType()),
]


def read_lines(windows: DataFrame, tasks: int | None = None, with_faults: bool = False) -> DataFrame:
    """Lines of the given log windows (``path``, ``is_gz``), plain or gzip.

    Lines end at ``\\n`` only and are numbered from 1. Byte positions are those of the
    uncompressed content and include the newline; bytes that are not UTF-8 are replaced.
    The columns of ``windows`` other than the path are kept.

    A file that can't be read to its end, say a truncated gzip, ends the job. With
    ``with_faults`` it ends only its own window: after the whole lines before the fault
    comes a row without line whose ``fault`` says what happened, from where to retry.
    """
    kept = [f for f in windows.schema.fields if f.name not in ("path", "is_gz")]
    fault = [T.StructField("fault", T.StringType())] if with_faults else []
    schema = T.StructType([*kept, *LINE_FIELDS, *fault])
    arrow = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                path, is_gz = batch.column("path")[n].as_py(), batch.column("is_gz")[n].as_py()
                count = at = 0

                def rows(numbers, starts, ends, lines, reason=None) -> pa.RecordBatch:
                    same = [pa.repeat(batch.column(f.name)[n], len(lines)) for f in kept]
                    said = [pa.array([reason] * len(lines), pa.string())] if with_faults else []
                    arrays = [*same, pa.array(numbers), pa.array(starts), pa.array(ends), lines, *said]
                    return pa.RecordBatch.from_arrays(arrays, names=arrow.names).cast(arrow)

                try:
                    for lines, starts, ends in _file_lines(path, is_gz):
                        yield rows(np.arange(count + 1, count + 1 + len(lines)), starts, ends, lines)
                        count, at = count + len(lines), int(ends[-1])
                except OSError as error:
                    if not with_faults:
                        raise
                    yield rows([count + 1], [at], [at], pa.array([None], pa.string()), str(error))

    return spread_files(windows, tasks=tasks).mapInArrow(task, schema)


# -- checksums -----------------------------------------------------------------------


def _sum(system: fs.FileSystem, inner: str) -> tuple[int, int]:
    """Length and CRC32 of the stored bytes."""
    crc = length = 0
    with system.open_input_stream(inner, compression=None) as stream:
        while chunk := stream.read(BLOCK):
            crc, length = zlib.crc32(chunk, crc), length + len(chunk)
    return length, crc


def _digest(path: str, is_gz: bool) -> tuple[int, int, int]:
    """Length and CRC32 of the stored bytes, and the signature of the uncompressed head."""
    system, inner = locate(path)
    length, crc = _sum(system, inner)
    try:
        with system.open_input_stream(inner, compression="gzip" if is_gz else None) as stream:
            head = stream.read(HEAD_SIGNATURE_BYTES)
    except OSError:
        head = b""
    return length, crc, (zlib.crc32(head) or 1) if head else 0


def hash_payloads(windows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Add ``length``, ``crc32`` and ``head_sig``; the bytes never leave the reading task.

    A file that vanished in the meantime or can't be read gets nulls.
    """
    kept = [f for f in windows.schema.fields if f.name not in ("length", "crc32", "head_sig")]
    added = [T.StructField(n, T.LongType()) for n in ("length", "crc32", "head_sig")]
    schema = T.StructType([*kept, *added])
    arrow = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path, is_gz in zip(batch.column("path").to_pylist(), batch.column("is_gz").to_pylist()):
                try:
                    found.append(_digest(path, is_gz))
                except OSError:
                    found.append((None, None, None))
            columns = list(zip(*found)) or [[], [], []]
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=arrow.names).cast(arrow)

    return spread_files(windows, tasks=tasks).mapInArrow(task, schema)


def read_payloads(windows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Add ``content``, the stored bytes of each file, one file at a time."""
    schema = T.StructType([*windows.schema.fields, T.StructField("content", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, path in enumerate(batch.column("path").to_pylist()):
                system, inner = locate(path)
                with system.open_input_stream(inner, compression=None) as stream:
                    content = pa.array([stream.read()], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.slice(n, 1).columns, content], schema=arrow)

    return spread_files(windows, tasks=tasks).mapInArrow(task, schema)


# -- writing -------------------------------------------------------------------------


def _publish(system: fs.FileSystem, target: str, write) -> None:
    """Write next to the target and rename, so that nobody sees half a file."""
    folder = target.rpartition("/")[0]
    system.create_dir(folder, recursive=True)
    partial = f"{folder}/.partial-{uuid.uuid4().hex}"
    with system.open_output_stream(partial, compression=None) as stream:
        write(stream)
    system.move(partial, target)


def write_new_files(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Write ``content`` (binary) to ``path`` where no file exists yet; with ``is_gz`` it is
    compressed. An existing file is never replaced, so a repeated task changes nothing.

    Used for markers that other programs look for on disk. Returns path and ``written``.
    """
    schema = T.StructType([
        T.StructField("path", T.StringType()), T.StructField("written", T.BooleanType()),
    ])
    gz = "is_gz" in files.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for batch in batches:
            done = []
            paths = batch.column("path").to_pylist()
            packed = batch.column("is_gz").to_pylist() if gz else [False] * len(paths)
            for n, (path, is_gz) in enumerate(zip(paths, packed)):
                system, inner = locate(path)
                missing = system.get_file_info(inner).type == fs.FileType.NotFound
                if missing:
                    content = batch.column("content")[n].as_py()
                    data = gzip.compress(content, mtime=0) if is_gz else content
                    _publish(system, inner, lambda stream: stream.write(data))
                done.append(missing)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(done, pa.bool_())], names=["path", "written"]
            )

    return spread_files(files, tasks=tasks).mapInArrow(task, schema)


def _archive(path: str, target: str) -> tuple[int | None, str]:
    """Copy a file where nothing lies yet; byte count and status."""
    system, inner = locate(path)
    out_system, out_inner = locate(target)
    if out_system.get_file_info(out_inner).type != fs.FileType.NotFound:
        here, there = _sum(system, inner), _sum(out_system, out_inner)
        return (here[0], "present") if here == there else (None, "conflict")
    copied = 0

    def copy(out) -> None:
        nonlocal copied
        with system.open_input_stream(inner, compression=None) as stream:
            while chunk := stream.read(BLOCK):
                out.write(chunk)
                copied += len(chunk)

    _publish(out_system, out_inner, copy)
    return copied, "copied"


def _encoded(folder: str) -> str:
    """A relative path that no other folder gets; its parts hold no special characters."""
    parts = [quote(part, safe="") or "%" for part in folder.split("/")]
    return "/".join(part.replace(".", "%2E") if part in (".", "..") else part for part in parts)


def archive_windows(windows: DataFrame, destination: str, tasks: int | None = None) -> DataFrame:
    """Copy each payload unchanged to ``<destination>/<folder>/<session>/<archive_key>`` and
    return the manifest with the byte count.

    Folder and session are part of the path because the key alone holds only the file name.
    ``status`` is ``copied``; ``present`` where the same bytes lay there already, so a
    repeated task changes nothing; ``conflict`` where other bytes do, which are left alone;
    ``unreadable`` where the payload or the target failed.
    """
    schema = T.StructType([
        *[windows.schema[c] for c in WINDOW],
        T.StructField("archive_path", T.StringType()),
        T.StructField("copied_bytes", T.LongType()),
        T.StructField("status", T.StringType()),
    ])
    arrow = to_arrow_schema(schema)
    root = destination.rstrip("/")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for row in batch.select(["path", "folder", "session_id", "archive_key"]).to_pylist():
                target = f"{root}/{_encoded(row['folder'])}/{_encoded(row['session_id'])}/{row['archive_key']}"
                try:
                    done.append((target, *_archive(row["path"], target)))
                except OSError:
                    done.append((target, None, "unreadable"))
            arrays = [batch.column(c) for c in WINDOW]
            arrays += [pa.array(c) for c in zip(*done)] if done else [pa.array([])] * 3
            yield pa.RecordBatch.from_arrays(arrays, names=arrow.names).cast(arrow)

    return spread_files(windows, tasks=tasks).mapInArrow(task, schema)
