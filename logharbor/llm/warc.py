"""WARC archives of pages: dictionary-compressed records, copies as revisits, and reading them back."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logharbor.llm.frames import bounded_sample
from logharbor.session import materialize, scratch_path
from logharbor.sources.files import locate

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Records a dictionary is built from, at most, the bytes taken of each, and the dictionary's size.
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16 << 10, 64 << 10
#: Payload bytes after which a task starts another archive.
ARCHIVE_BYTES = 16 << 20
LEVEL = 3


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with the payload, or a revisit with the head of its response only."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    target = "".join(c if c.isprintable() and c != " " else "%%%02X" % ord(c) for c in url or "")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = b"".join(f"{name}: {value}\r\n".encode() for name, value in fields if value)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> bytes:
    """A Zstandard dictionary of the sample records; raw content where there is too little to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or VERSION


def write_archives(folder: str, dictionary: bytes):
    """Each task writes its records to archives of its own; names hold no task number, so a repeated task
    leaves the lost one's files unnamed in the result. Yields a row per archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        trained = zstandard.ZstdCompressionDict(dictionary)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
        lead = struct.pack("<II", SKIPPABLE, len(packed)) + packed
        frames: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            system, inner = locate(f"{folder}/{uuid.uuid4().hex}.warc.zst")
            system.create_dir(inner.rpartition("/")[0], recursive=True)
            with system.open_output_stream(inner, compression=None) as out:
                out.write(lead)
                for frame in frames:
                    out.write(frame)
            row = [pa.array([inner.rpartition("/")[2]]), pa.array([len(frames)], pa.int64())]
            return pa.RecordBatch.from_arrays(row, names=["archive", "records"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(5)]
            for page_id, url, html, digest, refers_to in zip(*columns):
                payload = (html or "").encode()
                frames.append(compressor.compress(record(page_id, url, payload, digest, refers_to)))
                size += len(payload)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    frames, size = [], 0
        if frames:
            yield close()

    return write


def frames_of(content: bytes) -> Iterator[bytes]:
    """Decompressed records of an archive, by the dictionary in its leading skippable frame."""
    import zstandard

    magic, size = struct.unpack_from("<II", content)
    if magic != SKIPPABLE:
        raise ValueError("the archive doesn't begin with a dictionary frame")
    dictionary = zstandard.ZstdDecompressor().decompress(content[8 : 8 + size])
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    rest = content[8 + size :]
    while rest:
        one = decompressor.decompressobj()
        yield one.decompress(rest)
        rest = one.unused_data if len(one.unused_data) < len(rest) else b""


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Fields, head of the response and payload of a record."""
    lead, _, rest = data.partition(b"\r\n\r\n")
    lines = lead.decode().split("\r\n")
    if lines[0].encode() != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    return fields, head, payload


def number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for data in frames_of(content.as_py()):
                fields, head, payload = parse(data)
                length = next(int(x[15:]) for x in head.decode().split("\r\n") if x.startswith("Content-Length:"))
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response" and sha1_base32(payload) != digest:
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
                rows.append((number(fields.get("WARC-Record-ID")), fields.get("WARC-Target-URI"), length, digest,
                             fields["WARC-Type"], number(fields.get("WARC-Refers-To"))))
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["page_id", "target_uri", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def write_pages(pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per page below ``folder`` and return the archives' names and record counts.

    Of pages with equal payloads of at least ``least_bytes`` bytes, the one with the smallest id is the
    response and the others revisit it; null counts as empty. Rows without id are always responses, and so
    are all rows that repeat the smallest id.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    sizes = rows.select("page_id", "digest", F.octet_length("html").alias("bytes"))
    first = sizes.where((F.col("bytes") >= least_bytes) & F.col("page_id").isNotNull())
    first = first.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    first = materialize(first.select("digest", "first"), "copies")
    sample = bounded_sample(
        rows.select("page_id", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html")), ["page_id"], SAMPLES).collect()
    dictionary = build_dictionary([record(r["page_id"], r["url"], r["html"].encode(), "", None) for r in sample])
    refers = F.when(F.col("first") < F.col("page_id"), F.col("first"))
    marked = rows.join(first, "digest", "left").select("page_id", "url", "html", base32(F.col("digest")).alias("digest"), refers.alias("refers_to"))
    return materialize(marked.mapInArrow(write_archives(folder, dictionary), "archive string, records long"), "archives")


def base32(digest: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1 digest, by its bits in groups of five."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(digest, at, 10), 16, 2), 40, "0") for at in (1, 11, 21, 31)])
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.concat(*[F.substring(alphabet, F.conv(F.substring(bits, 5 * k + 1, 5), 2, 10).cast("int") + 1, F.lit(1)) for k in range(32)])


def read_pages(spark: SparkSession, folder: str, archives: DataFrame) -> DataFrame:
    """The records of the named archives: ``page_id``, ``target_uri``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``. Responses are checked against their digest."""
    stored = spark.read.format("binaryFile").load(folder).select("content", F.element_at(F.split("path", "/"), -1).alias("archive"))
    named = stored.join(archives.select("archive"), "archive", "left_semi").select("content")
    return named.mapInArrow(read_records, "page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and return what reading them back gives."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    archives = write_pages(pages, folder)
    if archives.isEmpty():
        return spark.createDataFrame([], "page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read_pages(spark, folder, archives)
