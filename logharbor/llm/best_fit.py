"""Packing of token sequences by a best-fit plan over the histogram of lengths."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logharbor.llm.frames import sliced
from logharbor.llm.words import text_bytes, word_hashes
from logharbor.session import materialize

CAPACITY = 2048
END = 0
#: Words kept with their ids while a task encodes; the cache starts anew beyond it.
CACHE = 1_000_000
#: Rows of one length that are numbered together; a length with more is dealt into as many groups as needed.
GROUP = 100_000


def word_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte positions at which texts can be cut without changing any id.

    The vocabulary's splitting rule lets a word take one space in front of it. So a single space between two
    visible characters always opens a new word; only characters of ASCII and Latin-1 are relied on here, and
    between others the text stays in one piece, which is still right.
    """
    visible = (data > 0x20) & (data < 0x7F)
    accented = np.zeros(len(data) + 1, bool)  # last byte of a Latin-1 letter
    accented[1:] = data == 0xC3
    cut = np.zeros(len(data) + 1, bool)
    inner = (data == 0x20)[1:-1] & (visible | accented[:-1])[:-2] & (visible | (data == 0xC3))[2:]
    cut[1 : len(data) - 1] = inner
    cut[np.maximum(bounds - 1, 0)] = False  # the last character of a text isn't followed by its own
    cut[bounds] = True
    return np.flatnonzero(cut[:-1])


class Encoder:
    """Token ids of texts; each distinct word of a task is encoded once, words being told apart by hash.

    ``ranks_path`` holds the same byte-level vocabulary as ``tokenizer_path``, for the library that encodes
    words faster; the ids are the same. Texts with special tokens go to the tokenizer whole, because a
    special token also cuts the white space around it.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.opens_word = np.zeros(max(ranks.values()) + 1, bool)
        self.opens_word[[rank for token, rank in ranks.items() if token.startswith(b" ")]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted, with the place of each word's ids
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode new words; those that are a space and no further one are encoded in one go."""
        spaces = np.append(0, np.cumsum(data == 0x20))
        simple = (data[starts] == 0x20) & (spaces[ends] - spaces[starts] == 1) & (ends - starts > 1)
        raw = data.tobytes()
        alone = [self.fast.encode_ordinary(raw[a:b].decode()) for a, b in zip(starts[~simple].tolist(), ends[~simple].tolist())]
        joined = b"".join(raw[a:b] for a, b in zip(starts[simple].tolist(), ends[simple].tolist())).decode()
        ids = np.array(self.fast.encode_ordinary(joined), "<u4")
        opened = np.append(np.flatnonzero(self.opens_word[ids]), len(ids))
        sizes = np.zeros(len(hashes), np.int64)
        sizes[simple], sizes[~simple] = np.diff(opened), [len(a) for a in alone]
        at = np.zeros(len(hashes), np.int64)
        base = len(self.ids)
        at[simple] = base + opened[:-1]
        at[~simple] = base + len(ids) + np.append(0, np.cumsum(sizes[~simple]))[:-1]
        self.ids = np.concatenate([self.ids, ids, np.array([x for a in alone for x in a], "<u4")])
        both = np.concatenate([self.hashes, hashes])
        order = np.argsort(both, kind="stable")
        self.hashes = both[order]
        self.starts, self.sizes = np.append(self.starts, at)[order], np.append(self.sizes, sizes)[order]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; nulls are empty."""
        data, bounds = text_bytes(texts, lower=False)
        if not len(data):
            return [np.zeros(0, "<u4")] * len(texts)
        starts = word_starts(data, bounds)
        ends = np.append(starts[1:], len(data))
        hashes = word_hashes(data, starts, ends)
        distinct, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > CACHE:
            self.forget()
        new = np.isin(distinct, self.hashes, assume_unique=True, invert=True)
        if new.any():
            self.learn(data, distinct[new], starts[first[new]], ends[first[new]])
        place = np.searchsorted(self.hashes, distinct)
        sizes = self.sizes[place][word]
        after = np.cumsum(sizes)
        ids = self.ids[np.arange(after[-1]) + np.repeat(self.starts[place][word] - after + sizes, sizes)]
        limits = np.append(0, after)[np.searchsorted(starts, bounds)]
        out = [ids[a:b] for a, b in zip(limits[:-1], limits[1:])]
        whole = [s.encode() for s in self.special]
        if any(s in data.tobytes() for s in whole):
            for i, text in enumerate(texts.to_pylist()):
                if text and any(s in text for s in self.special):
                    out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return out


def cut_pieces(vocabulary: tuple[str, str, str], capacity: int, end: int):
    """Pieces of each text's ids and the end id: only longer texts are cut, the first piece is the short one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*vocabulary)
        with np.errstate(over="ignore"):
            for batch in sliced(batches):
                rows: list[tuple] = []
                for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                    ids = np.append(ids, end).astype("<u4")
                    at, size, piece = 0, (len(ids) - 1) % capacity + 1, 0
                    while at < len(ids):
                        rows.append((doc, piece, at, size, zlib.crc32(ids[at : at + size])))
                        at, size, piece = at + size, capacity, piece + 1
                if rows:
                    types = [batch.schema.types[0], pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["id", "piece", "start", "length", "crc"])

    return cut


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots ``(length, first_rank, ranks, first_sequence, offset, per_sequence)``, longest lengths first.

    Best fit decreasing on counts: all pieces of a length are placed at once into the groups of sequences
    whose free space is the smallest that holds them. A slot puts ``ranks`` pieces, ``per_sequence`` to each
    sequence from ``first_sequence`` on, the first of each at ``offset``. Work and result grow with the
    number of different lengths, not with the pieces.
    """
    free: dict[int, list[list[int]]] = {}  # free space -> runs [first sequence, sequences]
    slots, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0

        def place(first: int, count: int, space: int, each: int) -> None:
            nonlocal rank, left
            slots.append((length, rank, count * each, first, capacity - space, each))
            rank, left = rank + count * each, left - count * each
            if space > each * length:
                free.setdefault(space - each * length, []).append([first, count])

        for space in sorted(s for s in free if s >= length):
            runs, each = free.pop(space), space // length
            while runs and left:
                first, count = runs.pop()
                full = min(count, left // each)
                if full:
                    place(first, full, space, each)
                if full < count:
                    if left:
                        place(first + full, 1, space, left)
                        full += 1
                    if full < count:
                        runs.append([first + full, count - full])
            if runs:
                free.setdefault(space, []).extend(runs)
            if not left:
                break
        each = capacity // length
        if left // each:
            count = left // each
            first, sequences = sequences, sequences + count
            place(first, count, capacity, each)
        if left:
            first, sequences = sequences, sequences + 1
            place(first, 1, capacity, left)
    return slots


def pack(
    docs: DataFrame, vocabulary: tuple[str, str, str], capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A text's ids are followed by ``end``; null counts as empty, so every row gives a piece. Pieces of one
    length take the length's slots in the order of a rank, which is made of a group number and a place in
    the group, so a length that holds a third of all pieces is numbered by many tasks. Rows that repeat an
    id or have none are packed like others. An empty table gives no rows; other columns play no part.
    ``vocabulary``: the arguments of :class:`Encoder`.

    The driver sees the histogram and the plan: at most ``capacity`` lengths, and slots bounded by them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    pieces = materialize(
        rows.mapInArrow(cut_pieces(vocabulary, capacity, end), f"id {kind}, piece int, start long, length long, crc long"), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = best_fit_plan(histogram, capacity)
    slots = spark.createDataFrame(
        plan or [(0,) * 6], "length long, low long, ranks long, first long, offset long, each long")

    groups = max(1, -(-max(histogram.values(), default=0) // GROUP))
    group = F.pmod(F.xxhash64("id", "piece", "crc"), F.lit(groups))
    grouped = pieces.withColumn("group", group)
    sizes = grouped.groupBy("length", "group").count()
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("length", "group").orderBy("id", "piece", "crc"))
    ranked = grouped.withColumn("place", place - 1).join(sizes, ["length", "group"]).withColumn("rank", F.col("before") + F.col("place"))
    within = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("low") + F.col("ranks"))
    step = F.col("rank") - F.col("low")
    return ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & within).select(
        F.col("id").alias(id_col), "piece", "start", ranked["length"], F.col("crc").alias("ids_crc32"),
        (F.col("first") + F.floor(step / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("offset") + F.pmod(step, "each") * ranked["length"]).cast("long").alias("offset"),
    )
