"""SentencePiece encoding and decoding with a byte-pair vocabulary, by forward search over shared prefixes.

A text's pieces are those that repeated merging of the best-ranked pair gives. The last piece of a prefix's
segmentation is unique, and a sequence of pieces is a segmentation if each two neighbours are one of what
they spell. So a forward pass can keep, for each prefix, the last piece and where it starts: among pieces
that end there, the one that goes with the last piece before it. Those values depend on the prefix alone and
are shared by all words with it. (Adding up the vocabulary's scores instead, as for a unigram vocabulary,
would give other pieces, because this vocabulary's scores are merge ranks.)
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MARK = "▁"
#: Words a task keeps with their ids; the cache starts anew beyond it.
CACHE = 300_000
#: Lengths of pieces that any word may end in.
SHORT = (2, 1)
#: Codes of pieces are their ids; a character that the vocabulary lacks has its code point beyond this.
LACKING = 1 << 24


class Vocabulary(NamedTuple):
    ids: dict[str, int]
    ranks: dict[str, float]  # of pieces that are merged; the lowest is merged first
    splits: dict[str, tuple[str, str]]  # the last merge of a piece
    ends: dict[str, tuple[int, ...]]  # lengths of the pieces that end in these three characters, then 2 and 1
    bytes: list[int]  # ids of single bytes
    shown: list[bytes]  # what each id decodes to
    splitter: re.Pattern[str]


def merge_all(text: str, ranks: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Pieces of a short text by repeated merging, leftmost first among equals, and the last merge."""
    parts, last = list(text), None
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], np.inf))
        if parts[best] + parts[best + 1] not in ranks:
            break
        last = (parts[best], parts[best + 1])
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts, last


def load(path: str) -> Vocabulary:
    """Tables of a vocabulary file; their size is the vocabulary's, whatever the data."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, ranks, single = {}, {}, [0] * 256
    shown = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            single[int(piece[3:-1], 16)] = i
            shown.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            shown.append(b"" if not model.is_unknown(i) else " ⁇ ".encode())
        else:
            ids[piece] = i
            shown.append(piece.replace(MARK, " ").encode())
            if len(piece) > 1:
                ranks[piece] = -model.get_score(i)
    splits = {}
    for piece in list(ranks):
        parts, last = merge_all(piece, ranks)
        if len(parts) == 1 and last:
            splits[piece] = last
    # A piece that its own merges don't reach can't be in a segmentation.
    ids = {p: i for p, i in ids.items() if len(p) == 1 or p in splits}
    lengths: dict[str, set[int]] = {}
    for p in ids:
        if len(p) > 2:
            lengths.setdefault(p[-3:], set()).add(len(p))
    ends = {end: (*sorted(found, reverse=True), *SHORT) for end, found in lengths.items()}
    if any(MARK in p.lstrip(MARK) for p in ids):
        raise ValueError("the vocabulary joins words")
    joined = {c for p in splits for c in p}
    loose = "".join(re.escape(c) for c in "\n\t\r" if c not in joined)
    splitter = re.compile(rf"[{loose}]|{MARK}*[^{MARK}{loose}]+|{MARK}+" if loose else rf"{MARK}*[^{MARK}]+|{MARK}+")
    return Vocabulary(ids, ranks, splits, ends, single, shown, splitter)


class Encoder:
    """Ids of marked words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.fits: dict[int, bool] = {}  # by the codes of two pieces
        self.known: dict[str, bytes] = {}

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging what two pieces spell gives just these two.

        Merges inside the pieces are undone, latest first; the pieces fail if ever the parts that meet would
        have been merged before the merge undone last. Of equal ranks the left one was done first.
        """
        ranks, splits = self.v.ranks, self.v.splits
        limit, right = np.inf, False
        while True:
            rank = ranks.get(a + b, np.inf)
            if rank < limit or right and rank == limit:
                return False
            rank_a, rank_b = (ranks[p] if p in splits else -1.0 for p in (a, b))
            if rank_a < 0 and rank_b < 0:
                return True
            right = rank_a <= rank_b
            if right:
                limit, b = rank_b, splits[b][0]
            else:
                limit, a = rank_a, splits[a][1]

    def learn(self, words: set[str]) -> None:
        """Encode new words in sorted order, that is depth first over their trie; each step goes back to the
        longest prefix shared with the word before and on from there."""
        ids, ends, fits, single = self.v.ids, self.v.ends, self.fits, self.v.bytes
        if len(fits) > 2_000_000:
            fits.clear()
        starts, last = [0], [0]  # per prefix length: where its last piece starts, and the piece's code
        before = ""
        for word in sorted(words):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del starts[shared + 1 :], last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for length in ends.get(word[end - 3 : end], SHORT) if end > 2 else SHORT:
                    start = end - length
                    if start < 0:
                        continue
                    code = ids.get(word[start:end])
                    if code is not None:
                        if not start:
                            break
                        pair = last[start] << 32 | code
                        fit = fits.get(pair)
                        if fit is None:
                            fit = fits[pair] = self.compatible(word[starts[start] : start], word[start:end])
                        if fit:
                            break
                else:
                    start, code = end - 1, LACKING + ord(word[end - 1])
                starts.append(start)
                last.append(code)
            found = array("I")
            end = len(word)
            while end:
                code = last[end]
                if code < LACKING:
                    found.append(code)
                else:
                    found.extend([single[b] for b in reversed(word[end - 1].encode())])
                end = starts[end]
            found.reverse()
            self.known[word] = found.tobytes()
            before = word

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        rows = [self.v.splitter.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > CACHE:
            self.known = {}
        self.learn(set().union(*rows) - self.known.keys())
        known = self.known
        return [np.frombuffer(b"".join([known[w] for w in row]), "<u4") for row in rows]

    def decode(self, ids: np.ndarray) -> str:
        shown = self.v.shown
        return b"".join([shown[i] for i in ids.tolist()]).decode("utf-8", "replace")[1:]


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``ids``, the pieces of the whole text; none for null and empty texts.

    Each Arrow batch encodes the words that its task hasn't met yet, so nothing is shuffled and a task holds
    a bounded cache. Rows that repeat or lack an id are handled like others; an empty table gives no rows;
    other columns play no part.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            found = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
            ids = pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["id", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and ``text``; null and empty id lists give an empty text."""
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Encoder(vocabulary)
        for batch in batches:
            texts = [decoder.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_ids``, ``ids_crc32`` (of little-endian 32-bit ids), ``round_trip``: decoding gives the text.

    Encoding and decoding in one pass, for tables whose id lists needn't be stored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = encoder.encode(texts)
            same = [encoder.decode(x) == t for x, t in zip(found, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array([zlib.crc32(x) for x in found], pa.int64()),
                 pa.array(same, pa.bool_())], names=["id", "n_ids", "ids_crc32", "round_trip"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_ids long, ids_crc32 long, round_trip boolean").withColumnRenamed("id", id_col)
