"""Toxic spans by a linear-chain conditional random field; documents by its marginals."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logharbor.llm.frames import bounded_sample, sliced
from logharbor.session import materialize

#: Labelled documents of each class that the model is fitted on, at most.
TOXIC_DOCS, CLEAN_DOCS = 1500, 3000
#: Windows of labelled tokens of each kind, at most, and the tokens to either side of their middle.
WINDOWS, SIDE = 4000, 6
#: A feature marks tokens as toxic if toxic documents hold it this much likelier than clean ones, and as many toxic ones
#: among its holders would come by chance at most so often. Near copies count once in either class.
ODDS, CHANCE = 40.0, 1e-3
#: Minhashes of a document in bands of ``ROWS``; documents with a band in common and this share of all are near copies.
HASHES, ROWS, ALIKE = 32, 4, 0.5
EPOCHS, RATE, DECAY = 80, 0.5, 0.02

WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """A token's features: the word, its stems of four to six letters and its last letters."""
    word = word.lower()
    return [f"w={word}", *(f"{n}={word[:n]}" for n in (4, 5, 6) if len(word) >= n), f"e={word[-3:]}"]


class Chain(NamedTuple):
    """Log-odds of each feature for a toxic token, of every token, and of staying toxic or turning so."""

    weights: dict[str, float]
    bias: float
    turn: float  # clean to toxic
    stay: float  # toxic to toxic
    slope: float  # document score: logistic in ``excess``
    base: float
    rate: float = 0.0  # mean marginal of the tokens of clean documents


class Emissions:
    """Distinct words with their log-odds, numbered and kept while a task reads."""

    def __init__(self, chain: Chain) -> None:
        self.chain = chain
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.scores = np.zeros(1024)

    def codes(self, words: list[str]) -> np.ndarray:
        """Number of each word; ``scores`` holds the log-odds by number."""
        numbers, weights = self.numbers, self.chain.weights
        for word in set(words).difference(numbers):
            if len(numbers) == len(self.scores):
                self.scores = np.append(self.scores, np.zeros(len(self.scores)))
            self.scores[len(numbers)] = self.chain.bias + sum(weights.get(f, 0.0) for f in features(word))
            numbers[word] = len(numbers)
        return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def marginals(scores: list[np.ndarray], turn: float, stay: float) -> list[np.ndarray]:
    """Chance of each token being toxic, for all sequences in step: token t of every sequence at once.

    With two states, forward and backward messages are one ratio each.
    """
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order], np.int64)
    if not len(order) or not lengths[0]:
        return [np.zeros(0) for _ in scores]
    flat = np.exp(np.clip(np.concatenate([scores[i] for i in order]), -30, 30))
    starts = np.append(0, np.cumsum(lengths))[:-1]
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")  # sequences longer than t
    t, s = math.exp(turn), math.exp(stay)
    forward, backward = np.empty(len(flat)), np.ones(len(flat))
    at = starts.copy()
    ratio = np.zeros(len(order))
    for n in active:
        here = at[:n]
        ratio = flat[here] * (t + s * ratio[:n]) / (1 + ratio[:n])
        forward[here] = ratio
        at[:n] += 1
    held = np.ones(len(order))  # backward ratio times emission of the token after
    for k in range(len(active) - 1, -1, -1):
        n = active[k]
        here = starts[:n] + k
        ends = lengths[:n] - 1 == k
        value = np.where(ends, 1.0, (1 + s * held[:n]) / (1 + t * held[:n]))
        backward[here] = value
        held[:n] = value * flat[here]
    both = forward * backward
    p = both / (1 + both)
    out: list[np.ndarray] = [np.zeros(0)] * len(scores)
    for i, a, n in zip(order, starts, lengths):
        out[i] = p[a : a + n]
    return out


def fit_chain(windows: list[tuple[list[str], list[int]]]) -> Chain:
    """Maximum conditional likelihood over windows of labelled tokens, all windows in step."""
    width = max(len(w) for w, _ in windows)
    names: dict[str, int] = {}
    rows = [[[names.setdefault(f, len(names)) for f in features(x)] for x in words] for words, _ in windows]
    most = 5
    index = np.full((len(windows), width, most), len(names))
    gold, real = np.zeros((len(windows), width)), np.zeros((len(windows), width))
    for i, row in enumerate(rows):
        for j, found in enumerate(row):
            index[i, j, : len(found)] = found
            gold[i, j], real[i, j] = windows[i][1][j], 1
    weights, speed = np.zeros(len(names) + 1), np.full(len(names) + 1, 1e-6)
    other, other_speed = np.array([-4.0, -1.0, 0.5]), np.full(3, 1e-6)  # bias, turn, stay
    pairs = real[:, 1:] * real[:, :-1]
    for _ in range(EPOCHS):
        emit = (weights[index].sum(axis=2) + other[0]) * real
        up, low = np.zeros_like(emit), np.zeros_like(emit)  # log messages forward, states toxic and clean
        for j in range(width):
            if j:
                up[:, j] = np.logaddexp(up[:, j - 1] + other[2], low[:, j - 1] + other[1]) + emit[:, j]
                low[:, j] = np.logaddexp(up[:, j - 1], low[:, j - 1])
            else:
                up[:, 0] = emit[:, 0] + other[1]
        b_up, b_low = np.zeros_like(emit), np.zeros_like(emit)
        for j in range(width - 2, -1, -1):
            on = pairs[:, j] > 0
            nxt_up, nxt_low = b_up[:, j + 1] + emit[:, j + 1], b_low[:, j + 1]
            b_up[:, j] = np.where(on, np.logaddexp(other[2] + nxt_up, nxt_low), 0)
            b_low[:, j] = np.where(on, np.logaddexp(other[1] + nxt_up, nxt_low), 0)
        total = np.logaddexp(up[:, 0] + b_up[:, 0], low[:, 0] + b_low[:, 0])[:, None]
        p = np.exp(up + b_up - np.logaddexp(up + b_up, low + b_low)) * real
        stayed = np.exp(up[:, :-1] + other[2] + emit[:, 1:] + b_up[:, 1:] - total) * pairs
        turned = np.exp(low[:, :-1] + other[1] + emit[:, 1:] + b_up[:, 1:] - total) * pairs
        diff = (gold - p) * real
        step = np.bincount(index.ravel(), np.repeat(diff.ravel(), most), len(names) + 1) - DECAY * weights
        step[-1] = 0
        speed += step * step
        weights += RATE * step / np.sqrt(speed)
        weights[-1] = 0
        both = gold[:, 1:] * gold[:, :-1] * pairs
        into = gold[:, 1:] * (1 - gold[:, :-1]) * pairs
        first = (gold[:, 0] - p[:, 0]).sum()
        step = np.array([diff.sum(), (into - turned).sum() + first, (both - stayed).sum()]) - DECAY * other
        other_speed += step * step
        other += RATE * step / np.sqrt(other_speed)
    kept = {f: float(weights[i]) for f, i in names.items() if abs(weights[i]) > 0.01}
    return Chain(kept, float(other[0]), float(other[1]), float(other[2]), 0.0, 0.0)


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and base of a document's score; a small penalty keeps them finite where classes part cleanly."""
    a, b = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((y - p) * x).sum() - 0.05 * a, (y - p).sum() - 0.05 * b])
        w = p * (1 - p) + 1e-9
        h = np.array([[(w * x * x).sum() + 0.05, (w * x).sum()], [(w * x).sum(), w.sum() + 0.05]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def held_out(doc_id: Column) -> Column:
    """Whether labels of the document may not be learned from; without id they may not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


MULTIPLY, ADD = np.random.default_rng(11).integers(1, 2**63, (2, HASHES), dtype=np.uint64) | np.uint64(1)


def hash_of(word: str) -> int:
    data = word.encode()
    return zlib.crc32(data) << 16 ^ zlib.adler32(data)


def signature(words: list[str]) -> bytes:
    """Minhashes of the text's runs of three words, in lower case; near copies share most of them."""
    least = None
    for at in range(0, max(1, len(words) - 2), 4096):
        part = [" ".join(words[i : i + 3]) for i in range(at, min(at + 4096, max(1, len(words) - 2)))]
        hashes = np.array([hash_of(x) for x in set(part)], np.uint64)
        mixed = (hashes ^ hashes >> np.uint64(23))[:, None] * MULTIPLY + ADD
        lowest = (mixed >> np.uint64(20)).min(axis=0)
        least = lowest if least is None else np.minimum(least, lowest)
    return least.tobytes()


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class and signature of each document that has words."""
    for batch in batches:
        words = [[w.lower() for w in WORD.findall(t or "")] for t in batch.column(0).to_pylist()]
        rows = [(toxic, signature(w)) for w, toxic in zip(words, batch.column(1).to_pylist()) if w]
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in rows], pa.int32()), pa.array([s for _, s in rows], pa.binary())], names=["toxic", "alike"])


def near_copies(found: list[bytes]) -> dict[bytes, int]:
    """Signature to the number of its group: that of the first one before it that it is a near copy of."""
    group: dict[bytes, int] = {}
    leads: list[np.ndarray] = []
    bands: dict[tuple[int, bytes], list[int]] = {}
    for one in sorted(set(found)):
        row = np.frombuffer(one, np.uint64)
        keys = [(k, row[k : k + ROWS].tobytes()) for k in range(0, HASHES, ROWS)]
        close = sorted({n for key in keys for n in bands.get(key, ())})
        n = next((n for n in close if (leads[n] == row).mean() >= ALIKE), len(leads))
        if n == len(leads):
            leads.append(row)
            for key in keys:
                bands.setdefault(key, []).append(n)
        group[one] = n
    return group


def evidence(groups: dict[int, dict[bytes, int]]):
    """Per document its distinct features and the number of its group of near copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [w.lower() for w in WORD.findall(text or "")]
                if words:
                    found = list({f for w in set(words) for f in features(w)[:-1]})
                    like = groups[toxic][signature(words)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found), pa.array([toxic] * len(found), pa.int32()), pa.array([like] * len(found), pa.int64())],
                        names=["feature", "toxic", "alike"])

    return run


def token_windows(lexicon: frozenset[str]):
    """Windows with token labels: around each marked token of toxic documents, and all of clean documents, end to end."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 64):
            words_out, labels_out, kinds = [], [], []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = WORD.findall(text or "")
                marked = [bool(toxic) and any(f in lexicon for f in features(w)[:-1]) for w in words]
                lows = [i - SIDE for i, m in enumerate(marked) if m] if toxic else range(0, len(words), 2 * SIDE + 1)
                for i in lows:
                    low, high = max(0, i), i + 2 * SIDE + 1
                    words_out.append(words[low:high])
                    labels_out.append([int(m) for m in marked[low:high]])
                    kinds.append(int(toxic))
            if words_out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words_out), pa.array(labels_out, pa.list_(pa.int32())), pa.array(kinds, pa.int32())],
                    names=["words", "labels", "toxic"])

    return cut


def excess(total: np.ndarray, tokens: np.ndarray, rate: float) -> np.ndarray:
    """How far the log of the chance that no token is toxic is below a clean document's of that weight, by its spread."""
    return (total + math.log1p(-min(rate, 1 - 1e-9)) * tokens) / np.sqrt(1 + rate * tokens)


def weights_of_tokens(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Weight of each token: the times that its document holds the word count as one plus their logarithm in all.

    A word that is repeated without end says little more than one that is said once, and whether it lies a
    little above a clean text's rate must not decide about a long text.
    """
    _, word, times = np.unique(owner << 32 | codes, return_inverse=True, return_counts=True)
    return ((1 + np.log(times)) / times)[word]


def tag(chain: Chain, offsets: bool):
    """Per document, over its tokens by weight: the log of the chance that none is toxic, negated, the sum of the
    marginals and of the weights, its ``excess``, and where tokens are toxic."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = Emissions(chain)
        for batch in sliced(batches, 512):
            if len(emit.numbers) > 400_000:
                emit.forget()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            words = [WORD.findall(t) for t in texts]
            lengths = np.array([len(w) for w in words], np.int64)
            codes = emit.codes([w for part in words for w in part])
            del words
            ends = np.cumsum(lengths)
            chances = marginals(np.split(emit.scores[codes], ends[:-1]), chain.turn, chain.stay)
            p, owner = np.concatenate(chances), np.repeat(np.arange(len(texts)), lengths)
            weight = weights_of_tokens(codes, owner)
            total, chance, tokens = (
                np.bincount(owner, weight * x, len(texts)) for x in (-np.log1p(-np.minimum(p, 1 - 1e-9)), p, np.ones(len(p))))
            columns = [batch.column(0), *(pa.array(x, pa.float64()) for x in (total, chance, tokens, excess(total, tokens, chain.rate)))]
            names = ["id", "total", "chance", "tokens", "mass"]
            if offsets:
                found: list[list[dict]] = [[] for _ in texts]
                for i in np.unique(owner[p >= 0.5]).tolist():
                    hit = set(np.flatnonzero(chances[i] >= 0.5).tolist())
                    found[i] = [{"start": m.start(), "end": m.end()} for k, m in enumerate(WORD.finditer(texts[i])) if k in hit]
                columns.append(pa.array(found, span))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Chain:
    """Fit on at most ``TOXIC_DOCS`` and ``CLEAN_DOCS`` labelled documents, those first by hash of their id.

    Labels are of documents; tokens are labelled by evidence: a word or stem that toxic documents hold
    ``ODDS`` times likelier than clean ones marks its tokens in toxic documents, if Chernoff's bound on the
    chance of so many toxic ones among its holders is at most ``CHANCE``; every other token is clean. Near
    copies count as one document here, in both classes. Labels other than 0 and 1, held-out documents and
    documents without label are not used; without a toxic and a clean one nothing is toxic.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = materialize(known, "labels")
    sample = bounded_sample(known.where("toxic = 1"), ["id"], TOXIC_DOCS).union(bounded_sample(known.where("toxic = 0"), ["id"], CLEAN_DOCS))
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = materialize(chosen.select("id", "text", "toxic"), "labelled").repartition(max(16, spark.sparkContext.defaultParallelism))
    nothing = Chain({}, -30.0, 0.0, 0.0, 0.0, -5.0)
    signed = chosen.select("text", "toxic").mapInArrow(signatures, "toxic int, alike binary").distinct().collect()
    groups = {k: near_copies([r["alike"] for r in signed if r["toxic"] == k]) for k in (0, 1)}
    sizes = {k: len(set(g.values())) for k, g in groups.items()}
    if not all(sizes.values()):
        return nothing
    seen = chosen.select("text", "toxic").mapInArrow(evidence(groups), "feature string, toxic int, alike long").distinct()
    held = seen.groupBy("feature").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    bad, good, share = F.col("bad"), F.col("good"), sizes[1] / (sizes[0] + sizes[1])
    odds = (bad / sizes[1]) / ((good + 0.1) / sizes[0])
    by_chance = bad * F.log(bad / (bad + good) / share) + F.when(good > 0, good * F.log(good / (bad + good) / (1 - share))).otherwise(0)
    strong = held.where(bad > 0).where((odds >= ODDS) & (by_chance >= -math.log(CHANCE)))
    lexicon = frozenset(r["feature"] for r in strong.select("feature").collect())
    windows = chosen.select("text", "toxic").mapInArrow(token_windows(lexicon), "words array<string>, labels array<int>, toxic int")
    windows = materialize(windows.distinct(), "windows")
    rows = [bounded_sample(windows.where(f"toxic = {k}"), ["words", "labels"], WINDOWS).collect() for k in (1, 0)]
    if not rows[0] or not rows[1]:
        return nothing
    chain = fit_chain([(r["words"], r["labels"]) for part in rows for r in part])
    tagged = chosen.select("id", "text").mapInArrow(tag(chain, False), f"id {kind}, total double, chance double, tokens double, mass double")
    rows = tagged.join(sample, "id").select("total", "chance", "tokens", "toxic").collect()
    total, chance, tokens, toxic = (np.array([r[k] for r in rows], float) for k in range(4))
    rate = float(chance[toxic == 0].sum() / max(1.0, tokens[toxic == 0].sum()))
    slope, base = fit_logistic(excess(total, tokens, rate), toxic)
    return chain._replace(slope=slope, base=base, rate=rate)


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``score``, ``predicted`` and ``spans`` of toxic tokens in code points.

    Texts are read whole; null and empty ones get the score of a text without toxic tokens. Rows that repeat
    or lack an id are scored like others; an empty table gives no rows; other columns play no part.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, total double, chance double, tokens double, mass double, spans array<struct<start:long,end:long>>"
    tagged = rows.mapInArrow(tag(chain, True), schema)
    odds = F.lit(chain.slope) * F.col("mass") + F.lit(chain.base)
    return tagged.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), (1 / (1 + F.exp(-odds))).alias("score"), "spans",
    ).select(id_col, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def drop_toxic(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that the model doesn't reject, with their columns."""
    place = docs.columns.index(text_col)
    tagger = tag(chain, False)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 512):
            pair = pa.RecordBatch.from_arrays([batch.column(place), batch.column(place)], names=["id", "text"])
            mass = next(tagger(iter([pair]))).column("mass").to_numpy()
            yield batch.filter(pa.array(chain.slope * mass + chain.base < 0))

    return docs.mapInArrow(keep, docs.schema)
