"""Cutting-stock packing, dual-tree search and whitening against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from logharbor.llm import cutting_stock, lexical_search, whitening
from logharbor.llm.frames import LOWER, UPPER, ready
from logharbor.llm.queries import BYTE_VOCABULARY

AWKWARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (5, "one"), (None, "one"), (None, None), (6, "a b c d e f g h"),
    (7, "A B C D E F G H"), (8, "x" * 50_000), (9, "word " * 20_000), (10, "😀 é ß\x00 <|endoftext|> z"), (11, "ÄÖ ä_ö x"),
]
DOCS = "doc_id long, text string, id int, name string, tokens int, n long, rank int, score double, item_id string, length long, low int"


@pytest.fixture(scope="module")
def awkward(spark):
    ready(spark)
    return spark.createDataFrame([(i, t, 1, "x", 2, 3, 4, 5.0, "y", 6, 7) for i, t in AWKWARD], DOCS)


# -- packing ----------------------------------------------------------------------------


def unrolled(slots):
    """Parts of every piece and of every sequence, read off the plan one piece at a time."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for s in slots:
        for r in range(s.ranks):
            low = s.base + r * s.length
            start, end = max(low, s.origin) - s.origin, min(low + s.length, s.origin + s.count * s.size) - s.origin
            for turn in range(start // s.size, (end - 1) // s.size + 1):
                a, b = max(start, turn * s.size), min(end, (turn + 1) * s.size)
                pieces[s.length, s.low + r].append((s.origin + a - low, b - a))
                sequences[s.first + turn].append((s.offset + a - turn * s.size, b - a))
    return pieces, sequences


def gapless(parts):
    at = 0
    for start, length in sorted(parts):
        assert start == at and length > 0
        at += length
    return at


@pytest.mark.parametrize("seed", range(60))
def test_plan_places_every_id_once_without_padding(seed):
    rng = random.Random(seed)
    capacity, grain = rng.choice([8, 16, 64]), rng.choice([1, 2, 4])
    histogram = {rng.randint(1, capacity): rng.randint(1, rng.choice([1, 3, 50])) for _ in range(rng.randint(1, 30))}
    pieces, sequences = unrolled(cutting_stock.plan(histogram, capacity, grain))
    assert set(pieces) == {(n, k) for n, c in histogram.items() for k in range(c)}
    assert all(gapless(parts) == n for (n, _), parts in pieces.items())
    lengths = Counter(gapless(parts) for parts in sequences.values())
    assert all(n == capacity or n & (n - 1) == 0 and c == 1 for n, c in lengths.items())


def test_columns_reach_the_optimum():
    # Thirds and halves: 6 of size 5, 6 of size 3 and 6 of size 2 need all of six sequences of ten.
    columns = cutting_stock.column_generation(np.array([2, 3, 5]), np.array([6.0, 6.0, 6.0]), 10)
    assert sum(x for _, x in columns) == pytest.approx(6, rel=1e-3)
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = np.unique(rng.integers(2, 11, 4))
        prices, room = rng.random(len(sizes)), 20
        patterns = [()]
        for size in sizes:
            patterns = [(*p, n) for p in patterns for n in range(room // size + 1)]
        fitting = [np.array(p) for p in patterns if np.array(p) @ sizes <= room]
        value, pattern = cutting_stock.price(sizes, prices, room)[0]
        assert value == pytest.approx(max(p @ prices for p in fitting if p.any())) and np.array(pattern) @ prices == pytest.approx(value)


def test_few_documents_are_cut():
    rng = random.Random(3)
    histogram = Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    pieces, sequences = unrolled(cutting_stock.plan(histogram))
    assert sum(len(p) > 1 for p in pieces.values()) < 0.05 * len(pieces)
    assert len(sequences) <= sum(n * c for n, c in histogram.items()) / 2048 + 11


def test_packing_of_awkward_rows(awkward):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTE_VOCABULARY[0])
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for _, t in AWKWARD]
    rows = cutting_stock.pack(awkward, BYTE_VOCABULARY).collect()
    assert sum(r.length for r in rows) == sum(map(len, ids))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        mine = [x for (i, _), x in zip(AWKWARD, ids) if i == r.doc_id and len(x) == r.doc_tokens]
        assert r.ids_crc32 in [zlib.crc32(x[r.start : r.start + r.length].tobytes()) for x in mine]
    for (i, _), x in zip(AWKWARD, ids):
        if i not in (None, 5):
            assert gapless((r.start, r.length) for r in rows if r.doc_id == i) == len(x)
    assert Counter((r.doc_id, r.start, r.length) for r in rows if r.doc_id == 5)[5, 0, len(ids[4])] <= 2
    lengths = Counter(gapless(parts) for parts in sequences.values())
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths)
    assert cutting_stock.pack(awkward.limit(0), BYTE_VOCABULARY).count() == 0


def test_packing_of_a_table_pads_nothing(spark):
    docs = ready(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = cutting_stock.pack(docs, BYTE_VOCABULARY).collect()
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        documents[r.doc_id, r.doc_tokens].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert len(documents) == docs.count() and all(gapless(p) == n for (_, n), p in documents.items())
    assert all(n == 2048 or n & (n - 1) == 0 for n in map(gapless, sequences.values()))


# -- search -----------------------------------------------------------------------------


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, LOWER)))


def brute_ranks(docs, items, top):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, all_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 100 - 50 + 50 * c.total() * n // all_terms
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms_of(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, row[3], -row[0]) for k, row in enumerate(sorted(scored)[:top])]
    return Counter(out)


def ranks(docs, items, top):
    return Counter(tuple(r) for r in lexical_search.rank(docs, items, top).collect())


@pytest.mark.parametrize("seed, block, seed_share", [(1, 1000, 32), (2, 7, 3)])
def test_search_gives_the_brute_force_ranks(spark, monkeypatch, seed, block, seed_share):
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    monkeypatch.setattr(lexical_search, "SEED", seed_share)
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(3000)] + ["É", "é", "x_y", "A-b", "日本"]
    text = lambda n: " ".join(rng.choices(words, k=n)).upper() if rng.random() < 0.2 else ", ".join(rng.choices(words, k=n))
    docs = [(i, text(rng.choice([0, 1, 5, 30, 200]))) for i in range(700)]
    docs += [(700 + i, docs[3][1]) for i in range(90)] + [(None, docs[3][1]), (3, docs[3][1])]
    items = [(i, text(rng.choice([1, 4, 20]))) for i in range(30)] + [(30, docs[3][1]), (31, None), (32, ""), (33, "- _"), (None, "w1"), (34, "w1")]
    frame = ready(spark).createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert ranks(frame, spark.createDataFrame(items, "item_id long, text string"), 20) == brute_ranks(docs, items, 20)


def test_search_of_awkward_rows_and_empty_tables(spark, awkward):
    items = spark.createDataFrame([(1, "one word z"), (2, "X ä"), (2, "X ä"), (3, None), (4, "nowhere")], "item_id long, text string")
    got = ranks(awkward, items, 50)
    assert got == brute_ranks(AWKWARD, [(1, "one word z"), (2, "X ä"), (2, "X ä")], 50) and max(got.values()) == 2
    assert lexical_search.rank(awkward.limit(0), items).count() == lexical_search.rank(awkward, items.limit(0)).count() == 0
    assert lexical_search.rank(awkward, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_string_ids_can_be_searched(spark):
    docs = ready(spark).createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z z")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert [(r.item_id, r.rank, r.doc_id) for r in lexical_search.rank(docs, items).orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b")]


def test_bounds_hold_for_every_pair_below():
    rng = np.random.default_rng(2)
    weights = rng.integers(0, 9, 40)
    terms = [np.unique(rng.integers(0, 40, rng.integers(1, 9))) for _ in range(23)]
    matrix = rng.integers(0, 9, (30, 40)) * (rng.random((30, 40)) < 0.3)

    def walk(node):
        assert all(set(terms[i]) <= set(node.terms) for i in node.items)
        assert ((matrix.max(axis=0)[node.terms] * node.weights).sum() >= [matrix[:, terms[i]] @ weights[terms[i]] for i in node.items]).all()
        assert not node.children or sorted(node.items) == sorted(i for c in node.children for i in c.items)
        return 1 + sum(map(walk, node.children))

    assert walk(lexical_search.item_tree(terms, weights)) > len(terms)


# -- whitening --------------------------------------------------------------------------


@pytest.mark.parametrize("matrix", [
    np.diag([3.0, 3.0, 3.0, 1.0, 0.0]), np.eye(6), np.zeros((4, 4)), np.array([[2.0]]), np.array([[2.0, 1.0], [1.0, 2.0]]),
    np.full((7, 7), 1.0), np.diag([1e12, 1e12 - 1, 5.0, 1e-6]), np.kron(np.eye(3), np.array([[2.0, 1.0], [1.0, 2.0]])),
])
def test_eigenvectors_of_clusters(matrix):
    check_components(matrix)


@pytest.mark.parametrize("seed", range(10))
def test_eigenvectors_of_random_matrices(seed):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((rng.integers(2, 300), rng.integers(1, 90))) * np.exp(rng.standard_normal())
    check_components(x.T @ x)


def check_components(matrix):
    k = min(4, len(matrix))
    values, axes = whitening.leading_components(matrix, k)
    scale = max(1e-300, np.abs(matrix).sum(axis=1).max())
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:k], atol=1e-13 * scale, rtol=1e-12)
    assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-9
    assert np.abs(matrix @ axes - axes * values).max() <= 1e-12 * scale * len(matrix)


def test_whitening_of_awkward_vectors(spark):
    rng = np.random.default_rng(4)
    good = [(i, (rng.standard_normal(6) * [3, 2, 1, 1, 1, 0.5]).tolist(), 1, 2.0) for i in range(200)]
    good += [(1000 + i, good[0][1], None, 2.0) for i in range(50)] + [(None, good[1][1], 0, 1.0), (7, good[2][1], 0, 1.0)]
    bad = [(301, None, 0, 1.0), (302, [None] + [1.0] * 5, 0, 1.0), (303, [math.nan] * 6, 0, 1.0), (304, [math.inf] + [0.0] * 5, 0, 1.0), (305, [], 0, 1.0),
           (306, [1.0, 2.0], 0, 1.0), (307, [1e300] * 6, 0, 1.0)]
    frame = ready(spark).createDataFrame(good + bad, "vec_id long, embedding array<double>, n int, x double").repartition(4)
    rows = whitening.whiten(frame).collect()
    steps = {i: np.floor(256 * np.array(v)).astype(int) for i, v, _, _ in good}
    fit = np.unique(np.array([np.floor(256 * np.array(v)).astype(int) for _, v, _, _ in good]), axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(rows) == 4 * len(good) and {r.n for r in rows} == {n}
    signs = {}
    for r in rows:
        x, c = steps[r.vec_id], r.component - 1
        if r.vec_id != 7:
            assert r.deviation == int(((n * x - total) ** 2).sum())
            want = (x - total / n) @ axes[:, c] / math.sqrt(values[c])
            sign = signs.setdefault(c, math.copysign(1, want * r.whitened))
            assert r.whitened == pytest.approx(sign * want, abs=1e-9)
        assert r.explained == pytest.approx(values[c] / values.sum(), rel=1e-9) and r.identity_error < 1e-9
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.whiten(frame.where("vec_id >= 1000")).count() == 0  # equal vectors have no spread


def test_deviation_beyond_a_long_is_exact_or_null():
    run = whitening.projected(3, np.array([5, -5]), np.eye(2), np.ones(2))
    steps = np.array([[2**30, 2**29], [2**61, 0]], "<i8")
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([r.tobytes() for r in steps])], names=["id", "x"])
    got = next(run(iter([batch]))).column("deviation").to_pylist()
    want = [(3 * 2**30 - 5) ** 2 + (3 * 2**29 + 5) ** 2]
    assert got == [w if w < 2**63 else None for w in want for _ in range(2)] + [None, None]
