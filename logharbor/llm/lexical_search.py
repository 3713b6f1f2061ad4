"""Exact ranked lexical search by two hierarchies, over the items and over the documents.

A node of either tree holds the highest value that any of its members has on each coordinate (term). The
product of an item node and a document node bounds the score of every pair below them, so the pair of nodes is
left as soon as the bound is below the weakest kth score of its items. Scores known from a first part of the
documents give these limits before the others are looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logharbor.llm.frames import LOWER, UPPER, sliced
from logharbor.llm.words import text_bytes, word_hashes
from logharbor.session import materialize

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Results per item.
TOP = 50
#: Distinct items searched at a time, about.
BLOCK = 1000
#: One document in so many gives the first limits.
SEED = 32
#: Members of a document node by level, and of an item node.
NODE, ITEM_NODE = 8, 4
#: Numbers in the matrix of the documents that a task holds at a time.
CELLS = 4_000_000


def term_bytes() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[48:58] = inside[65:91] = inside[97:123] = True
    inside[128:] = True  # every byte of a character beyond ASCII
    return inside


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of the texts, A-Z lower-cased, and the number of its text; nulls have none."""
    data, bounds = text_bytes(texts)
    inside = term_bytes()[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= ~inside[:-1]
    after[:-1] |= ~inside[1:]
    starts, ends = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    with np.errstate(over="ignore"):
        return word_hashes(data, starts, ends), np.searchsorted(bounds, starts, "right") - 1


def profile(vocabulary: np.ndarray):
    """Per document: number of terms, and which terms of the sorted vocabulary it holds how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 512):
            hashes, owner = term_hashes(batch.column(1))
            place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
            hit = vocabulary[place] == hashes
            pairs, times = np.unique(owner[hit] * len(vocabulary) + place[hit], return_counts=True)
            offsets = pa.array(np.searchsorted(pairs, np.arange(batch.num_rows + 1) * len(vocabulary)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.bincount(owner, minlength=batch.num_rows), pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(pairs % len(vocabulary), pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))],
                names=["id", "n", "terms", "times"])

    return run


class ItemNode(NamedTuple):
    """Items below the node, the terms any of them has with the highest weight, and its children."""

    items: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    children: tuple[ItemNode, ...]


def item_tree(terms: list[np.ndarray], weights: np.ndarray) -> ItemNode:
    """Hierarchy over items; items that share much weight lie side by side, by a chain of nearest neighbours."""
    shared = np.zeros((len(terms), len(weights)), np.float32)
    for i, held in enumerate(terms):
        shared[i, held] = weights[held]
    close = shared @ (shared > 0).T
    left, order = set(range(1, len(terms))), [0]
    while left:
        row = close[order[-1]]
        order.append(max(left, key=lambda i: (row[i], -i)))
        left.remove(order[-1])
    level = [ItemNode(np.array([i]), terms[i], weights[terms[i]].astype(float), ()) for i in order]
    while len(level) > 1:
        parents = []
        for at in range(0, len(level), ITEM_NODE):
            part = tuple(level[at : at + ITEM_NODE])
            held = np.unique(np.concatenate([node.terms for node in part]))
            # An item's weight on a term is the term's, so the maximum is the same for all that have it.
            parents.append(ItemNode(np.concatenate([node.items for node in part]), held, weights[held].astype(float), part))
        level = parents
    return level[0]


class Best:
    """The highest-scoring documents of each item so far; equal scores by id, those without id last."""

    def __init__(self, limits: np.ndarray, top: int) -> None:
        self.top, self.limits = top, limits.astype(float).copy()
        self.found: list[list[tuple]] = [[] for _ in limits]

    def offer(self, item: int, scores: np.ndarray, ids: list) -> None:
        if len(scores) > self.top:
            at_least = np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
            near = scores >= at_least
            scores, ids = scores[near], [i for i, n in zip(ids, near.tolist()) if n]
        rows = self.found[item] + [(-s, i is None, i) for s, i in zip(scores.tolist(), ids)]
        rows.sort(key=lambda row: (row[0], row[1], 0 if row[1] else row[2]))
        self.found[item] = rows[: self.top]
        if len(rows) >= self.top:
            self.limits[item] = max(self.limits[item], -rows[self.top - 1][0])


def search(root: ItemNode, weights: np.ndarray, limits: np.ndarray, documents: int, all_terms: int, top: int):
    """The best documents of each item among those that a task sees, as far as they reach the limits."""

    def visit(node: ItemNode, level: int, places: np.ndarray, maxima: list[np.ndarray], ids: list, best: Best) -> None:
        bounds = maxima[level][np.ix_(places, node.terms)] @ node.weights
        keep = bounds >= max(1.0, best.limits[node.items].min())
        if not keep.any():
            return
        places = places[keep]
        if not level and not node.children:
            best.offer(int(node.items[0]), bounds[keep], [ids[i] for i in places.tolist()])
            return
        if level:
            below = len(maxima[level - 1])
            places = (places[:, None] * NODE + np.arange(NODE)).ravel()
            places = places[places < below]
        for child in node.children or (node,):
            visit(child, max(0, level - 1), places, maxima, ids, best)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(limits, top)
        kind = None
        for batch in sliced(batches, max(NODE, min(512, CELLS // len(weights)))):
            kind = batch.schema.types[0]
            n, lists, times = batch.column(1).to_numpy(), batch.column(2), batch.column(3)
            rows = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            terms, tf = lists.flatten().to_numpy(), times.flatten().to_numpy()
            length = 100 - 50 + (50 * n * documents) // all_terms
            values = (1_000_000_000 * tf) // (1000 * tf + 20 * length[rows])
            matrix = np.zeros((batch.num_rows, len(weights)))
            matrix[rows, terms] = values
            # Documents with the same heaviest coordinate lie side by side.
            heavy = (matrix * weights).argmax(axis=1)
            order = np.lexsort((n, heavy))
            ids = [batch.column(0)[i].as_py() for i in order.tolist()]
            maxima = [matrix[order]]
            while len(maxima[-1]) > 1:
                maxima.append(np.maximum.reduceat(maxima[-1], np.arange(0, len(maxima[-1]), NODE), axis=0))
            visit(root, len(maxima) - 1, np.zeros(1, np.int64), maxima, ids, best)
        out = [(item, i, int(-score)) for item, rows in enumerate(best.found) for score, _, i in rows]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), kind, pa.int64()))], names=["item", "id", "score"])

    return run


def first_ranks(found: DataFrame, key: str, top: int) -> DataFrame:
    by = Window.partitionBy(key).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)


def search_block(docs: DataFrame, texts: list[str], top: int) -> DataFrame:
    """Best documents ``(item, id, score)`` of each of the texts, in no order; a task may add a few too many."""
    spark = docs.sparkSession
    kind = docs.schema["id"].dataType.simpleString()
    hashes, owner = term_hashes(pa.array(texts, pa.string()))
    vocabulary = np.unique(hashes)
    terms = [np.unique(np.searchsorted(vocabulary, hashes[owner == i])) for i in range(len(texts))]
    profiles = materialize(docs.mapInArrow(profile(vocabulary), f"id {kind}, n long, terms array<int>, times array<long>"), "profiles")
    counted = profiles.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).head()
    empty = spark.createDataFrame([], f"item int, id {kind}, score long")
    if not counted["documents"]:
        return empty
    held = {r["term"]: r["count"] for r in profiles.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    n = counted["documents"]
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
    if max(int(weights[t].sum()) for t in terms) * 10**6 >= 2**53:
        raise OverflowError("an item has too many terms for exact scores")
    root = item_tree(terms, weights)
    holding = profiles.where(F.size("terms") > 0)
    turn = F.pmod(F.xxhash64("id", "n"), F.lit(SEED))
    look = lambda part, limits: part.mapInArrow(
        search(root, weights, limits, n, counted["terms"], top), f"item int, id {kind}, score long")
    seed = materialize(first_ranks(look(holding.where(turn == 0), np.zeros(len(texts))), "item", top), "seed")
    limits = np.zeros(len(texts))
    for row in seed.where(F.col("rank") == top).select("item", "score").collect():
        limits[row["item"]] = row["score"]
    return seed.select("item", "id", "score").unionAll(look(holding.where(turn != 0), limits))


def rank(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per item its ``top`` highest-scoring documents: item id, ``rank`` from 1, document id, ``score``.

    Null and empty texts hold no term: such items give no rows, such documents are never found and don't count.
    Only scores above 0 are given; equal scores go by id, documents without id come last. Rows that repeat an
    id, of either table, count one by one. Equal item texts are searched once. An empty table gives no rows;
    other columns play no part. Terms are told apart by a 64-bit hash. Items are searched in blocks of about
    ``BLOCK`` different texts, whose terms and trees are all that goes to the tasks.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = [rows.schema["id"].dataType.simpleString(), items.schema[item_col].dataType.simpleString()]
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("item_text")).where(F.col("item_text").rlike(TERM.pattern))
    distinct = materialize(asked.select("item_text").distinct(), "items")
    blocks = -(-distinct.count() // BLOCK)
    found = spark.createDataFrame([], f"item_text string, id {kinds[0]}, score long")
    for block in range(blocks):
        texts = sorted(r["item_text"] for r in distinct.where(F.pmod(F.xxhash64("item_text"), F.lit(blocks)) == block).collect())
        if texts:
            names = spark.createDataFrame(list(enumerate(texts)), "item int, item_text string")
            found = found.unionAll(first_ranks(search_block(rows, texts, top), "item", top).join(names, "item").select("item_text", "id", "score"))
    # Ranks anew for every row of the items, as ids may repeat.
    listed = asked.withColumn("row", F.monotonically_increasing_id())
    return first_ranks(found, "item_text", top).join(listed, "item_text").select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
