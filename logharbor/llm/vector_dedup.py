"""Near-duplicate vectors: sign hashing in several tables, exact cosine check, connected components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logharbor.llm.components import connected_components
from logharbor.session import materialize

#: Chance of missing a link that lies exactly at the threshold; links above it are missed less often.
MISS = 1e-5
#: Vectors of one bucket that a task compares at a time; larger buckets are split into pairs of such blocks.
BLOCK = 2048
#: Vectors that share a bucket by chance, on average over the largest label.
LOAD = 16
SEED = 20240917


def table_plan(rows: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Bits per table and number of tables for labels of up to ``rows`` vectors.

    One bit agrees for a pair at the threshold with probability ``1 - acos(threshold) / pi``; bits follow the
    logarithm of the rows, so buckets keep their size as data grow, and tables follow from the miss rate.
    """
    agree = 1 - math.acos(threshold) / math.pi
    bits = min(30, max(6, math.ceil(math.log2(max(2, rows) / LOAD))))
    return bits, math.ceil(math.log(miss) / math.log1p(-(agree**bits)))


def sign_vectors(bits: int, tables: int, id_col: str, vector_col: str, label_col: str):
    """Per vector: digest of its components, and its bucket in every table; nulls where it can't be compared."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index(vector_col))
            labels = batch.column(batch.schema.get_field_index(label_col))
            digests: list[bytes | None] = [None] * len(vectors)
            keys: list[np.ndarray | None] = [None] * len(vectors)
            by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
            for i in range(len(vectors)):
                if not (vectors[i].is_valid and labels[i].is_valid):
                    continue
                part = vectors[i].values
                if not len(part) or part.null_count:
                    continue
                v = part.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                if np.isfinite(v).all() and v.any():
                    digests[i] = hashlib.blake2b(v.tobytes(), digest_size=16).digest()
                    by_size.setdefault(len(v), []).append((i, v / np.abs(v).max()))
            for size, found in by_size.items():
                if size not in planes:
                    planes[size] = np.random.default_rng([SEED, size]).standard_normal((size, bits * tables))
                sides = (np.stack([v for _, v in found]) @ planes[size]) > 0
                codes = (sides.reshape(len(found), tables, bits) * weights).sum(axis=2)
                for (i, _), code in zip(found, codes):
                    keys[i] = code
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(id_col)), labels, pa.array(digests, pa.binary()),
                 vectors, pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "label", "digest", "vector", "keys"])

    return sign


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal keys of a sorted stream; what is kept back is one run at most."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        last = rows.slice(rows.num_rows - 1)
        same = np.ones(rows.num_rows, bool)
        for key in keys:
            same &= rows[key].to_numpy() == last[key].to_numpy()[0]
        cut = int(np.argmax(same))
        if cut:
            yield rows.slice(0, cut)
        held = rows.slice(cut)
    if held is not None and held.num_rows:
        yield held


RUN = ["label", "slot", "bucket", "pair"]


def check_buckets(threshold: float):
    """Verified links of each run of vectors: a count per vector, and edges that connect the linked ones.

    A pair counts in the first table that brings it together, so no pair counts twice. Pairs stay inside
    the task: what leaves it are counts and, per group of linked vectors, edges to the group's smallest.
    """

    def links(close: np.ndarray, sides: np.ndarray, across: bool) -> np.ndarray:
        np.fill_diagonal(close, False)
        return close & (sides[:, None] != sides[None, :]) if across else close

    def stars(ok: np.ndarray, nodes: np.ndarray) -> Iterator[tuple[int, int]]:
        left = ok.any(axis=1)
        while left.any():
            reached = np.zeros(len(nodes), bool)
            front = np.zeros(len(nodes), bool)
            front[np.argmax(left)] = True
            while front.any():
                reached |= front
                front = ok[front].any(axis=0) & ~reached
            left &= ~reached
            group = nodes[reached]
            centre = int(group.min())
            yield from ((centre, int(x)) for x in group if x != centre)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, RUN):
            rows = rows.combine_chunks()
            start = np.ones(rows.num_rows + 1, bool)
            same = np.ones(rows.num_rows - 1, bool)
            for key in RUN:
                column = rows[key].to_numpy()
                same &= column[1:] == column[:-1]
            start[1:-1] = ~same
            edges = np.flatnonzero(start)
            wide = [(a, b) for a, b in zip(edges[:-1], edges[1:]) if b - a > 1]
            out: list[tuple[int, int | None, int]] = []
            node, weight, block = (rows[c].to_numpy() for c in ("node", "weight", "block"))
            across = rows["across"].to_numpy(zero_copy_only=False)
            slot, vectors, keys = rows["slot"].to_numpy(), rows["vector"].chunk(0), rows["keys"].chunk(0)
            for a, b in wide:
                part = vectors.slice(a, b - a)
                sizes = np.diff(np.asarray(part.offsets))
                flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                signs = keys.slice(a, b - a).flatten().to_numpy().reshape(b - a, -1)[:, : slot[a]]
                for size in np.unique(sizes):
                    at = np.flatnonzero(sizes == size)
                    v = flat[np.repeat(sizes == size, sizes)].reshape(len(at), size)
                    v = v / np.abs(v).max(axis=1, keepdims=True)
                    v = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
                    ok = links(v @ v.T >= threshold, block[a:b][at], across[a])
                    i, j = np.nonzero(ok)
                    for low in range(0, len(i), 65536):
                        x, y = i[low : low + 65536], j[low : low + 65536]
                        met = (signs[at[x]] == signs[at[y]]).any(axis=1)
                        ok[x[met], y[met]] = False
                    if ok.any():
                        nodes, counts = node[a:b][at], ok @ weight[a:b][at]
                        out += [(int(n), None, int(c)) for n, c in zip(nodes, counts) if c]
                        out += [(x, y, 0) for x, y in stars(ok, nodes)]
            if out:
                first, second, count = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(count, pa.int64())],
                    names=["a", "b", "links"])

    return check


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", miss: float = MISS, block: int = BLOCK,
) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id``, ``kept`` (it is its component's smallest id).

    Two vectors link when their labels are equal and not null, they have as many components, and their cosine
    in double precision is at least ``threshold``. Vectors that are null, empty, zero or hold a null or a
    non-finite component link with nothing; so do rows without id, whose component is null and which are not
    kept. Rows with equal components and label form one class, counted by rows, which is compared once. Rows
    that repeat an id are counted like others. An empty table gives no rows; other columns play no part.

    A pair exactly at the threshold is missed with probability ``miss``; closer pairs much less often.
    Each vector goes to one bucket per table. A bucket above ``block`` vectors is split into blocks, and every
    two blocks meet in a run of their own, so no task holds more than two blocks of a bucket.
    """
    source = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    most = source.where("label IS NOT NULL").groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = table_plan(most, threshold, miss)
    schema = f"id long, label {source.schema['label'].dataType.simpleString()}, digest binary, " \
             f"vector {source.schema['vector'].dataType.simpleString()}, keys array<long>"
    source = source.withColumn("id", F.col("id").cast("long"))
    signed = materialize(source.mapInArrow(sign_vectors(bits, tables, "id", "vector", "label"), schema), "vectors")
    usable = signed.where("id IS NOT NULL AND digest IS NOT NULL")
    classes = materialize(
        usable.groupBy("label", "digest").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight")), "classes")
    heads = usable.join(
        classes.select(F.col("node").alias("id"), "label", "digest", "node", "weight"), ["id", "label", "digest"]
    ).dropDuplicates(["node", "label", "digest"])
    spread = heads.select(
        "label", "node", "weight", "keys", F.posexplode("keys").alias("slot", "bucket"), "vector")
    crowded = materialize(
        heads.select("label", F.posexplode("keys").alias("slot", "bucket")).groupBy("label", "slot", "bucket").count()
        .where(F.col("count") > block).select("label", "slot", "bucket", F.ceil(F.col("count") / block).cast("int").alias("blocks")),
        "crowded")
    spread = spread.join(crowded, ["label", "slot", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = spread.select("*", other).withColumn(
        "pair", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    ).select(*RUN, "block", (F.col("block") != F.col("other")).alias("across"), "node", "weight", "vector", "keys")
    found = spread.repartition(*RUN).sortWithinPartitions(*RUN).mapInArrow(check_buckets(threshold), "a long, b long, links long")
    found = materialize(found, "links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    components = connected_components(found.where("b IS NOT NULL"))
    labelled = classes.join(counts, "node", "left").join(components, "node", "left")
    component = F.coalesce("component", "node", "id")
    return signed.select("id", "label", "digest").join(labelled, ["label", "digest"], "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("id").isNull() | F.col("node").isNull(), 0)
        .otherwise(F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
