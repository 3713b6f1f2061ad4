"""Packing of token sequences as a cutting-stock problem, solved by column generation.

The linear program covers the histogram of lengths, in steps of ``GRAIN`` ids, by patterns: how many pieces of
which step share a sequence. Patterns are priced by knapsack dynamic programming over the rows' prices. The
rounded patterns give runs of sequences that hold alike pieces, and what is over or left open is evened out by
cutting: the pieces of the emptiest sequences, and those the rounding left over, are laid end to end and dealt
into the gaps of the other sequences, then into new sequences, of which the last are of powers of two. So no
sequence is padded, and few documents are cut. The plan's size depends on the capacity, not on the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logharbor.llm.best_fit import Encoder
from logharbor.llm.frames import sliced
from logharbor.session import materialize

CAPACITY = 2048
END = 1
#: Steps of the linear program's lengths; a finer one leaves smaller gaps and takes longer on the driver.
GRAIN = 16
#: The program ends when it is proved to be within this share of its optimum.
TOLERANCE = 1e-4
#: Columns taken from one round of pricing, at most.
ROUND = 16
#: Rounds for each row, at most; where they end early, more is cut.
ROUNDS = 20
#: A group of one length, numbered in one task, holds at most one of so many parts of all pieces.
SHARES = 20_000

Pattern = tuple[int, ...]  # how many pieces of each size


def price(sizes: np.ndarray, prices: np.ndarray, room: int) -> list[tuple[float, Pattern]]:
    """Patterns of highest price that fit into ``room`` steps, one for each size that they must hold; best first.

    The dynamic program gives for every room the most that pieces in it can be worth.
    """
    best, last = np.zeros(room + 1), np.full(room + 1, -1)  # last piece, -1 for a step left open
    for c in range(1, room + 1):
        n = int(np.searchsorted(sizes, c, "right"))
        best[c] = best[c - 1]
        if n:
            values = prices[:n] + best[c - sizes[:n]]
            k = int(values.argmax())
            if values[k] > best[c]:
                best[c], last[c] = values[k], k
    forced = prices + best[room - sizes]
    found: dict[Pattern, float] = {}
    for place in np.argsort(-forced, kind="stable")[:ROUND]:
        counts = [0] * len(sizes)
        counts[place] = 1
        left = room - int(sizes[place])
        while left:
            if last[left] >= 0:
                counts[last[left]] += 1
            left -= int(sizes[last[left]]) if last[left] >= 0 else 1
        found[tuple(counts)] = float(forced[place])
    return sorted(((value, pattern) for pattern, value in found.items()), reverse=True)


def column_generation(sizes: np.ndarray, wanted: np.ndarray, room: int) -> list[tuple[Pattern, float]]:
    """Patterns, and how often each is used, for as few sequences as possible in fractions.

    ``wanted``: pieces of each size, all positive; sizes in steps, ascending; ``room`` steps a sequence. Revised
    simplex method: each round prices patterns and lets the worthwhile ones enter the basis. A price of one
    sequence for the best pattern would prove the optimum; Farley's bound tells how far it is.
    """
    rows = len(sizes)
    basis: list[Pattern] = [tuple(int(room // sizes[i]) if j == i else 0 for j in range(rows)) for i in range(rows)]
    inverse = np.diag([1.0 / pattern[i] for i, pattern in enumerate(basis)])
    # Distinct right sides keep degenerate pivots from running in a circle.
    amounts = inverse.diagonal() * wanted * (1 + 1e-7 * np.random.default_rng(5).random(rows))
    for _ in range(ROUNDS * rows):
        pool = price(sizes, inverse.sum(axis=0), room)
        if 1 - 1 / pool[0][0] <= TOLERANCE:
            break
        for _, pattern in pool:
            column = np.array(pattern, float)
            if inverse.sum(axis=0) @ column <= 1 + TOLERANCE / 10:
                continue
            direction = inverse @ column
            up = np.flatnonzero(direction > 1e-9)
            ratios = amounts[up] / direction[up]
            out, step = int(up[ratios.argmin()]), ratios.min()
            amounts = np.maximum(amounts - step * direction, 0.0)
            amounts[out] = step
            row = inverse[out] / direction[out]
            inverse -= np.outer(direction, row)
            inverse[out] = row
            basis[out] = pattern
    return [(pattern, float(x)) for pattern, x in zip(basis, amounts)]


class Run(NamedTuple):
    """So many sequences that each hold one piece of every listed length, from a rank on."""

    count: int
    pieces: tuple[tuple[int, int], ...]  # length, first rank


class Slot(NamedTuple):
    """Where pieces of a length lie, ranks ``low`` to ``low + ranks``.

    The pieces of consecutive ranks are laid end to end, the first of the slot at ``base``; from ``origin`` on,
    every ``size`` ids go to the next of ``count`` sequences, at ``offset``. Uncut pieces have their own length
    as ``size``.
    """

    length: int
    low: int
    ranks: int
    base: int
    origin: int
    count: int
    size: int
    first: int
    offset: int


def runs_of_patterns(histogram: dict[int, int], capacity: int, grain: int) -> tuple[list[Run], list[tuple[int, int, int]]]:
    """Sequences by rounded patterns, and ``(length, first rank, count)`` of what the rounding left over."""
    if not histogram:
        return [], []
    sizes = sorted({-(-length // grain) for length in histogram})
    classes: list[list[list[int]]] = [[] for _ in sizes]  # by size: [length, first rank, count] still free
    for length in sorted(histogram, reverse=True):
        classes[sizes.index(-(-length // grain))].append([length, 0, histogram[length]])
    wanted = np.array([sum(part[2] for part in parts) for parts in classes], float)
    runs = []
    for pattern, amount in sorted(column_generation(np.array(sizes), wanted, capacity // grain), key=lambda x: -x[1]):
        held = [i for i, n in enumerate(pattern) for _ in range(n)]
        count = int(min([amount + 1e-4, *(sum(p[2] for p in classes[i]) // pattern[i] for i in set(held))]))
        slots: list[list[list[int]]] = []
        for i in held:
            taken, left = [], count
            while left:
                part = classes[i][0]
                n = min(left, part[2])
                taken.append([part[0], part[1], n])
                part[1], part[2], left = part[1] + n, part[2] - n, left - n
                if not part[2]:
                    classes[i].pop(0)
            slots.append(taken)
        while count:
            n = min(taken[0][2] for taken in slots)
            runs.append(Run(n, tuple((taken[0][0], taken[0][1]) for taken in slots)))
            for taken in slots:
                taken[0][1], taken[0][2] = taken[0][1] + n, taken[0][2] - n
                if not taken[0][2]:
                    taken.pop(0)
            count -= n
    return runs, [(length, low, count) for parts in classes for length, low, count in parts]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, grain: int = GRAIN) -> list[Slot]:
    """Places of all pieces, given how many there are of each length up to the capacity.

    Sequences are full but for at most one of each power of two below the capacity, which is full as well.
    """
    histogram = {n: c for n, c in histogram.items() if c}
    slots, sequences = [], 0
    if capacity in histogram:
        sequences = histogram.pop(capacity)
        slots.append(Slot(capacity, 0, sequences, 0, 0, sequences, capacity, 0, 0))
    runs, loose = runs_of_patterns(histogram, capacity, grain)
    filled = lambda run: sum(length for length, _ in run.pieces)
    runs.sort(key=filled)
    short = sum(run.count * (capacity - filled(run)) for run in runs) - sum(length * count for length, _, count in loose)
    # Each sequence taken apart adds its ids to what is dealt out and takes its gap away: a capacity in all.
    apart = min(max(0, -(-short // capacity)), sum(run.count for run in runs))
    gaps, kept = [], []
    for run in runs:
        n = min(apart, run.count)
        apart -= n
        loose += [(length, low, n) for length, low in run.pieces] if n else []
        if n < run.count:
            kept.append(Run(run.count - n, tuple((length, low + n) for length, low in run.pieces)))
    for run in kept:
        offset = 0
        for length, low in run.pieces:
            slots.append(Slot(length, low, run.count, 0, 0, run.count, length, sequences, offset))
            offset += length
        if offset < capacity:
            gaps.append((run.count, capacity - offset, sequences, offset))
        sequences += run.count
    loose = [part for part in loose if part[2]]
    left = sum(length * count for length, _, count in loose) - sum(count * size for count, size, _, _ in gaps)
    gaps.append((left // capacity, capacity, sequences, 0))
    sequences += left // capacity
    size = capacity
    while size > 1:
        size //= 2
        if left % (2 * size) >= size:
            gaps.append((1, size, sequences, 0))
            sequences += 1
    origin, at, k = 0, 0, 0  # ids before the gap, ids before the pieces
    gaps = [gap for gap in gaps if gap[0]]
    for length, low, count in loose:
        end = at + length * count
        while k < len(gaps):
            number, size, first, offset = gaps[k]
            # Ranks whose ids lie in this gap, at least in part.
            a, b = max(0, (origin - at) // length), min(count, -(-(origin + number * size - at) // length))
            if a < b:
                slots.append(Slot(length, low + a, b - a, at + a * length, origin, number, size, first, offset))
            if origin + number * size > end:
                break
            origin, k = origin + number * size, k + 1
        at = end
    return slots


def encoded(vocabulary: tuple[str, str, str], capacity: int, end: int):
    """Each text's ids and the end id: how many, and checksum of each run of ``capacity`` ids and of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*vocabulary)
        with np.errstate(over="ignore"):
            for batch in sliced(batches):
                tokens, sums = [], []
                for ids in encoder.encode(batch.column(2)):
                    ids = np.append(ids, end).astype("<u4")
                    tokens.append(len(ids))
                    sums.append([zlib.crc32(ids[at : at + capacity]) for at in range(0, len(ids), capacity)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array(sums, pa.list_(pa.int64()))],
                    names=["id", "name", "tokens", "sums"])

    return run


def checksums(vocabulary: tuple[str, str, str], end: int):
    """Checksum of each cut ``(start, length)`` of a text's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*vocabulary)
        with np.errstate(over="ignore"):
            for batch in sliced(batches):
                rows = []
                keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist())
                for (key, name, cuts), ids in zip(keys, encoder.encode(batch.column(2))):
                    ids = np.append(ids, end).astype("<u4")
                    rows += [(key, name, c["start"], c["length"], zlib.crc32(ids[c["start"] : c["start"] + c["length"]])) for c in cuts]
                types = [batch.schema.types[0], *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], names=["id", "name", "start", "length", "crc"])

    return run


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """The pieces with their ``rank`` within their length; a frequent length is numbered in several groups."""
    spark = pieces.sparkSession
    share = max(1, -(-sum(histogram.values()) // SHARES))
    groups = spark.createDataFrame([(n, -(-c // share)) for n, c in histogram.items()] or [(0, 1)], "length long, groups long")
    dealt = pieces.join(F.broadcast(groups), "length").withColumn("group", F.pmod(F.xxhash64("id", "name", "start"), "groups")).drop("groups")
    sizes = dealt.groupBy("length", "group").count()
    earlier = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "group", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("length", "group").orderBy("id", "name", "start"))
    return dealt.withColumn("place", place - 1).join(sizes, ["length", "group"]).withColumn("rank", F.col("before") + F.col("place"))


def pack(
    docs: DataFrame, vocabulary: tuple[str, str, str], capacity: int = CAPACITY, end: int = END, grain: int = GRAIN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A text's ids are followed by ``end``; null counts as empty, so every row gives a piece. Texts over
    ``capacity`` ids are cut into full sequences and a rest; rests are placed by the plan and cut only where it
    says so. Documents are assigned by their rank within their length. Rows that repeat an id or have none are
    packed like others. An empty table gives no rows; other columns play no part. ``capacity`` is a power of two
    and a multiple of ``grain``. ``vocabulary``: the arguments of :class:`Encoder`.

    The driver sees the histogram and the plan, both bounded by ``capacity``. Texts that the plan cuts are
    encoded once more for the checksums of their pieces; rows of the same id and text count as one there.
    """
    if capacity & (capacity - 1) or capacity % grain:
        raise ValueError("the capacity has to be a power of two and a multiple of the grain")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("name"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    texts = rows.mapInArrow(encoded(vocabulary, capacity, end), f"id {kind}, name long, tokens long, sums array<long>")
    pieces = texts.select("id", "name", "tokens", F.posexplode("sums").alias("k", "crc")).withColumn("start", F.col("k").cast("long") * capacity)
    pieces = materialize(pieces.select(
        "id", "name", "tokens", "start", F.least(F.lit(capacity), F.col("tokens") - F.col("start")).cast("long").alias("length"), "crc"), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = spark.createDataFrame(
        [tuple(s) for s in plan(histogram, capacity, grain)] or [(0,) * 9],
        ", ".join(f"{'length' if name == 'length' else f's_{name}'} long" for name in Slot._fields))

    joined = ranked(pieces, histogram).join(F.broadcast(slots), "length").where("rank >= s_low AND rank < s_low + s_ranks")
    # The piece's ids among those laid end to end, as far as they belong to this slot.
    low = F.col("s_base") + (F.col("rank") - F.col("s_low")) * F.col("length")
    joined = joined.withColumn("low", low).withColumn("from", F.greatest("low", "s_origin") - F.col("s_origin")).withColumn(
        "to", F.least(F.col("low") + F.col("length"), F.col("s_origin") + F.col("s_count") * F.col("s_size")) - F.col("s_origin"))
    parts = joined.withColumn("turn", F.explode(F.sequence(F.expr("`from` div s_size"), F.expr("(`to` - 1) div s_size"))))
    a, b = F.greatest(F.col("from"), F.col("turn") * F.col("s_size")), F.least(F.col("to"), (F.col("turn") + 1) * F.col("s_size"))
    placed = materialize(parts.select(
        "id", "name", "tokens", (F.col("start") + F.col("s_origin") + a - F.col("low")).alias("start"), (b - a).alias("part"),
        F.when(b - a == F.col("length"), F.col("crc")).alias("crc"), (F.col("s_first") + F.col("turn")).alias("sequence"),
        (F.col("s_offset") + a - F.col("turn") * F.col("s_size")).alias("offset")), "placed").withColumnRenamed("part", "length")

    cut = placed.where("crc IS NULL")
    wanted = cut.groupBy("id", "name").agg(F.collect_set(F.struct("start", "length")).alias("cuts"))
    same = lambda left, right, columns: [left[c].eqNullSafe(right[c]) for c in columns]
    again = rows.join(wanted.select("id", "name"), same(rows, wanted, ["id", "name"]), "left_semi").groupBy("id", "name").agg(F.first("text").alias("text"))
    again = again.join(wanted, same(again, wanted, ["id", "name"])).select(again["id"], again["name"], "text", "cuts")
    sums = again.mapInArrow(checksums(vocabulary, end), f"id {kind}, name long, start long, length long, crc long")
    summed = cut.drop("crc").join(sums, same(cut, sums, ["id", "name", "start", "length"])).select(*[cut[c] for c in cut.columns if c != "crc"], sums["crc"])
    every = placed.where("crc IS NOT NULL").select(*summed.columns).unionAll(summed)
    return every.select(
        F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"),
        F.col("sequence").alias("sequence_id"), "offset")
