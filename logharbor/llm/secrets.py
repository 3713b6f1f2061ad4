"""Secrets: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Everything here is DataFrame and SQL functions; the driver only turns transition counts into a table of
log-likelihood ratios.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from logharbor.llm.frames import bounded_sample
from logharbor.session import materialize

KINDS = ("assign", "access", "hex")
RANDOM = "random"
# Fixed patterns of the base spans. The last two say "at least so long" in the pattern, which is the same
# for runs of one set of characters.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: What the models judge: runs of characters that keys and identifiers are made of.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Labelled samples of each class, at most.
SAMPLES = 5000
#: Weight, in counts, of how frequent a character is when transitions from the one before it are few.
PRIOR = 20.0
#: A string is random if its log-likelihood ratio is at least this, in total and per transition.
LEAST_TOTAL, LEAST_EACH = 10.0, 0.35


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def running_sums(amounts: Column) -> Column:
    """Sums of a long array up to and with each place.

    A fold that grows an array copies it at each step, so places are folded in blocks of about the square root of
    their number, and blocks are then moved by the sums before them.
    """
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("CAST(array() AS array<bigint>)").alias("sums"))

    def step(state: Column, amount: Column) -> Column:
        at = state["at"] + amount
        return F.struct(at.alias("at"), F.concat(state["sums"], F.array(at)).alias("sums"))

    def moved(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: p["at"])
        ends = F.aggregate(totals, start, step, lambda state: state["sums"])
        return F.flatten(F.zip_with(F.zip_with(parts, totals, lambda p, own: F.struct(p["sums"].alias("sums"), own.alias("own"))), ends,
                                    lambda p, end: F.transform(p["sums"], lambda s: s + end - p["own"])))

    def summed(given: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(given))).cast("int")
        parts = F.transform(F.sequence(F.lit(1), F.size(given), width), lambda i: F.aggregate(F.slice(given, i, width), start, step))
        return F.when(F.size(given) > 0, bound(parts, moved)).otherwise(F.expr("CAST(array() AS array<bigint>)"))

    return bound(amounts, summed)


def spans(text: Column, pattern: str, kind: str, value_group: int = 0) -> Column:
    """Matches of the pattern, leftmost and without overlap: array of ``(kind, start, end, value)``.

    The pieces between matches give the positions, in code points.
    """
    hit = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else hit
    hits = F.arrays_zip(hit.alias("hit"), value.alias("value"), F.split(text, pattern, -1).alias("piece"))

    def placed(found: Column) -> Column:
        ends = running_sums(F.transform(found, lambda h: (F.length(h["piece"]) + F.length(h["hit"])).cast("long")))
        return F.zip_with(found, ends, lambda h, end: F.struct(
            F.lit(kind).alias("kind"), (end - F.length(h["hit"])).alias("start"), end.alias("end"), h["value"].alias("value")))

    # The piece after the last match comes without a hit.
    found = bound(F.filter(hits, lambda h: h["hit"].isNotNull()), placed)
    return F.when(text.rlike(pattern), found).otherwise(
        F.expr("CAST(array() AS array<struct<kind:string,start:bigint,end:bigint,value:string>>)"))


def apart(candidates: Column, base: Column) -> Column:
    """The candidates, disjoint and in order, that overlap no base span.

    Base spans that start before a candidate's end, less those that end by its start, are those it overlaps. Both
    counts are read off one sorted list of all ends, which at equal places has ends, then candidates, then starts.
    """
    def marks(found: Column, place: str, turn: int) -> Column:
        return F.transform(found, lambda s: F.struct(s[place].alias("at"), F.lit(turn).alias("turn")))

    both = F.concat(marks(base, "end", 0), marks(candidates, "start", 1), marks(candidates, "end", 1), marks(base, "start", 2))

    def counted(sorted_marks: Column) -> Column:
        def before(turn: int) -> Column:
            return running_sums(F.transform(sorted_marks, lambda m: (m["turn"] == turn).cast("long")))

        known = F.arrays_zip(sorted_marks.alias("mark"), before(0).alias("ended"), before(2).alias("begun"))
        return F.filter(known, lambda k: k["mark"]["turn"] == 1)

    # Of a candidate's two marks the first comes at an even place.
    starts = lambda found: F.filter(found, lambda k, i: i % 2 == 0)
    ends = lambda found: F.filter(found, lambda k, i: i % 2 == 1)
    overlaps = bound(bound(F.array_sort(both), counted), lambda found: F.zip_with(
        starts(found), ends(found), lambda s, e: e["begun"] - s["ended"]))
    paired = F.zip_with(candidates, overlaps, lambda c, n: F.struct(c.alias("c"), n.alias("n")))
    return F.transform(F.filter(paired, lambda p: p["n"] == 0), lambda p: p["c"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``base`` spans by start and kind, and ``candidates`` that overlap none of them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    assigned = F.filter(spans(text, ASSIGN, "assign", 2), lambda s: F.length(s["value"]) >= 12)
    rows = docs.select(F.col(id_col).alias("id"), F.concat(assigned, spans(text, ACCESS, "access"), spans(text, HEX, "hex")).alias("base"),
                       spans(text, CANDIDATE, RANDOM).alias("candidates"))
    rows = rows.withColumn("base", F.expr("array_sort(base, (a, b) -> CASE WHEN a.start <> b.start THEN CASE WHEN a.start < b.start THEN -1 ELSE 1 END "
                                          "WHEN a.kind = b.kind THEN 0 WHEN a.kind = 'assign' OR (a.kind = 'access' AND b.kind = 'hex') THEN -1 ELSE 1 END)"))
    return rows.withColumn("candidates", F.when(F.size("base") == 0, F.col("candidates")).otherwise(apart(F.col("candidates"), F.col("base"))))


def symbol(c: Column) -> Column:
    """Number of a character among SYMBOLS, from 0; one more for all others."""
    place = F.instr(F.lit(SYMBOLS), c)
    return F.when(place > 0, place - 1).otherwise(len(SYMBOLS))


def transitions(value: Column) -> Column:
    """Codes of a string's neighbouring pairs of characters."""
    codes = F.transform(F.filter(F.split(value, ""), lambda c: c != ""), symbol)
    pairs = F.greatest(F.length(value) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, F.lit(1), pairs), F.slice(codes, F.lit(2), pairs), lambda a, b: a * (len(SYMBOLS) + 1) + b)


def train(scanned: DataFrame) -> list[float]:
    """Log-likelihood ratio of every transition, random over ordinary.

    Labels: values of base spans are random strings; candidates of letters only, outside base spans, are
    ordinary identifiers. Of either, at most ``SAMPLES`` different ones, those first by hash, are used.
    """
    random = scanned.select(F.explode("base.value").alias("value"))
    ordinary = scanned.select(F.explode("candidates.value").alias("value")).where(F.col("value").rlike("^[A-Za-z_-]+$"))
    counts = None
    for label, values in ((1, random), (0, ordinary)):
        values = bounded_sample(materialize(values.distinct(), "values"), ["value"], SAMPLES)
        part = values.select(F.explode(transitions(F.col("value"))).alias("pair")).groupBy("pair").count().withColumn("label", F.lit(label))
        counts = part if counts is None else counts.union(part)
    size = len(SYMBOLS) + 1
    seen = [[0] * (size * size) for _ in range(2)]
    for row in counts.collect():
        seen[row["label"]][row["pair"]] += row["count"]
    logs = []
    for label, part in enumerate(seen):
        total = sum(part)
        # Samples of random strings use few alphabets, so half their weight goes to all characters alike.
        even = 0.5 if label else 0.0
        single = [even / size + (1 - even) * (sum(part[b::size]) + 0.5) / (total + 0.5 * size) for b in range(size)]
        rows = [part[a * size : (a + 1) * size] for a in range(size)]
        learned = [[(n + PRIOR * single[b]) / (sum(row) + PRIOR) for b, n in enumerate(row)] for row in rows]
        logs.append([math.log(even / size + (1 - even) * p) for row in learned for p in row])
    return [r - o for o, r in zip(*logs)]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``base`` and ``spans``, arrays of ``(kind, start, end, value)`` by start and kind.

    Null counts as empty; empty texts have none; texts are read whole. Rows that repeat or lack an id are
    handled like others; an empty table gives no rows; other columns play no part.
    """
    scanned = materialize(scan(docs, id_col, text_col), "secrets")
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in train(scanned))), ",").cast("array<double>")

    def is_random(candidate: Column) -> Column:
        steps = transitions(candidate["value"])
        total = F.aggregate(steps, F.lit(0.0), lambda acc, code: acc + F.get(table, code))
        return total >= F.greatest(F.lit(LEAST_TOTAL), LEAST_EACH * (F.length(candidate["value"]) - 1))

    found = F.filter("candidates", is_random)
    every = F.expr("array_sort(concat(base, extra), (a, b) -> CASE WHEN a.start < b.start THEN -1 WHEN a.start > b.start THEN 1 "
                   "WHEN a.kind = b.kind THEN 0 WHEN a.kind = 'assign' OR (a.kind = 'access' AND b.kind = 'hex') THEN -1 ELSE 1 END)")
    return scanned.withColumn("extra", found).select(F.col("id").alias(id_col), "base", every.alias("spans"))
