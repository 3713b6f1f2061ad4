"""Set-similarity join on word shingles with prefix filters under several token orders.

Two sets of Jaccard similarity t or more share a token among the first ``n - ceil(t * n) + 1`` tokens of
each, whatever order all tokens are put in. Candidates must pass that test under every order of ``ORDERS``.
The orders put rare tokens first and differ in how they order tokens of equal frequency, so tokens of one
text only come first under each and can be left out.

Counting all tokens is saved by a first sieve whose orders begin with a fixed share of the hash space, the
*low* tokens: only those are counted, and a text all of whose prefix is its own can have no partner. The
texts that pass, mostly real copies, are then ordered by all their tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from logharbor.llm.components import connected_components
from logharbor.llm.frames import dealt_table, drop_dealt, shuffle_partitions, sliced
from logharbor.llm.words import mix, shingle_sets
from logharbor.session import materialize, remove_scratch, scratch_path

#: Seeds of the token orders; tokens of equal frequency are ordered by their hash with the seed.
ORDERS = (1, 2, 3)
#: Size of the low share of the hash space, as a multiple of a prefix's share of its set.
LOW = 1.4
#: One text in so many is looked at for tokens that one in ``HOT`` of them has, ``LEAST_HOT`` at least. So at most
#: ``HOT`` times the mean number of a text's tokens are broadcast.
SAMPLE, HOT, LEAST_HOT = 64, 50, 100
#: Words of 64 bits in the broadcast filter of ids, at most.
FILTER_WORDS = 1 << 20


def prefix_length(n: Column, percent: int) -> Column:
    """How many first tokens of a set of ``n`` must hold a shared one, if a partner shares enough."""
    return n - F.floor((n * percent + 99) / 100).cast("int") + 1


def sketch_sets(width: int, percent: int):
    """Per text: size of its shingle set, 128-bit name of the set, and the tokens that prefixes come from."""
    bound = np.int64(int(min(1.0, LOW * (100 - percent) / 100) * (2**63 - 1)))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in sliced(batches):
                sets = shingle_sets(batch.column(1), width)
                names, low = [], []
                for tokens in sets:
                    h = tokens.view(np.uint64)
                    name = [mix(h + np.uint64(k)).sum(dtype=np.uint64) for k in (1, 2)]
                    names.append(np.array(name, np.uint64).tobytes())
                    n = len(tokens)
                    prefix = n - (n * percent + 99) // 100 + 1
                    low.append(tokens[: max(int(np.searchsorted(tokens, bound)), min(n, prefix))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int32()), pa.array(names, pa.binary()),
                     pa.array(low, pa.list_(pa.int64()))],
                    names=["id", "n", "name", "low"])

    return sketch


def full_sets(width: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in sliced(batches):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(shingle_sets(batch.column(1), width), pa.list_(pa.int64()))],
                    names=["id", "tokens"])

    return build


def sized(a: str, b: str, percent: int) -> Column:
    """Sizes that allow the similarity at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def enough(n: str, place: str, other_n: str, other_place: str, percent: int) -> Column:
    """At a pair's first shared token, what follows in both texts has to suffice for the overlap."""
    after = F.least(F.col(n) - F.col(place), F.col(other_n) - F.col(other_place))
    return after * (100 + percent) >= (F.col(n) + F.col(other_n)) * percent


def tokens_met(sets: DataFrame, row: str) -> tuple[DataFrame, DataFrame]:
    """``(id, token, texts)`` of the tokens that more than one text has; ``texts`` is the same for all of them.

    Tokens that a large share of rows have are found in a sample of the rows first, by column ``row``, and never
    shuffled: which tokens those are decides about the way and about ``texts``, where they count as the most
    frequent ones. One that only copies have may be among them, which costs work and changes no link. All other
    tokens are shuffled once and counted where they meet. The first frame holds the former, the second the latter,
    which lie by token.
    """
    listed = lambda part: part.select("id", F.explode("tokens").alias("token"))
    few = sets.where(F.pmod(F.xxhash64(row), F.lit(SAMPLE)) == 0)
    least = F.lit(max(LEAST_HOT, few.count() // HOT))
    hot = listed(few).groupBy("token").agg(F.count(F.lit(1)).alias("seen")).where(F.col("seen") >= least)
    marked = listed(sets).join(F.broadcast(materialize(hot, "hot")), "token", "left")
    known = marked.where("seen IS NOT NULL").select("id", "token", (F.col("seen") + F.lit(2**40)).alias("texts"))
    rest = marked.where("seen IS NULL").select("id", "token")
    met = Window.partitionBy("token")
    rest = rest.withColumns({"texts": F.count(F.lit(1)).over(met), "least": F.min("id").over(met), "most": F.max("id").over(met)})
    return known, rest.where("least <> most").select("id", "token", "texts")


def open_texts(sets: DataFrame, percent: int, row: str) -> DataFrame:
    """The ids of texts whose prefix has room for tokens of other texts; rows of one id hold the same set.

    As ``open_slots``, but tokens are only counted: repeats of one by copies go where tokens lie together, those of
    hot tokens by the number of copies, and what meets by id is a count for each task.
    """
    known, rest = tokens_met(sets, row)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    met = known.select("id", one.alias("hot"), none.alias("met")).unionAll(
        rest.dropDuplicates(["id", "token"]).select("id", none.alias("hot"), one.alias("met")))
    met = met.groupBy("id").agg(F.sum("hot").alias("hot"), F.sum("met").alias("met"))
    each = sets.groupBy("id").agg(
        F.first("n").alias("n"), F.first(F.size("tokens")).alias("held"), F.count(F.lit(1)).alias("copies"))
    own = F.col("held") - F.col("met") - F.expr("hot DIV copies")
    return each.join(met, "id").where(prefix_length(F.col("n"), percent) > own).select("id")


def open_slots(sets: DataFrame, percent: int) -> DataFrame:
    """Texts ``(id, n)`` whose prefix has room for tokens of other texts; rows that repeat an id are one text.

    Adds ``met`` (tokens that other texts have too, with the number of texts), ``own`` (how many no other
    has) and ``slots`` (how many of ``met`` belong to the prefix). Counts are of all texts given.
    """
    known, rest = tokens_met(sets, "id")
    met = known.unionAll(rest).groupBy("id").agg(F.collect_set(F.struct("texts", "token")).alias("met"))
    own = F.col("held") - F.size("met")
    return (
        sets.groupBy("id").agg(F.first("n").alias("n"), F.first(F.size("tokens")).alias("held"))
        .join(met, "id").withColumn("own", own).drop("held")
        .withColumn("slots", prefix_length(F.col("n"), percent) - F.col("own")).where("slots > 0")
    )


def verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough.

    The pairs are stored first: where they turn out few, Spark takes them to the sets and shuffles no set.
    """
    pairs = materialize(pairs, "pairs")
    first = tokens.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    second = tokens.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    checked = pairs.join(first, "a").join(second, "b").withColumn("shared", shared)
    return checked.where(F.col("shared") * 100 >= (F.size("x") + F.size("y") - F.col("shared")) * percent).select("a", "b")


def passing(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The pairs that share prefix tokens under the remaining orders too."""
    rest = [f"p{k}" for k in ORDERS[1:]]
    first = prefixes.select(F.col("id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in rest])
    second = prefixes.select(F.col("id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in rest])
    joined = pairs.join(first, "a").join(second, "b")
    for c in rest:
        joined = joined.where(F.arrays_overlap(f"a_{c}", f"b_{c}"))
    return joined.select("a", "b")


def likely(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``id`` is one of ``ids``, and some others, without a shuffle of the rows.

    The filter has one bit for a hash of each id, in at most ``FILTER_WORDS`` words however many ids there are. A bit
    in common only lets a row pass: with 3 million ids that is one in twenty of the others, with 50 million half.
    """
    named = F.xxhash64("id")
    word, bit = F.pmod(named, F.lit(FILTER_WORDS)).alias("word"), F.shiftrightunsigned(named, 58).cast("int").alias("bit")
    words = ids.select(word, bit).groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    found = rows.select("*", word, bit).join(F.broadcast(words), "word")
    return found.where("bits & shiftleft(1L, bit) <> 0").select(*rows.columns)


def similar_texts(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id reachable over links).

    A text's set holds its distinct ``width``-word shingles, lower-casing A-Z and splitting at ASCII white
    space; with fewer words the whole sequence is one shingle; null, empty and blank texts have an empty set
    and link with nothing. Two texts link when their sets share ``percent`` per cent of their union or more.
    Rows with equal sets form one class, which is compared once. Rows without id link with nothing and have
    no component; rows that repeat an id count as one document. An empty table gives no rows.

    Links are found in two rounds, so that a large group of copies doesn't meet pair by pair: first every
    text of a prefix token's list is checked against one of the list, then only texts still in different
    components are, where the shared token's place in both leaves room for enough of an overlap. Prefix
    tokens are the rarest, so passages that many texts share hardly ever pair texts.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spark, kind = docs.sparkSession, rows.schema["id"].dataType.simpleString()
    sketched = scratch_path(spark, "sketches")
    schema = f"id {kind}, n int, name binary, low array<long>"
    rows.mapInArrow(sketch_sets(width, percent), schema).write.parquet(sketched)
    low = spark.read.schema(schema).parquet(sketched)
    sketch = materialize(low.drop("low"), "names")
    usable = sketch.where("n > 0 AND id IS NOT NULL")
    classes = materialize(usable.groupBy("name").agg(F.min("id").alias("node")), "sets")
    # Copies go by one name and so meet nothing in each other.
    named = F.xxhash64("name").alias("id")
    filled = low.where("n > 0 AND id IS NOT NULL").select(F.col("id").alias("row"), named, "n", F.col("low").alias("tokens"))
    sieved = open_texts(filled, percent, "row")
    sieved = materialize(classes.select(named, "node").join(sieved, "id").select(F.col("node").alias("id")), "sieved")
    remove_scratch(spark, sketched)
    # Dealt by id once, sets lie where all later joins by id look for them.
    # An inner join, as Catalyst would move a semi join below the filter and shuffle all texts for it.
    texts = likely(rows.where("id IS NOT NULL"), sieved).repartition(shuffle_partitions(spark), "id").join(sieved.distinct(), "id")
    tokens, stored = dealt_table(texts.mapInArrow(full_sets(width), f"id {kind}, tokens array<long>"), "id", "tokens")

    ordered = open_slots(tokens.dropDuplicates(["id"]).withColumn("n", F.size("tokens")), percent)
    order = [
        F.slice(F.transform(F.array_sort(F.transform("met", lambda m: F.struct(
            m["texts"].alias("f"), F.xxhash64(m["token"], F.lit(k)).alias("h"), m["token"].alias("token")))),
            lambda m: m["token"]), F.lit(1), F.col("slots")).alias(f"p{k}")
        for k in ORDERS
    ]
    prefixes = materialize(ordered.select("id", "n", "own", *order), "prefixes")

    lists = prefixes.select("id", "n", "own", F.posexplode(f"p{ORDERS[0]}").alias("at", "token"))
    lists = lists.withColumn("place", F.col("own") + F.col("at")).drop("at")
    centres = lists.groupBy("token").agg(
        F.min(F.struct("own", "id", "n", "place")).alias("c"), F.count(F.lit(1)).alias("texts")).where("texts > 1")
    around = lists.join(centres.select("token", F.col("c.id").alias("id_c"), F.col("c.n").alias("n_c"), F.col("c.place").alias("place_c")), "token")
    around = around.where((F.col("id") != F.col("id_c")) & sized("n", "n_c", percent) & enough("n", "place", "n_c", "place_c", percent))
    around = around.select(F.col("id_c").alias("a"), F.col("id").alias("b")).distinct()
    links = materialize(verified(passing(around, prefixes), tokens, percent), "links")

    found = connected_components(links).withColumnRenamed("node", "id")
    placed = lists.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    placed = materialize(placed.join(mixed.select("token"), "token"), "placed")
    one = placed.select("token", *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "place", "component")])
    two = placed.select("token", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "place", "component")])
    # The smaller text of a pair has to share so much of itself that its first shared token comes early.
    one = one.where((F.col("n_a") - F.col("place_a")) * (100 + percent) >= F.col("n_a") * 2 * percent)
    smaller = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("id_a") < F.col("id_b")))
    across = one.join(two, "token").where(
        smaller & (F.col("component_a") != F.col("component_b"))
        & sized("n_a", "n_b", percent) & enough("n_a", "place_a", "n_b", "place_b", percent))
    across = across.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    more = materialize(verified(passing(across, prefixes), tokens, percent), "links")
    drop_dealt(spark, stored)

    found = connected_components(links.union(more))
    named = classes.join(found, "node", "left").select("name", F.coalesce("component", "node").alias("component"))
    return sketch.select("id", "n", "name").join(named, "name", "left").select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))).alias("component_id"),
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their group, with their columns; rows without id stay."""
    marks = similar_texts(docs, width, percent, id_col, text_col)
    gone = marks.where(F.col("component_id") < F.col(id_col)).select(id_col)
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
