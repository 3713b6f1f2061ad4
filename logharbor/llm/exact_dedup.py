"""Exact duplicates: frequent digests are settled on the map side, the others by an ordinary shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from logharbor.llm.frames import ascii_lower, fresh
from logharbor.session import materialize

#: Counters of a Misra-Gries summary; also the most digests that are ever broadcast.
COUNTERS = 1024


def text_digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8 after lower-casing A-Z; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(text).cast("binary"), 256))


def misra_gries(counters: int, digest: str = "digest"):
    """Summary of one partition: at most ``counters`` digests with lower bounds of their counts."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = pa.table({"digest": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(digest))
            seen = pc.value_counts(column.cast(pa.binary()))
            fresh_counts = pa.table({"digest": seen.field("values"), "n": seen.field("counts").cast(pa.int64())})
            kept = pa.concat_tables([kept, fresh_counts]).group_by("digest").aggregate([("n", "sum")])
            kept = pa.table({"digest": kept["digest"], "n": kept["n_sum"]})
            if kept.num_rows > counters:
                # Taking off the largest count left out keeps every count within rows / counters of the truth.
                order = pc.sort_indices(kept["n"], sort_keys=[("", "descending")])
                excess = kept["n"][order[counters].as_py()]
                kept = kept.set_column(1, "n", pc.subtract(kept["n"], excess))
                kept = kept.filter(pc.greater(kept["n"], 0))
        if kept.num_rows:
            yield from kept.combine_chunks().to_batches()

    return summarise


def frequent_digests(digests: DataFrame, id_col: str, counters: int = COUNTERS) -> DataFrame:
    """``(digest, winner, copies)`` of digests that hold more than 2 / counters of all rows, counted exactly.

    The summaries' counts are lower bounds, short by at most rows / (counters + 1) in total. Digests whose
    summed bounds reach rows / counters are the candidates: no more than ``counters`` of them can exist, and
    none that holds 2 / counters of the rows is missed. A second pass over the digests counts the candidates
    exactly. Every row below ends up in the shuffled rest, so the split decides cost only, never results.
    """
    spark = digests.sparkSession
    rows = digests.count()
    bounds = digests.select("digest").mapInArrow(misra_gries(counters), "digest binary, n long")
    floor = max(2, -(-rows // counters))
    candidates = materialize(bounds.groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") >= floor).select("digest"), "frequent")
    counted = digests.join(F.broadcast(candidates), "digest").groupBy("digest").agg(
        F.max(id_col).alias("winner"), F.count(F.lit(1)).alias("copies"))
    return materialize(counted, "frequent").where("copies > 1") if rows else spark.createDataFrame([], counted.schema)


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: id, ``digest``, ``keep_id``, ``group_size``, ``kept``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The largest id of a group
    stays (a null id only where no other is there); of rows that repeat text and id, one stays. An empty
    table gives no rows. Other columns play no part.

    Only ids and digests are shuffled. The copies of frequent digests that go are settled where they are
    read, by a join with at most ``counters`` broadcast rows; their winners and all other rows meet in an
    ordinary shuffle, in which no digest has more than 2 / counters of the rows.
    """
    thin = docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest"))
    thin = materialize(thin, "digests")
    frequent = frequent_digests(thin, "id", counters)
    tagged = thin.join(F.broadcast(frequent), "digest", "left")
    beaten = F.col("winner").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("winner")))
    losers = tagged.where(beaten).select(
        "id", "digest", F.col("winner").alias("keep_id"), F.col("copies").alias("group_size"), F.lit(False).alias("kept"))
    group = Window.partitionBy("digest")
    rest = tagged.where(~beaten).select(
        "id", "digest",
        F.max("id").over(group).alias("keep_id"),
        F.coalesce("copies", F.count(F.lit(1)).over(group)).alias("group_size"),
        (F.row_number().over(group.orderBy(F.desc_nulls_last("id"))) == 1).alias("kept"),
    )
    return rest.union(losers).withColumnRenamed("id", id_col)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with the columns they came with; rules as in :func:`mark_duplicates`.

    The frequent copies are removed before the texts are shuffled.
    """
    digest, place = fresh(docs, "digest"), fresh(docs, "place")
    thin = materialize(docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest")), "digests")
    frequent = frequent_digests(thin, "id", counters).select(F.col("digest").alias(digest), F.col("winner").alias(place))
    tagged = docs.withColumn(digest, text_digest(F.col(text_col))).join(F.broadcast(frequent), digest, "left")
    own, winner = F.col(id_col), F.col(place)
    tagged = tagged.where(winner.isNull() | (own >= winner)).drop(place)
    first = Window.partitionBy(digest).orderBy(F.desc_nulls_last(id_col))
    return tagged.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(*docs.columns)
