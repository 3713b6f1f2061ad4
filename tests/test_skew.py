"""One key holds most of the rows: work must still be spread, results complete."""

from pyspark.sql import functions as F

from logharbor.operators.dedup import metric_dedup
from logharbor.operators.skew import lookup, previous_value, running_total
from tests.models import keep_changed


def hot_rows(spark, n):
    """Two thirds of the rows have key 'hot'."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.col("id").alias("pos"), (F.col("id") % 7 + 1).alias("v"))


def partition_sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_lookup_spreads_a_hot_key(spark):
    rows = hot_rows(spark, 30_000)
    table = rows.select("k").distinct().withColumn("x", F.length("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup(rows, table, ["k"], ["pos"])
        sizes = partition_sizes(joined)
        assert sum(sizes) == 30_000 and max(sizes) < 10_000
        assert joined.where("x <> length(k)").count() == 0
        assert lookup(rows, table.where("k = 'hot'"), ["k"], ["pos"], how="left_anti").count() == 10_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_previous_value_and_running_total_over_many_buckets(spark):
    rows = hot_rows(spark, 20_000)
    got = previous_value(rows, ["k"], "pos", "prev", 64).collect()
    totals = {(r.k, r.pos): r.total for r in running_total(rows, ["k"], "pos", F.col("v"), "total", 64).collect()}
    before, summed = {}, {}
    assert len(got) == 20_000
    for r in sorted(got, key=lambda r: r.pos):
        assert r.prev == before.get(r.k)
        before[r.k] = r.pos
        summed[r.k] = summed.get(r.k, 0) + r.v
        assert totals[r.k, r.pos] == summed[r.k]


def test_dedup_splits_a_hot_device(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise("s").alias("session_id"), F.lit(0).alias("device_id"),
        F.col("id").alias("row_no"), (F.col("id") * 700).alias("ts_ms"), F.lit(1).alias("gpu_util"), F.lit(1).alias("mem_util"),
        (40 + F.col("id") % 5).cast("int").alias("temp_c"), F.lit(100).alias("power_mw"),
        F.lit(1).cast("bigint").alias("used_mib"), F.lit(1).alias("clock_sm"))
    kept = metric_dedup(rows)
    assert max(partition_sizes(kept)) < 0.3 * sum(partition_sizes(kept))
    samples = [r.asDict() for r in rows.collect()]
    assert sorted(r.row_no for r in kept.collect()) == sorted(s["row_no"] for s in keep_changed(samples))
