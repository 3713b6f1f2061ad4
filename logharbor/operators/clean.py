"""Line cleaning and the expansion of device-metric batches."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from logharbor.functions.lines import is_blank, is_json, line_types
from logharbor.functions.metrics import metric_position, metric_value
from logharbor.operators.dedup import metric_dedup
from logharbor.operators.skew import join_keys
from logharbor.schemas import (
    DEDUP_CHANNEL,
    METRIC_BATCH,
    METRIC_BATCH_TYPE,
    METRIC_COLUMNS,
    WINDOW,
)
from logharbor.session import materialize

LINE = [*WINDOW, "line_no"]


def drop_blank(lines: DataFrame) -> DataFrame:
    return lines.where(~is_blank(F.col("line")))


def drop_malformed(lines: DataFrame) -> DataFrame:
    """Keep valid JSON lines and add their ``event_type``.

    The type comes out of a generator, which both drops the other lines and keeps the
    optimizer from parsing each line a second time for a pushed-down filter.
    """
    return lines.select("*", F.explode(line_types(F.col("line"))).alias("event_type"))


def malformed_lines(lines: DataFrame) -> DataFrame:
    return drop_blank(lines).where(~is_json(F.col("line")))


def clean_lines(lines: DataFrame) -> DataFrame:
    return drop_malformed(drop_blank(lines))


def parsed_batch(line: Column) -> Column:
    return F.from_json(line, METRIC_BATCH)


def dedup_applies(lines: DataFrame) -> DataFrame:
    """Add ``batch`` (columns and rows) where the line is a device-metric batch on the
    dedup channel whose rows can all be compared, null where the line passes unchanged.

    A batch with a row that is no array, or too short to name its device, cannot be
    compared and passes as a whole.
    """
    candidate = (F.col("channel") == DEDUP_CHANNEL) & (F.col("event_type") == METRIC_BATCH_TYPE)

    def usable(batch: Column) -> Column:
        device = metric_position(batch["columns"], "device_id")
        return (
            F.array_contains(batch["columns"], "device_id")
            & F.array_contains(batch["columns"], "gpu_util")
            & F.forall(batch["rows"], lambda row: row.isNotNull() & (F.size(row) > device))
        )

    # As a generator of one row, for the same reason as in ``drop_malformed``.
    parsed = F.array(F.when(candidate, parsed_batch(F.col("line"))))
    found = F.transform(parsed, lambda batch: F.when(F.coalesce(usable(batch), F.lit(False)), batch))
    return lines.select("*", F.explode(found).alias("batch"))


def explode_metric_batch(lines: DataFrame) -> DataFrame:
    """One typed row per sample of the batches in ``batch``, with its ordinal."""
    rows = lines.select(
        *[c for c in lines.columns if c not in ("line", "batch")],
        F.col("batch.columns").alias("_columns"),
        F.posexplode("batch.rows").alias("row_no", "_row"),
    )
    values = {
        name: metric_value(
            F.col("_columns"), F.col("_row"), name, "bigint" if name == "used_mib" else "int"
        )
        for name in METRIC_COLUMNS
    }
    return rows.withColumns(values).drop("_columns", "_row")


def dedup_summary(batches: DataFrame, kept: DataFrame, keys: Sequence[str] = tuple(LINE)) -> DataFrame:
    """Per batch line: its rows, the kept ordinals, and what becomes of the line."""
    kept_rows = kept.groupBy(*keys).agg(F.array_sort(F.collect_list("row_no")).alias("kept_rows"))
    total = F.size("batch.rows").cast("bigint")
    left = F.coalesce(F.size("kept_rows"), F.lit(0)).cast("bigint")
    return (
        join_keys(batches, kept_rows, keys, "left")
        .withColumns({"row_count": total, "kept_count": left})
        .withColumn(
            "action",
            F.when(F.col("kept_count") == 0, "drop")
            .when(F.col("kept_count") == F.col("row_count"), "original")
            .otherwise("rewrite"),
        )
    )


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("line").to_pylist()
        rewritten = pc.equal(batch.column("action"), "rewrite")
        for n in np.flatnonzero(rewritten.to_numpy(zero_copy_only=False)).tolist():
            try:
                root = json.loads(texts[n])
                root["rows"] = [root["rows"][row] for row in batch.column("kept_rows")[n].as_py()]
                text = json.dumps(root, separators=(",", ":"), ensure_ascii=False)
                text.encode()
            except (ValueError, RecursionError):
                continue  # what can't be written anew, such as half a surrogate pair, goes out as it came
            texts[n] = text
        at = batch.schema.get_field_index("line")
        yield batch.set_column(at, "line", pa.array(texts, pa.string()))


def repack_metric_batch(summary: DataFrame) -> DataFrame:
    """Lines to send for deduplicated batches: the original text if every row was kept,
    else the batch with the kept rows; none if no row was kept. A batch that can't be
    written anew goes out whole."""
    sent = summary.where("action <> 'drop'").drop("batch")
    return sent.mapInArrow(_rewrite, sent.schema)


def dedup_lines(
    lines: DataFrame, time_col: str, key_cols: Sequence[str] = ("folder", "session_id", "device_id")
) -> DataFrame:
    """Drop unchanged samples from the metric batches among ``lines`` (cleaned, typed).

    All rows of a batch share the time in ``time_col``. Only the dedup channel takes part:
    its lines are stored once, parsed, for the passes over them; the lines of the other
    channels go straight through.
    """
    elsewhere = lines.where(~F.col("channel").eqNullSafe(DEDUP_CHANNEL))
    marked = materialize(dedup_applies(lines.where(F.col("channel") == DEDUP_CHANNEL)), "dedup")
    batches = marked.where("batch is not null")
    others = marked.where("batch is null").drop("batch")
    samples = explode_metric_batch(batches.withColumn("ts_ms", F.col(time_col)))
    kept = metric_dedup(
        samples.select(*LINE, "row_no", "ts_ms", *METRIC_COLUMNS),
        key_cols,
        ["ts_ms", *[c for c in LINE if c not in key_cols], "row_no"],
    )
    sent = repack_metric_batch(dedup_summary(batches, kept))
    return elsewhere.unionByName(others).unionByName(sent.select(others.columns))
