"""Lines, metric batches, deduplication and packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import HOST, IP, NOW_MS, URL, fixture, oracle
from checks.registry import query
from logharbor.functions import lines as fl
from logharbor.functions.metrics import percent_diff
from logharbor.functions.paths import channel_filter
from logharbor.operators import clean, packing, sequence
from logharbor.operators.dedup import metric_dedup as dedup
from logharbor.schemas import METRIC_COLUMNS, WINDOW
from logharbor.session import materialize
from logharbor.plans.line_path import line_events, line_requests

KEY = "folder, session_id, channel, window_sequence, line_no"
VALID = r"NOT regexp_full_match(line, '\s*') AND json_valid(line)"
TYPE = """CASE WHEN json_type(line, '$.type') IN ('OBJECT', 'ARRAY') THEN 'unknown'
     ELSE COALESCE(json_extract_string(line, '$.type'), 'unknown') END"""
TYPED = f"typed AS (SELECT *, {TYPE} AS event_type FROM lines WHERE {VALID})"


@query(oracle(f"SELECT {KEY}, line, {TYPE} AS event_type FROM lines WHERE json_valid(line)"))
def event_type(spark, sf_dir):
    return fixture(spark, sf_dir, "lines").withColumn(
        "event_type", fl.event_type(F.col("line"))).where("event_type is not null")


@query(oracle(rf"SELECT {KEY}, line FROM lines WHERE NOT regexp_full_match(line, '\s*')"))
def drop_blank(spark, sf_dir):
    return clean.drop_blank(fixture(spark, sf_dir, "lines"))


@query(oracle(f"SELECT *, {TYPE} AS event_type FROM lines WHERE json_valid(line)"))
def drop_malformed(spark, sf_dir):
    return clean.drop_malformed(fixture(spark, sf_dir, "lines"))


@query(oracle(r"SELECT * FROM lines WHERE NOT regexp_full_match(line, '\s*') AND NOT json_valid(line)"))
def malformed_lines(spark, sf_dir):
    return clean.malformed_lines(fixture(spark, sf_dir, "lines"))


@query(oracle(f"SELECT * FROM typed", TYPED))
def clean_lines(spark, sf_dir):
    return clean.clean_lines(fixture(spark, sf_dir, "lines"))


@query(oracle("SELECT * FROM lines WHERE channel IN ('device', 'sass')"))
def channel_filter_lines(spark, sf_dir):
    return channel_filter(fixture(spark, sf_dir, "lines"), " device, ,sass ")


@query(oracle(f"""
SELECT {KEY}, CAST({NOW_MS} AS BIGINT) AS "agentSendingTime", line AS data, event_type AS type,
       '{HOST}' AS hostname, '{IP}' AS "ipAddr" FROM typed""", TYPED))
def envelope(spark, sf_dir):
    lines = clean.clean_lines(fixture(spark, sf_dir, "lines"))
    wrapped = fl.envelope(F.col("line"), F.col("event_type"), F.lit(NOW_MS), HOST, IP)
    return lines.select(*clean.LINE, wrapped.alias("e")).select(*clean.LINE, "e.*")


@query(oracle(f"""
SELECT {KEY}, 'gpu-trace' AS topic, channel AS key, CAST(to_json(line) AS VARCHAR) AS value FROM typed""", TYPED))
def kafka_record(spark, sf_dir):
    lines = clean.clean_lines(fixture(spark, sf_dir, "lines"))
    return lines.select(*clean.LINE, *fl.kafka_record(F.col("line"), F.col("channel")))


@query(oracle(f"""
SELECT {KEY}, concat('https://collector.example/api/v1/events/', event_type) AS url, 'gpu-trace' AS x_topic,
       channel AS x_key, concat('{{"agentSendingTime":{NOW_MS},"data":', CAST(to_json(line) AS VARCHAR), ',"type":',
       CAST(to_json(event_type) AS VARCHAR), ',"hostname":"{HOST}","ipAddr":"{IP}"}}') AS body FROM typed""", TYPED))
def http_event_body(spark, sf_dir):
    lines = clean.clean_lines(fixture(spark, sf_dir, "lines"))
    wrapped = fl.envelope(F.col("line"), F.col("event_type"), F.lit(NOW_MS), HOST, IP)
    sent = lines.select(*clean.LINE, *fl.http_event(wrapped, F.col("channel"), URL))
    return sent.select(*clean.LINE, "url", F.col("headers")["X-Topic"].alias("x_topic"),
                       F.col("headers")["X-Key"].alias("x_key"), "body")


OFFSETS = """offsets AS (SELECT *, CAST(SUM(strlen(line) + 1) OVER w AS BIGINT) AS byte_end,
  CAST(SUM(strlen(line) + 1) OVER w - strlen(line) - 1 AS BIGINT) AS byte_start FROM lines
  WINDOW w AS (PARTITION BY folder, session_id, channel, window_sequence ORDER BY line_no))"""


@query(oracle("SELECT * FROM offsets", OFFSETS))
def line_offsets(spark, sf_dir):
    return sequence.line_offsets(fixture(spark, sf_dir, "lines"))


@query(oracle("SELECT * FROM lines ORDER BY folder, session_id, channel, window_sequence, line_no"))
def line_order(spark, sf_dir):
    return sequence.line_order(fixture(spark, sf_dir, "lines"))


START = """started AS (SELECT o.*, CAST(GREATEST(1, COALESCE(c.file_index, 0)) AS BIGINT) AS start_index,
  CAST(CASE WHEN COALESCE(c.file_index, 0) >= 1 THEN COALESCE(c.read_offset, 0) ELSE 0 END AS BIGINT) AS start_offset
  FROM offsets o LEFT JOIN cursors c USING (folder, session_id, channel))"""


@query(oracle("""SELECT * FROM started WHERE window_sequence > start_index
  OR (window_sequence = start_index AND byte_start >= start_offset)""", OFFSETS, START))
def resume_filter(spark, sf_dir):
    lines = sequence.line_offsets(fixture(spark, sf_dir, "lines"))
    return sequence.resume_lines(lines, fixture(spark, sf_dir, "cursors"))


# -- device metrics ------------------------------------------------------------------

COLUMNS = "json_extract_string(line, '$.columns[*]')"
ROWS = "json_extract(line, '$.rows[*]')"
CANDIDATES = f"""parsed AS (SELECT *, {COLUMNS} AS cols, {ROWS} AS vals FROM batch_lines),
applying AS (SELECT * FROM parsed WHERE channel = 'system'
  AND json_extract_string(line, '$.type') = 'device_metric_batch'
  AND list_contains(cols, 'device_id') AND list_contains(cols, 'gpu_util')
  AND len(list_filter(vals, lambda r: json_array_length(r) < list_position(cols, 'device_id'))) = 0)"""


def value(name, kind="INTEGER"):
    return f"""CAST(COALESCE(TRY_CAST(list_extract(json_extract_string(r, '$[*]'),
      CAST(COALESCE(list_position(cols, '{name}'), 0) AS BIGINT)) AS BIGINT), 0) AS {kind}) AS {name}"""


VALUES = ", ".join(value(c, "BIGINT" if c == "used_mib" else "INTEGER") for c in METRIC_COLUMNS)
SAMPLES = f"""unnested AS (SELECT *, UNNEST(vals) AS r, UNNEST(range(len(vals))) AS row_no FROM applying),
samples AS (SELECT {KEY}, sent_ms, sent_ms AS ts_ms, CAST(row_no AS INTEGER) AS row_no, r, {VALUES} FROM unnested)"""


def dedup_sql(source, keys, order):
    """Recursive fold of the dedup rule over one key's rows in order."""
    exact = ["gpu_util", "mem_util", "used_mib", "clock_sm"]
    state = ["ts_ms", "temp_c", "power_mw", *exact]
    emit = f"""o.ts_ms - f.b_ts_ms > 60000 OR abs(o.temp_c - f.b_temp_c) > 1
      OR CASE WHEN f.b_power_mw = 0 THEN o.power_mw <> 0
              ELSE trunc(abs(o.power_mw - f.b_power_mw) * 100.0 / f.b_power_mw) > 10 END
      OR {' OR '.join(f'o.{c} <> f.b_{c}' for c in exact)}"""
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}) AS rn FROM {source}),
fold AS (
  SELECT {', '.join(keys)}, rn, true AS keep, {', '.join(f'{c} AS b_{c}' for c in state)} FROM numbered WHERE rn = 1
  UNION ALL
  SELECT {', '.join(keys)}, rn, keep, {', '.join(f'CASE WHEN keep THEN n_{c} ELSE b_{c} END' for c in state)} FROM (
    SELECT {', '.join(f'o.{k}' for k in keys)}, o.rn, ({emit}) AS keep,
           {', '.join(f'o.{c} AS n_{c}, f.b_{c}' for c in state)}
    FROM fold f JOIN numbered o ON {' AND '.join(f'o.{k} = f.{k}' for k in keys)} AND o.rn = f.rn + 1)),
kept AS (SELECT n.* FROM numbered n JOIN fold f USING ({', '.join(keys)}, rn) WHERE f.keep)"""


SAMPLE_DEDUP = dedup_sql("metric_rows", ["session_id", "device_id"], ["ts_ms", "row_no"])
BATCH_DEDUP = dedup_sql("samples", ["folder", "session_id", "device_id"],
                        ["ts_ms", "channel", "window_sequence", "line_no", "row_no"])


@query(oracle("SELECT * EXCLUDE (rn) FROM kept", SAMPLE_DEDUP, recursive=True))
def metric_dedup(spark, sf_dir):
    return dedup(fixture(spark, sf_dir, "metric_rows"))


@query(oracle("""SELECT row_no, power_mw, CAST(CASE WHEN gpu_util = 0 THEN CASE WHEN power_mw = 0 THEN 0 ELSE 100 END
  ELSE trunc(abs(power_mw - gpu_util * 700) * 100.0 / (gpu_util * 700)) END AS BIGINT) AS percent FROM metric_rows"""))
def percent_change(spark, sf_dir):
    rows = fixture(spark, sf_dir, "metric_rows")
    return rows.select("row_no", "power_mw",
                       percent_diff(F.col("power_mw"), F.col("gpu_util") * 700).alias("percent"))


def batches(spark, sf_dir):
    typed = clean.clean_lines(fixture(spark, sf_dir, "batch_lines"))
    return clean.dedup_applies(typed)


def kept_samples(spark, sf_dir):
    applying = batches(spark, sf_dir).where("batch is not null").withColumn("ts_ms", F.col("sent_ms"))
    samples = clean.explode_metric_batch(applying).drop("sent_ms", "event_type")
    kept = dedup(samples, ["folder", "session_id", "device_id"],
                 ["ts_ms", "channel", "window_sequence", "line_no", "row_no"])
    return applying, kept


@query(oracle(f"""SELECT {KEY}, EXISTS (SELECT 1 FROM applying a WHERE a.line_no = b.line_no) AS applies
  FROM batch_lines b""", CANDIDATES))
def dedup_applies(spark, sf_dir):
    return batches(spark, sf_dir).select(*clean.LINE, F.col("batch").isNotNull().alias("applies"))


@query(oracle("SELECT * EXCLUDE (r, ts_ms) FROM samples", CANDIDATES, SAMPLES))
def explode_metric_batch(spark, sf_dir):
    applying = batches(spark, sf_dir).where("batch is not null")
    return clean.explode_metric_batch(applying).drop("event_type")


@query(oracle(f"""SELECT {KEY}, {VALUES} FROM (SELECT *, vals[1] AS r FROM parsed WHERE len(vals) > 0)""", CANDIDATES))
def metric_value(spark, sf_dir):
    from logharbor.functions.metrics import metric_value as named

    lines = fixture(spark, sf_dir, "batch_lines").withColumn("b", clean.parsed_batch(F.col("line")))
    values = [named(F.col("b.columns"), F.col("b.rows")[0], c, "bigint" if c == "used_mib" else "int").alias(c)
              for c in METRIC_COLUMNS]
    return lines.where("size(b.rows) > 0").select(*clean.LINE, *values)


SUMMARY = """summary AS (SELECT a.*, CAST(len(a.vals) AS BIGINT) AS row_count, CAST(COUNT(k.row_no) AS BIGINT) AS kept_count,
  string_agg(CAST(k.r AS VARCHAR), ',' ORDER BY k.row_no) AS kept_text
  FROM applying a LEFT JOIN kept k USING (folder, session_id, channel, window_sequence, line_no) GROUP BY ALL)"""
ACTION = "CASE WHEN kept_count = 0 THEN 'drop' WHEN kept_count = row_count THEN 'original' ELSE 'rewrite' END"
REPACKED = f"""repacked AS (SELECT *, CASE WHEN kept_count = row_count THEN line
  ELSE regexp_replace(line, '"rows":.*\\]\\]', concat('"rows":[', kept_text, ']')) END AS text
  FROM summary WHERE kept_count > 0)"""


@query(oracle(f"SELECT {KEY}, row_count, kept_count, {ACTION} AS action FROM summary",
              CANDIDATES, SAMPLES, BATCH_DEDUP, SUMMARY, recursive=True))
def dedup_summary(spark, sf_dir):
    applying, kept = kept_samples(spark, sf_dir)
    return clean.dedup_summary(applying, kept).select(*clean.LINE, "row_count", "kept_count", "action")


@query(oracle(f"SELECT {KEY}, text AS line FROM repacked",
              CANDIDATES, SAMPLES, BATCH_DEDUP, SUMMARY, REPACKED, recursive=True))
def repack_metric_batch(spark, sf_dir):
    applying, kept = kept_samples(spark, sf_dir)
    return clean.repack_metric_batch(clean.dedup_summary(applying, kept)).select(*clean.LINE, "line")


# -- packing -------------------------------------------------------------------------

PACK_LINES, PACK_BYTES = 5, 90
PACK = f"""prepared AS (SELECT *, row_number() OVER (PARTITION BY folder, session_id, channel, window_sequence
  ORDER BY line_no) AS rn, strlen(line) + 1 AS size FROM offsets WHERE {VALID}),
pack AS (
  SELECT folder, session_id, channel, window_sequence, rn, CAST(0 AS BIGINT) AS batch_id, 1 AS n, size AS b FROM prepared WHERE rn = 1
  UNION ALL
  SELECT p.folder, p.session_id, p.channel, p.window_sequence, p.rn,
         f.batch_id + CASE WHEN f.n >= {PACK_LINES} OR f.b >= {PACK_BYTES} THEN 1 ELSE 0 END,
         CASE WHEN f.n >= {PACK_LINES} OR f.b >= {PACK_BYTES} THEN 1 ELSE f.n + 1 END,
         CASE WHEN f.n >= {PACK_LINES} OR f.b >= {PACK_BYTES} THEN p.size ELSE f.b + p.size END
  FROM pack f JOIN prepared p ON p.folder = f.folder AND p.session_id = f.session_id AND p.channel = f.channel
    AND p.window_sequence = f.window_sequence AND p.rn = f.rn + 1),
packed AS (SELECT p.*, k.batch_id FROM prepared p JOIN pack k USING (folder, session_id, channel, window_sequence, rn))"""


def packed(spark, sf_dir):
    lines = clean.clean_lines(sequence.line_offsets(fixture(spark, sf_dir, "lines")))
    stored = materialize(lines.withColumn("size", packing.line_size()), "lines")
    return packing.pack_batches(stored, PACK_LINES, PACK_BYTES)


@query(oracle(f"SELECT {KEY}, batch_id FROM packed", OFFSETS, PACK, recursive=True))
def pack_batches(spark, sf_dir):
    return packed(spark, sf_dir).select(*clean.LINE, "batch_id")


@query(oracle("""SELECT folder, session_id, channel, window_sequence, batch_id, COUNT(*) AS line_count,
  CAST(SUM(size) AS BIGINT) AS bytes, MIN(byte_start) AS start_offset, MAX(byte_end) AS end_offset
  FROM packed GROUP BY ALL""", OFFSETS, PACK, recursive=True))
def batch_summary(spark, sf_dir):
    return packing.batch_summary(packed(spark, sf_dir))


@query(oracle("""SELECT folder, session_id, channel, window_sequence, batch_id, COUNT(*) AS line_count,
  concat(string_agg(line, chr(10) ORDER BY line_no), chr(10)) AS body,
  'https://collector.example/api/v1/events/stream' AS url
  FROM packed GROUP BY ALL""", OFFSETS, PACK, recursive=True))
def outbox_lines(spark, sf_dir):
    from logharbor.operators.delivery import outbox_lines as outbox

    return outbox(packing.batch_bodies(packed(spark, sf_dir)), URL)


# -- the whole line path -------------------------------------------------------------

SENT = f"""sent AS (
  SELECT {KEY}, line FROM batch_lines b WHERE NOT EXISTS (SELECT 1 FROM applying a WHERE a.line_no = b.line_no)
  UNION ALL SELECT {KEY}, text AS line FROM repacked)"""


@query(oracle(f"""SELECT {KEY}, 'gpu-trace' AS topic, channel AS key, CAST(to_json(line) AS VARCHAR) AS value FROM sent""",
              CANDIDATES, SAMPLES, BATCH_DEDUP, SUMMARY, REPACKED, SENT, recursive=True))
def line_path_records(spark, sf_dir):
    events = line_events(fixture(spark, sf_dir, "batch_lines"), time_col="sent_ms")
    return events.select(*clean.LINE, *fl.kafka_record(F.col("line"), F.col("channel")))


@query(oracle("""SELECT folder, session_id, channel, window_sequence, batch_id, COUNT(*) AS line_count,
  concat(string_agg(line, chr(10) ORDER BY line_no), chr(10)) AS body,
  'https://collector.example/api/v1/events/stream' AS url FROM packed GROUP BY ALL""",
              CANDIDATES, SAMPLES, BATCH_DEDUP, SUMMARY, REPACKED, SENT,
              PACK.replace("FROM offsets WHERE " + VALID, "FROM sent"), recursive=True))
def line_path(spark, sf_dir):
    return line_requests(fixture(spark, sf_dir, "batch_lines"), URL, "sent_ms", PACK_LINES, PACK_BYTES)
