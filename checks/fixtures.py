"""Landing-zone tables derived from the ``events`` table.

Each statement runs unchanged in Spark SQL and in the checking database, and reads the
statements before it by name.
"""

from __future__ import annotations

import os
import re
import zlib

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from logharbor import prepare
from logharbor.schemas import WINDOW
from logharbor.session import shared_dir
from logharbor.sources.files import hash_payloads, locate, write_new_files

METRICS = '"device_id","gpu_util","mem_util","temp_c","power_mw","used_mib","clock_sm"'

FIXTURES = {
    "metric_rows": """
SELECT concat('s', user_id % 3) AS session_id, user_id % 8 AS device_id, event_id AS row_no,
       event_id * 1000 AS ts_ms, CAST(FLOOR(value / 250) AS BIGINT) AS gpu_util, CAST(1 AS BIGINT) AS mem_util,
       40 + event_id % 3 AS temp_c, 1000 + (event_id % 5) * 30 AS power_mw,
       CAST(512 AS BIGINT) AS used_mib, 1400 + CAST(FLOOR(event_id / 5000) AS BIGINT) AS clock_sm
FROM events""",
    "lines": """
SELECT 'f0' AS folder, concat('s', user_id % 20) AS session_id,
       CASE event_type WHEN 'click' THEN 'device' WHEN 'view' THEN 'scope'
                       WHEN 'purchase' THEN 'system' ELSE 'sass' END AS channel,
       1 + CAST(FLOOR(event_id / 1000) AS BIGINT) AS window_sequence, event_id AS line_no,
       CASE WHEN event_id % 11 = 0 THEN '   '
            WHEN event_id % 11 = 1 THEN concat('{bad', event_id)
            WHEN event_id % 11 = 2 THEN concat('{"n":', event_id, '}')
            WHEN event_id % 11 = 3 THEN concat('{"type":"', event_type, '","n":', event_id, '} tail')
            WHEN event_id % 11 = 4 THEN concat('[', event_id, ']')
            WHEN event_id % 11 = 5 THEN concat('{"type":{"of":"', event_type, '"},"n":"é', event_id, '"}')
            ELSE concat('{"type":"', event_type, '","n":', event_id, '}') END AS line
FROM events""",
    "batch_lines": f"""
SELECT 'f0' AS folder, concat('s', user_id % 3) AS session_id,
       CASE WHEN event_id % 17 = 4 THEN 'device' ELSE 'system' END AS channel,
       1 + CAST(FLOOR(event_id / 1000) AS BIGINT) AS window_sequence, event_id AS line_no,
       event_id * 1000 AS sent_ms,
       CASE WHEN event_id % 17 = 0 THEN concat('{{"type":"device_metric_batch","columns":["device_id","temp_c"],"rows":[[', user_id % 8, ',40]]}}')
            WHEN event_id % 17 = 1 THEN '{{"type":"device_metric_batch","columns":["device_id","gpu_util"],"rows":[]}}'
            WHEN event_id % 17 = 2 THEN concat('{{"type":"scope_event","n":', event_id, '}}')
            WHEN event_id % 17 = 3 THEN concat('{{"type":"device_metric_batch","columns":[{METRICS}],"rows":[[', user_id % 8, ',1]]}}')
            WHEN event_id % 17 = 5 THEN concat('{{"type":"device_metric_batch","columns":["gpu_util","device_id"],"rows":[[1,', user_id % 8, '],[2]]}}')
            ELSE concat('{{"type":"device_metric_batch","host":"n', user_id % 3, '","columns":[{METRICS}],"rows":[[',
                        user_id % 8, ',', CAST(FLOOR(value / 250) AS BIGINT), ',1,', 40 + event_id % 3, ',', 1000 + (event_id % 5) * 30, ',512,1400],[',
                        (user_id + 1) % 8, ',', event_id % 2, ',1,', 40 + event_id % 2, ',1000,512,1400]],"n":', event_id, '}}') END AS line
FROM events""",
    "windows": """
SELECT folder, session_id, channel, window_sequence, MIN(line_no) AS k,
       concat(channel, '.', window_sequence, CASE WHEN MIN(line_no) % 10 = 0 THEN '.log' ELSE '.log.gz' END) AS file_name,
       MIN(line_no) % 10 <> 0 AS is_gz, CAST(SUM(length(line) + 1) AS BIGINT) AS length
FROM lines GROUP BY folder, session_id, channel, window_sequence HAVING MIN(line_no) % 7 <> 0""",
    "sidecars": """
SELECT folder, session_id, channel, window_sequence, 1 AS schema_version,
       CASE WHEN k % 31 = 0 THEN 'other' ELSE 'transport_window' END AS type,
       concat('w', k) AS window_id,
       CASE WHEN k % 9 = 0 THEN 'other' ELSE session_id END AS meta_session_id,
       CASE WHEN k % 29 = 0 THEN 'other' ELSE channel END AS meta_channel,
       window_sequence AS meta_window_sequence,
       file_name AS payload_file, length + CASE WHEN k % 8 = 0 THEN 1 ELSE 0 END AS payload_bytes,
       k AS payload_crc32, k % 23 = 0 AS malformed
FROM windows WHERE k % 5 <> 0""",
    "acks": """
SELECT folder, session_id, channel, window_sequence,
       CASE WHEN window_sequence % 4 = 1 THEN 'different' ELSE window_id END AS window_id
FROM sidecars WHERE payload_bytes % 3 <> 0""",
    "losses": """
SELECT folder, session_id, channel, window_sequence, 'agent' AS source, concat('reason "', k, '"') AS reason
FROM windows WHERE k % 37 = 0 OR (window_sequence = 2 AND k % 12 = 4)""",
    "cursors": """
SELECT folder, session_id, channel, 1 + MIN(k) % 3 AS file_index,
       CASE WHEN MIN(k) % 2 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(40 AS BIGINT) END AS read_offset
FROM windows GROUP BY folder, session_id, channel HAVING MIN(k) % 5 <> 0""",
    "responses": """
SELECT event_id AS request_id,
       CASE WHEN event_id % 2 = 0 THEN concat('w', event_id) END AS window_id,
       CASE event_id % 7 WHEN 0 THEN 200 WHEN 1 THEN 202 WHEN 2 THEN 402 WHEN 3 THEN 404
                         WHEN 4 THEN 409 WHEN 5 THEN 500 ELSE 302 END AS status,
       CASE event_id % 3 WHEN 0 THEN '{"window_acknowledged":true}'
                         WHEN 1 THEN '{"code":"window_identity_conflict"}' ELSE '' END AS body,
       CAST(1 + event_id % 3 AS INT) AS attempt
FROM events""",
    "sessions": """
SELECT folder, session_id, COUNT(DISTINCT channel) AS channels, MIN(k) % 4 = 0 AS tmp_present,
       CASE MIN(k) % 4 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'UNOWNED' WHEN 2 THEN 'LEGACY_NO_LOCK' ELSE 'UNKNOWN' END AS owner_state,
       MIN(k) * 1000 AS tmp_mtime_ms, MAX(k) * 1000 AS mtime_ms, MIN(k) % 5 <> 0 AS readable
FROM windows GROUP BY folder, session_id""",
    "channel_rows": """
SELECT folder, session_id, channel, MIN(k) % 13 = 0 AS has_failure, MIN(k) % 5 = 0 AS next_present,
       MIN(k) % 2 = 0 AS tmp_present, MIN(k) * 1000 AS tmp_mtime_ms, MIN(k) * 900 AS quiet_since_ms,
       CASE MIN(k) % 6 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'UNOWNED' WHEN 2 THEN 'LEGACY_NO_LOCK'
                       WHEN 3 THEN 'UNKNOWN' ELSE 'UNOWNED' END AS owner_state
FROM windows GROUP BY folder, session_id, channel""",
    "results": """
SELECT folder, session_id, channel, window_sequence, k % 6 <> 0 AS accepted, k % 4 = 1 AS identity_acknowledged,
       concat('w', k) AS window_id, CASE WHEN k % 6 = 0 THEN k % 50 END AS retry_offset
FROM windows""",
}

NOW_MS = 60_000
HOST, IP, URL = "host1", "10.0.0.1", "https://collector.example/"
PRODUCER = "acme"


PLANS: dict[tuple[str, str, str], DataFrame] = {}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table over the whole ``events`` table."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in PLANS:
        PLANS[key] = derive(prepare(spark), sf_dir, name)
    return PLANS[key]


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "events":
        events = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
        # A file of one row group is one task, which would leave the other cores idle. Large
        # inputs come in many splits and are left as they are.
        cores = spark.sparkContext.defaultParallelism
        return events if events.rdd.getNumPartitions() >= cores else events.repartition(cores)
    text = FIXTURES[name]
    source = text.rsplit("FROM ", 1)[1].split()[0]
    # A view per input: the statement is the same text that the checking database runs.
    view = f"{source}_{zlib.crc32(sf_dir.encode())}"
    fixture(spark, sf_dir, source).createOrReplaceTempView(view)
    rows = spark.sql(text.replace(f"FROM {source}", f"FROM {view}"))
    if name != "windows":
        return rows
    # Most others derive from this aggregate, so it is computed once and kept as a table.
    path = stored(spark, sf_dir, "windows")
    if not exists(f"{path}/_SUCCESS"):
        rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def stored(spark: SparkSession, sf_dir: str, label: str) -> str:
    """A place for data derived once per application."""
    owner = f"{spark.sparkContext.applicationId}-{zlib.crc32(sf_dir.encode())}"
    return re.sub("^file:/+", "/", f"{shared_dir(spark)}/logharbor/{label}-{owner}")


def exists(path: str) -> bool:
    system, inner = locate(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def oracle(select: str, *tables: str, recursive: bool = False) -> str:
    """A statement over the fixtures; ``tables`` are further common table expressions."""
    parts = [f"{name} AS ({text.strip()})" for name, text in FIXTURES.items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join([*parts, *tables]) + "\n" + select.strip()


# -- landing-zone tree -----------------------------------------------------------------

# Every fourth session lies one directory deeper.
REL_DIR = """CASE WHEN CAST(substr(session_id, 2, 9) AS INT) % 4 = 0
     THEN concat('g', CAST(substr(session_id, 2, 9) AS INT) % 8, '/', session_id) ELSE session_id END"""


def window_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content of each log window; every fourth lacks the final newline."""
    windows = fixture(spark, sf_dir, "windows")
    lines = fixture(spark, sf_dir, "lines")
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    text = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    return (
        lines.groupBy(*WINDOW).agg(text.alias("text")).join(windows, WINDOW)
        .withColumn("text", F.concat("text", F.when(F.col("k") % 4 == 0, "").otherwise("\n")))
    )


def landing_tree(spark: SparkSession, sf_dir: str) -> str:
    """Write the fixtures as a landing zone, once per application, and return its root."""
    prepare(spark)
    local = stored(spark, sf_dir, "tree")
    done = f"{local}/complete"
    if exists(done):
        return f"{local}/zone"
    place = F.concat(F.lit(f"{local}/zone/"), F.expr(REL_DIR), F.lit("/"))
    number = F.concat_ws(".", "channel", "window_sequence")

    def placed(df: DataFrame, name, content, is_gz=F.lit(False), place=place) -> DataFrame:
        return df.select(
            F.concat(place, name).alias("path"), content.cast("binary").alias("content"), is_gz.alias("is_gz")
        )

    def write(df: DataFrame) -> None:
        write_new_files(df).write.format("noop").mode("overwrite").save()

    texts = window_texts(spark, sf_dir).persist()
    sessions = fixture(spark, sf_dir, "sessions")
    loss = F.to_json(F.struct(F.lit(1).alias("schema_version"), "source", "channel", "window_sequence", "reason"))
    old = fixture(spark, sf_dir, "windows").select("channel", "session_id").distinct()
    flat = F.concat(F.lit(f"{local}/flat/"), "channel", F.lit("/"))
    write(
        placed(texts, F.col("file_name"), F.col("text"), F.col("is_gz"))
        .union(placed(fixture(spark, sf_dir, "acks"), F.concat(F.lit(f".{PRODUCER}-window-ack."), number),
                      F.concat("window_id", F.lit("\n"))))
        .union(placed(fixture(spark, sf_dir, "losses"),
                      F.concat(F.lit(f".{PRODUCER}-transport-loss.agent-"), number, F.lit(".json")), loss))
        .union(placed(sessions.where("owner_state = 'UNOWNED'"), F.lit(".uploaded"), F.lit("")))
        .union(placed(sessions.where("tmp_present"), F.lit(".tmp/device.log"), F.lit("live")))
        .union(placed(sessions, F.lit(f".{PRODUCER}-session.lock"), F.lit("")))
        .union(placed(old, F.concat_ws(".", "session_id", "channel", F.lit("log")), F.lit("{}"), place=flat))
    )
    # Sidecars state the stored bytes, with a wrong length where the fixture has one.
    written = texts.select(*WINDOW, "k", "is_gz", F.concat(place, "file_name").alias("path"))
    sums = hash_payloads(written).select(*WINDOW, "k", F.col("length").alias("bytes"), "crc32")
    sidecars = fixture(spark, sf_dir, "sidecars").join(sums, WINDOW)
    record = F.to_json(F.struct(
        "schema_version", "type", "window_id", F.col("meta_session_id").alias("session_id"),
        F.col("meta_channel").alias("channel"), F.col("meta_window_sequence").alias("window_sequence"),
        F.lit(1).alias("opened_mono_ms"), F.lit(2).alias("closed_mono_ms"), F.lit("x").alias("extra"),
        "payload_file", (F.col("bytes") + F.when(F.col("k") % 8 == 0, 1).otherwise(0)).alias("payload_bytes"),
        F.col("crc32").alias("payload_crc32"),
    ))
    write(placed(sidecars, F.concat(F.lit(f".{PRODUCER}-window."), number, F.lit(".json")),
                 F.when(F.col("malformed"), "{oops").otherwise(record)))
    texts.unpersist()
    write(spark.range(1).select(F.lit(done).alias("path"), F.lit(b"").alias("content")))
    return f"{local}/zone"
