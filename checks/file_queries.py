"""Sources that read the landing zone, on a tree that Spark writes from the tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from checks.fixtures import PRODUCER, REL_DIR, URL, fixture, landing_tree, oracle, window_texts
from checks.registry import query
from logharbor.functions import checks as fc
from logharbor.functions.paths import archive_keys
from logharbor.operators import integrity, sessions
from logharbor.plans.line_round import line_round, round_requests
from logharbor.plans.zone_settlement import settlement_poll
from logharbor.schemas import SESSION, WINDOW
from logharbor.session import materialize, scratch_path
from logharbor.sources import files, landing
from logharbor.streaming.rounds import dedup_rounds, window_rounds
from logharbor.streaming.stateful import dedup_with_state
from logharbor.streaming.windows import stream_windows as windows_stream, stream_lines
from logharbor.streaming.zone import stream_landing_zone as zone_stream, stream_listed_windows as listed_windows

W = "folder, session_id, channel, window_sequence"
# The session's parent directory, relative to the tree.
PARENT = REL_DIR.replace("'/', session_id) ELSE session_id END", "'') ELSE '' END")
TREE = f"tree AS (SELECT *, {REL_DIR} AS rel_dir, {PARENT} AS parent FROM windows)"
TREE_W = "parent AS folder, session_id, channel, window_sequence"


def entries(spark, sf_dir):
    return landing.scan_landing_zone(spark, [landing_tree(spark, sf_dir)], landing.CONTROL_FILES)


def relative(df, spark, sf_dir):
    """Directories below the tree instead of absolute ones."""
    root = landing_tree(spark, sf_dir)
    return df.withColumn("folder", F.regexp_replace("folder", f"^{root}/?", ""))


def tree_windows(spark, sf_dir):
    return landing.list_windows(entries(spark, sf_dir))


LISTING = oracle(f"""SELECT rel_dir, file_name AS name, false AS is_dir FROM tree
  UNION ALL SELECT rel_dir, concat('.{PRODUCER}-window.', channel, '.', window_sequence, '.json'), false FROM tree JOIN (SELECT {W} FROM sidecars) USING ({W})
  UNION ALL SELECT rel_dir, concat('.{PRODUCER}-window-ack.', channel, '.', window_sequence), false FROM tree JOIN (SELECT {W} FROM acks) USING ({W})
  UNION ALL SELECT rel_dir, concat('.{PRODUCER}-transport-loss.agent-', channel, '.', window_sequence, '.json'), false FROM tree JOIN (SELECT {W} FROM losses) USING ({W})
  UNION ALL SELECT {REL_DIR}, '.uploaded', false FROM sessions WHERE owner_state = 'UNOWNED'
  UNION ALL SELECT {REL_DIR}, '.{PRODUCER}-session.lock', false FROM sessions
  UNION ALL SELECT {REL_DIR}, '.tmp', true FROM sessions WHERE tmp_present
  UNION ALL SELECT concat({REL_DIR}, '/.tmp'), 'device.log', false FROM sessions WHERE tmp_present
  UNION ALL SELECT DISTINCT parent, session_id, true FROM tree
  UNION ALL SELECT DISTINCT '', parent, true FROM tree WHERE parent <> ''""", TREE)


@query(LISTING)
def scan_landing_zone(spark, sf_dir):
    return entries(spark, sf_dir).select("rel_dir", "name", "is_dir")


LISTED = f"SELECT {TREE_W}, file_name, is_gz FROM tree"


@query(oracle(LISTED, TREE))
def list_windows(spark, sf_dir):
    return relative(tree_windows(spark, sf_dir), spark, sf_dir).select(*WINDOW, "file_name", "is_gz")


@query(oracle(LISTED, TREE))
def scan_windows(spark, sf_dir):
    found = landing.scan_windows(spark, [landing_tree(spark, sf_dir)])
    return relative(found, spark, sf_dir).select(*WINDOW, "file_name", "is_gz")


TEXTS = f"""texts AS (SELECT {TREE_W}, row_number() OVER w AS line_no, strlen(line) + 1
    - CASE WHEN k % 4 = 0 AND row_number() OVER w = COUNT(*) OVER (PARTITION BY {W}) THEN 1 ELSE 0 END AS size, line
  FROM tree JOIN (SELECT {W}, line_no, line FROM lines) USING ({W}) WINDOW w AS (PARTITION BY {W} ORDER BY line_no))"""


@query(oracle("""SELECT folder, session_id, channel, window_sequence, line_no, line,
  CAST(SUM(size) OVER w - size AS BIGINT) AS byte_start, CAST(SUM(size) OVER w AS BIGINT) AS byte_end FROM texts
  WINDOW w AS (PARTITION BY folder, session_id, channel, window_sequence ORDER BY line_no)""", TREE, TEXTS))
def scan_lines(spark, sf_dir):
    lines = files.read_lines(tree_windows(spark, sf_dir).select(*WINDOW, "path", "is_gz"))
    return relative(lines, spark, sf_dir)


def checked_sums(spark, sf_dir):
    """Checksums read from the files beside those of the texts they were written from."""
    read = relative(files.hash_payloads(tree_windows(spark, sf_dir)), spark, sf_dir)
    written = window_texts(spark, sf_dir).withColumn("folder", F.expr(PARENT)).select(
        *WINDOW, fc.payload_checksum(F.col("text").cast("binary")).alias("text_crc"),
        fc.head_signature(F.col("text")).alias("text_head"), F.octet_length("text").alias("bytes"))
    return read.drop("mtime_ms").join(written, WINDOW)


@query(oracle(f"SELECT {TREE_W}, CASE WHEN NOT is_gz THEN true END AS same FROM tree", TREE))
def payload_checksum(spark, sf_dir):
    same = (F.col("crc32") == F.col("text_crc")) & (F.col("length") == F.col("bytes"))
    return checked_sums(spark, sf_dir).select(*WINDOW, F.when(~F.col("is_gz"), same).alias("same"))


@query(oracle(f"SELECT {TREE_W}, true AS same FROM tree", TREE))
def head_signature(spark, sf_dir):
    return checked_sums(spark, sf_dir).select(*WINDOW, (F.col("head_sig") == F.col("text_head")).alias("same"))


@query(oracle(f"""SELECT {TREE_W}, malformed, CASE WHEN malformed THEN 0 ELSE schema_version END AS schema_version,
  CASE WHEN NOT malformed THEN type END AS type, CASE WHEN NOT malformed THEN window_id END AS window_id,
  CASE WHEN NOT malformed THEN meta_session_id END AS meta_session_id, CASE WHEN NOT malformed THEN meta_channel END AS meta_channel,
  CASE WHEN malformed THEN 0 ELSE meta_window_sequence END AS meta_window_sequence,
  CASE WHEN malformed THEN 0 ELSE 2 END AS closed_mono_ms, CAST(0 AS BIGINT) AS created_wall_ms,
  CASE WHEN malformed THEN NULL ELSE payload_file END AS payload_file
  FROM tree JOIN (SELECT * FROM sidecars) USING ({W})""", TREE))
def scan_sidecars(spark, sf_dir):
    found = relative(landing.scan_sidecars(entries(spark, sf_dir), PRODUCER), spark, sf_dir)
    return found.drop("opened_mono_ms", "payload_bytes", "payload_crc32")


@query(oracle(f"SELECT {TREE_W}, window_id FROM tree JOIN acks USING ({W})", TREE))
def scan_acks(spark, sf_dir):
    return relative(landing.scan_acks(entries(spark, sf_dir), PRODUCER), spark, sf_dir)


@query(oracle(f"SELECT {TREE_W}, source, reason FROM tree JOIN losses USING ({W})", TREE))
def scan_losses(spark, sf_dir):
    return relative(landing.scan_losses(entries(spark, sf_dir), PRODUCER), spark, sf_dir)


@query(oracle(f"SELECT {PARENT} AS folder, session_id, 'uploaded' AS outcome FROM sessions WHERE owner_state = 'UNOWNED'"))
def scan_settled(spark, sf_dir):
    return relative(landing.scan_settled(entries(spark, sf_dir)), spark, sf_dir)


@query(oracle("""SELECT session_id, channel, file_index, read_offset, CAST(0 AS BIGINT) AS file_size, file_index * 7 AS head_sig
  FROM cursors"""))
def scan_cursors(spark, sf_dir):
    """Cursor files of several agents, one per session, and an empty and a corrupt one."""
    position = F.struct(F.col("file_index").alias("fileIndex"), F.col("read_offset").alias("offset"),
                        (F.col("file_index") * 7).alias("headSig"))
    key = F.concat_ws(".", "session_id", "channel")
    texts = fixture(spark, sf_dir, "cursors").groupBy("session_id").agg(
        F.map_from_entries(F.collect_list(F.struct(key, position))).alias("streams")
    ).select(F.to_json(F.struct("streams")).alias("value"))
    broken = fixture(spark, sf_dir, "sessions").select(F.when(F.col("readable"), "").otherwise("{broken").alias("value"))
    return landing.parse_cursors(texts.union(broken))


@query(oracle(f"SELECT DISTINCT parent AS folder, session_id, owner_state = 'UNOWNED' AS settled "
              "FROM tree JOIN (SELECT session_id, owner_state FROM sessions) USING (session_id)", TREE))
def session_catalog(spark, sf_dir):
    found = sessions.session_catalog(entries(spark, sf_dir))
    return relative(found, spark, sf_dir).select(*SESSION, "settled")


@query(oracle(f"SELECT {REL_DIR} AS session_dir, true AS dated FROM sessions WHERE tmp_present"))
def tmp_newest_mtime(spark, sf_dir):
    return sessions.tmp_newest_mtime(entries(spark, sf_dir)).select(
        "session_dir", F.col("tmp_mtime_ms").isNotNull().alias("dated"))


@query(oracle("SELECT channel AS folder, concat(MIN(session_id), '.', channel, '.log') AS file_name FROM windows GROUP BY channel"))
def legacy_flat_files(spark, sf_dir):
    root = landing_tree(spark, sf_dir).removesuffix("/zone") + "/flat"
    found = landing.scan_landing_zone(spark, [f"{root}/{c}" for c in ("device", "scope", "system", "sass")])
    return sessions.legacy_flat_files(found).withColumn("folder", F.element_at(F.split("folder", "/"), -1))


@query(oracle(f"""SELECT {TREE_W}, concat(trim(concat(parent, ' ')), '|', session_id, '|raw-events/', file_name) AS archived, true AS whole FROM tree""", TREE))
def archive_windows(spark, sf_dir):
    destination = scratch_path(spark, "archive")
    listed = tree_windows(spark, sf_dir)
    copied = files.archive_windows(archive_keys(listed), destination).join(listed.select(*WINDOW, "length"), WINDOW)
    copied = relative(copied, spark, sf_dir)
    tail = F.regexp_extract("archive_path", r"/([^/]+)/(raw-events/[^/]+)$", 2)
    owner = F.regexp_extract("archive_path", r"/([^/]+)/(raw-events/[^/]+)$", 1)
    return copied.select(*WINDOW, F.concat_ws("|", "folder", owner, tail).alias("archived"),
                         (F.col("copied_bytes") == F.col("length")).alias("whole"))


# -- streams -------------------------------------------------------------------------


def finish(writer, spark, checkpoint=None):
    """Run a stream over all that is there, then stop."""
    query = writer.option("checkpointLocation", checkpoint or scratch_path(spark, "stream")).trigger(availableNow=True).start()
    query.awaitTermination()


@query(oracle(LISTED, TREE))
def stream_windows(spark, sf_dir):
    out = scratch_path(spark, "windows")
    found = windows_stream(spark, landing_tree(spark, sf_dir), max_files_per_trigger=2000, listing=scratch_path(spark, "listing"))
    finish(found.writeStream.format("parquet").option("path", out), spark)
    return relative(spark.read.parquet(out), spark, sf_dir).select(*WINDOW, "file_name", "is_gz")


@query(LISTING)
def stream_landing_zone(spark, sf_dir):
    """The tree watched over three polls of one query, restarted in between; every entry comes once."""
    out, checkpoint = scratch_path(spark, "entries"), scratch_path(spark, "stream")
    for _ in range(3):
        found = zone_stream(spark, [landing_tree(spark, sf_dir)], landing.CONTROL_FILES)
        finish(found.writeStream.format("parquet").option("path", out), spark, checkpoint)
    return spark.read.schema(landing.ENTRY).parquet(out).select("rel_dir", "name", "is_dir")


@query(oracle(LISTED, TREE))
def stream_listed_windows(spark, sf_dir):
    out, root = scratch_path(spark, "windows"), landing_tree(spark, sf_dir)
    found = listed_windows(zone_stream(spark, [root]), [root])
    finish(found.writeStream.format("parquet").option("path", out), spark)
    return relative(spark.read.parquet(out), spark, sf_dir).select(*WINDOW, "file_name", "is_gz")


@query(oracle("SELECT folder, session_id, channel, window_sequence, line_no, line FROM texts", TREE, TEXTS))
def stream_lines_of_windows(spark, sf_dir):
    out = scratch_path(spark, "lines")
    found = windows_stream(spark, landing_tree(spark, sf_dir), max_files_per_trigger=2000, listing=scratch_path(spark, "listing"))
    lines = stream_lines(found.select(*WINDOW, "path", "is_gz"))
    finish(lines.writeStream.format("parquet").option("path", out), spark)
    return relative(spark.read.parquet(out), spark, sf_dir).select(*WINDOW, "line_no", "line")


def sample_stream(spark, sf_dir):
    """The metric samples as a stream of two triggers that follow each other in time."""
    path = scratch_path(spark, "samples")
    rows = fixture(spark, sf_dir, "metric_rows")
    half = rows.agg(F.avg("ts_ms")).first()[0]
    for early in (True, False):
        part = rows.where((F.col("ts_ms") <= half) == F.lit(early))
        part.repartitionByRange(4, "ts_ms").write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(path)


def dedup_oracle():
    from checks.line_queries import SAMPLE_DEDUP

    return oracle("SELECT * EXCLUDE (rn) FROM kept", SAMPLE_DEDUP, recursive=True)


@query(dedup_oracle())
def metric_dedup_stream(spark, sf_dir):
    stream, out = sample_stream(spark, sf_dir), scratch_path(spark, "kept")
    finish(dedup_with_state(stream).writeStream.format("parquet").option("path", out), spark)
    return spark.read.schema(stream.schema).parquet(out)


@query(dedup_oracle())
def metric_dedup_rounds(spark, sf_dir):
    stream, base = sample_stream(spark, sf_dir), scratch_path(spark, "rounds")
    finish(dedup_rounds(stream, base, ["session_id", "device_id"], ["ts_ms", "row_no"]), spark)
    return spark.read.parquet(f"{base}/kept").drop("epoch").select(stream.columns)


TREE_DECIDED = f"""judged AS (SELECT t.*, CASE WHEN NOT is_gz THEN 'line_path' WHEN s.window_id IS NULL THEN
    CASE WHEN owner_state = 'LEGACY_NO_LOCK' THEN 'legacy_send' ELSE 'retry_wait' END
  WHEN malformed THEN 'permanent_malformed' WHEN type <> 'transport_window' OR meta_session_id <> t.session_id
    OR meta_channel <> t.channel THEN 'permanent_mismatch' WHEN k % 8 = 0 THEN 'permanent_checksum' ELSE 'verified_send' END AS decision
  FROM tree t LEFT JOIN sidecars s USING ({W}) LEFT JOIN (SELECT session_id, owner_state FROM sessions) USING (session_id))"""


def placed_owners(spark, sf_dir):
    """The owner states that a probe would give."""
    owners = fixture(spark, sf_dir, "sessions").select(F.expr(PARENT).alias("folder"), "session_id", "owner_state")
    root = landing_tree(spark, sf_dir)
    return owners.withColumn("folder", F.regexp_replace(F.concat_ws("/", F.lit(root), "folder"), "/$", ""))


@query(oracle(f"SELECT {TREE_W}, decision FROM judged", TREE, TREE_DECIDED))
def window_decision_files(spark, sf_dir):
    sidecars = landing.scan_sidecars(entries(spark, sf_dir), PRODUCER)
    decided = integrity.window_decision(files.hash_payloads(tree_windows(spark, sf_dir)), sidecars, placed_owners(spark, sf_dir))
    return relative(decided, spark, sf_dir).select(*WINDOW, "decision")


@query(oracle("""SELECT parent AS folder, session_id, channel,
  CAST(COALESCE(MIN(window_sequence) FILTER (NOT accepted), MAX(window_sequence) + 1) AS BIGINT) AS file_index FROM (
    SELECT *, decision IN ('verified_send', 'legacy_send', 'line_path') AND window_sequence <> 7 AS accepted,
      window_sequence - row_number() OVER (PARTITION BY parent, session_id, channel ORDER BY window_sequence) AS island FROM judged)
  WHERE island = 0 GROUP BY ALL""", TREE, TREE_DECIDED))
def window_delivery_rounds(spark, sf_dir):
    """The windows of the tree delivered over several triggers; number 7 is refused."""
    base = scratch_path(spark, "rounds")
    found = windows_stream(spark, landing_tree(spark, sf_dir), max_files_per_trigger=5000, listing=scratch_path(spark, "listing"))
    answer = {"status": F.when(F.col("window_sequence") == 7, 503).otherwise(200),
              "body": F.lit('{"window_acknowledged":true}')}
    writer = window_rounds(
        files.hash_payloads(found), base, lambda s: (partial(landing.sidecars_of, producer=PRODUCER), placed_owners(s, sf_dir)),
        lambda requests: requests.withColumns(answer), PRODUCER)
    finish(writer, spark)
    last = spark.read.parquet(f"{base}/cursors").where(F.col("epoch") == spark.read.parquet(
        f"{base}/cursors").agg(F.max("epoch")).first()[0])
    return relative(last, spark, sf_dir).select(*SESSION, "channel", "file_index")


# -- line path -----------------------------------------------------------------------

ROUND_LINES = 3
VALID = r"NOT regexp_full_match(line, '\s*') AND json_valid(line)"
PLACED = f"""placed AS (SELECT *, CAST(SUM(size) OVER w - size AS BIGINT) AS byte_start, CAST(SUM(size) OVER w AS BIGINT) AS byte_end
  FROM texts WINDOW w AS (PARTITION BY {W} ORDER BY line_no))"""
AT_START = f"cursors0 AS (SELECT {PARENT} AS folder, session_id, channel, CAST(file_index AS BIGINT) AS file_index, read_offset FROM cursors)"
S = "folder, session_id, channel"


def round_tables(n: int) -> list[str]:
    """Ready windows, requests, unaccepted places and cursors of round ``n``."""
    return [
        f"""start{n} AS (SELECT t.*, greatest(1, COALESCE(file_index, 0)) AS start_index, CASE WHEN file_index >= 1 THEN read_offset ELSE 0 END AS start_offset
  FROM (SELECT {TREE_W}, k FROM tree) t LEFT JOIN cursors{n - 1} USING ({S}))""",
        f"""ready{n} AS (SELECT * FROM (SELECT *, window_sequence - row_number() OVER (PARTITION BY {S} ORDER BY window_sequence) AS island
  FROM start{n} WHERE window_sequence >= start_index) WHERE island = start_index - 1)""",
        f"""requests{n} AS (SELECT {W}, k, batch_id, COUNT(*) AS line_count, MIN(byte_start) AS start_offset, MAX(byte_end) AS end_offset,
    concat(string_agg(line, chr(10) ORDER BY line_no), chr(10)) AS body
  FROM (SELECT p.*, k, (row_number() OVER (PARTITION BY {W} ORDER BY line_no) - 1) // {ROUND_LINES} AS batch_id
    FROM placed p JOIN ready{n} USING ({W}) WHERE {VALID} AND (window_sequence > start_index OR byte_start >= start_offset)) GROUP BY ALL)""",
        f"""refused{n} AS (SELECT {W}, MIN(start_offset) AS retry FROM requests{n} LEFT JOIN (SELECT request_id, status FROM responses)
    ON request_id = k + batch_id + {10 * n}
  WHERE NOT COALESCE(status BETWEEN 200 AND 299 OR status IN (402, 409), false) GROUP BY ALL)""",
        f"""moved{n} AS (SELECT {S}, CAST(COALESCE(MIN(window_sequence) FILTER (retry IS NOT NULL), MAX(window_sequence) + 1) AS BIGINT) AS file_index,
    COALESCE(arg_min(retry, window_sequence) FILTER (retry IS NOT NULL), 0) AS read_offset
  FROM ready{n} LEFT JOIN refused{n} USING ({W}) GROUP BY ALL)""",
        f"""cursors{n} AS (SELECT {S}, file_index, read_offset FROM moved{n}
  UNION ALL SELECT {S}, file_index, read_offset FROM cursors{n - 1} ANTI JOIN moved{n} USING ({S}))""",
    ]


def in_tree(df, spark, sf_dir):
    """The fixture's rows with the directories that its sessions have in the tree."""
    root = landing_tree(spark, sf_dir)
    return df.withColumn("folder", F.regexp_replace(F.concat_ws("/", F.lit(root), F.expr(PARENT)), "/$", ""))


def answers(spark, sf_dir, number):
    """Responses to a round's requests, as the responses table has them."""
    keys = in_tree(fixture(spark, sf_dir, "windows").select(*WINDOW, "k"), spark, sf_dir)
    known = fixture(spark, sf_dir, "responses").select("request_id", "status")

    def send(requests):
        asked = requests.select(*WINDOW, "batch_id").join(keys, WINDOW).withColumn("request_id", F.col("k") + F.col("batch_id") + 10 * number)
        return asked.join(known, "request_id").select(*WINDOW, "batch_id", "status", F.lit("").alias("body"))

    return send


@query(oracle(f"SELECT {W}, batch_id, line_count, start_offset, end_offset, body FROM requests1", TREE, TEXTS, PLACED, AT_START, *round_tables(1)))
def line_path_files(spark, sf_dir):
    """The first round's requests, read from the files of the tree."""
    cursors = in_tree(fixture(spark, sf_dir, "cursors"), spark, sf_dir)
    found = round_requests(tree_windows(spark, sf_dir), cursors, URL, max_lines=ROUND_LINES)
    return relative(found["requests"], spark, sf_dir).select(
        *WINDOW, "batch_id", "line_count", "start_offset", "end_offset", "body")


@query(oracle(f"SELECT {S}, file_index, read_offset FROM cursors2", TREE, TEXTS, PLACED, AT_START, *round_tables(1), *round_tables(2)))
def line_path_rounds(spark, sf_dir):
    """Cursors after two rounds; a refused window resumes at the request that was refused."""
    cursors = in_tree(fixture(spark, sf_dir, "cursors"), spark, sf_dir)
    for number in (1, 2):
        found = line_round(tree_windows(spark, sf_dir), cursors, answers(spark, sf_dir, number), URL, max_lines=ROUND_LINES)
        cursors = materialize(found["cursors"], "cursors")
    return relative(cursors, spark, sf_dir)


# Long after the tree was written, so what is left of a working directory is stale.
POLLED_MS = 1 << 45
OWNED = """CASE WHEN owner_state = 'ACTIVE' AND CAST(substr(session_id, 2, 9) AS INT) % 2 = 0 THEN 'LEGACY_NO_LOCK' ELSE owner_state END"""
POLLS = f"""polls AS (SELECT parent, session_id, channel, tmp_present, {OWNED} AS owner_state,
    CASE WHEN channel = 'sass' OR last IS NULL THEN 1 ELSE last + 1 END AS window_sequence
  FROM (SELECT DISTINCT parent, folder, session_id FROM tree) JOIN (SELECT session_id, tmp_present, owner_state FROM sessions) USING (session_id)
  CROSS JOIN (SELECT unnest(['device', 'scope', 'system', 'sass']) AS channel)
  LEFT JOIN (SELECT session_id, channel, MAX(window_sequence) AS last FROM tree GROUP BY ALL) USING (session_id, channel))"""
AT = "(session_id, channel, window_sequence) IN (SELECT (session_id, channel, window_sequence) FROM"
POLLED = f"""polled AS (SELECT parent AS folder, session_id, channel, CASE WHEN {AT} losses) THEN 'finished_orphaned'
    WHEN {AT} tree) OR {AT} acks) THEN 'draining' WHEN owner_state IN ('ACTIVE', 'UNKNOWN') THEN 'waiting'
    WHEN tmp_present THEN 'finished_orphaned' ELSE 'finished_clean' END AS state FROM polls)"""


@query(oracle("""SELECT folder, session_id, channel, CASE state WHEN 'finished_clean' THEN 'waiting' ELSE state END AS first_state, state,
  CASE WHEN bool_and(starts_with(state, 'finished')) OVER s THEN CASE WHEN session_id IN (SELECT session_id FROM losses)
    OR bool_or(state = 'finished_orphaned') OVER s THEN 'failed' ELSE 'uploaded' END END AS outcome
  FROM polled WINDOW s AS (PARTITION BY folder, session_id)""", TREE, POLLS, POLLED))
def settlement_files(spark, sf_dir):
    root, listed = landing_tree(spark, sf_dir), materialize(entries(spark, sf_dir), "entries")
    catalog = sessions.session_catalog(listed)
    sent = landing.list_windows(listed).where("channel <> 'sass'").groupBy("folder", "session_id", "channel").agg(
        (F.max("window_sequence") + 1).alias("file_index"))
    parent = F.concat_ws("/", F.lit(root), F.nullif(F.expr(PARENT), F.lit("")))
    owners = fixture(spark, sf_dir, "sessions").select(parent.alias("folder"), "session_id", F.expr(OWNED).alias("owner_state"))
    first = materialize(settlement_poll(listed, catalog, sent, owners, PRODUCER, F.lit(POLLED_MS)), "states")
    second = materialize(settlement_poll(listed, catalog, sent, owners, PRODUCER, F.lit(POLLED_MS + 5_000), first), "states")
    outcomes = sessions.settle_sessions(sessions.session_completion(second, catalog), landing.scan_losses(listed, PRODUCER))
    both = second.join(first.select("folder", "session_id", "channel", F.col("state").alias("first_state")), ["folder", "session_id", "channel"])
    rows = both.join(outcomes.select(*SESSION, "outcome"), SESSION, "left")
    return relative(rows.select(*SESSION, "channel", "first_state", "state", "outcome"), spark, sf_dir)
