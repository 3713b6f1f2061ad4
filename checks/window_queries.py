"""Paths, sequences, integrity and ledgers of log windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import HOST, PRODUCER, URL, fixture, oracle
from checks.registry import query
from logharbor.functions import checks as fc, paths
from logharbor.operators import delivery, integrity, sequence
from logharbor.plans.window_path import window_round
from logharbor.schemas import WINDOW

W = "folder, session_id, channel, window_sequence"
S = "folder, session_id, channel"
PATHS = """named AS (SELECT concat('/zone/', folder, '/', session_id, '/', file_name) AS path FROM windows
  UNION ALL SELECT concat('/zone/', folder, '/', session_id, '/', channel, '.0', window_sequence, '.log') FROM windows
  UNION ALL SELECT concat('/zone/', folder, '/', session_id, '/', channel, '.log') FROM windows WHERE k % 3 = 0)"""


def window_paths(spark, sf_dir):
    windows = fixture(spark, sf_dir, "windows")
    base = F.concat(F.lit("/zone/"), "folder", F.lit("/"), "session_id", F.lit("/"))
    number = F.col("window_sequence").cast("string")
    named = windows.select(F.concat(base, "file_name").alias("path"))
    padded = windows.select(F.concat(base, "channel", F.lit(".0"), number, F.lit(".log")).alias("path"))
    bare = windows.where("k % 3 = 0").select(F.concat(base, "channel", F.lit(".log")).alias("path"))
    return named.union(padded).union(bare)


@query(oracle(r"""
SELECT path, '/zone/f0' AS folder, split_part(path, '/', 4) AS session_id,
       regexp_extract(path, '([a-z]+)\.([0-9]+)\.log', 1) AS channel,
       CAST(regexp_extract(path, '([a-z]+)\.([0-9]+)\.log', 2) AS BIGINT) AS window_sequence,
       ends_with(path, '.gz') AS is_gz
FROM named WHERE regexp_matches(path, '\.[1-9][0-9]*\.log')""", PATHS))
def parse_window_path(spark, sf_dir):
    return paths.parse_window_path(window_paths(spark, sf_dir))


@query(oracle(f"SELECT {W}, concat(session_id, '.', channel) AS stream_key FROM windows"))
def stream_key(spark, sf_dir):
    return fixture(spark, sf_dir, "windows").select(*WINDOW, paths.stream_key().alias("stream_key"))


@query(oracle(f"""SELECT DISTINCT channel, concat('https://collector.example/api/v1/events/', channel) AS v1,
  concat('https://collector.example/api/v2/events/', channel) AS v2 FROM windows"""))
def endpoint_url(spark, sf_dir):
    kind = F.col("channel")
    return fixture(spark, sf_dir, "windows").select(
        "channel", paths.endpoint_url(URL, kind).alias("v1"),
        paths.endpoint_url(URL.rstrip("/"), kind, "v2").alias("v2")).distinct()


@query(oracle(f"""SELECT concat('/zone/', session_id, '/', file_name) AS path, concat('raw-events/', file_name) AS archive_key,
  COUNT(*) OVER (PARTITION BY file_name) AS key_count FROM windows"""))
def archive_key(spark, sf_dir):
    files = fixture(spark, sf_dir, "windows").select(
        F.concat_ws("/", F.lit("/zone"), "session_id", "file_name").alias("path"))
    return paths.archive_keys(files)


@query(oracle("""SELECT l.* FROM lines l JOIN (SELECT DISTINCT folder, channel FROM windows WHERE channel <> 'sass') c
  USING (folder, channel)"""))
def configured_channels(spark, sf_dir):
    sources = fixture(spark, sf_dir, "windows").where("channel <> 'sass'").groupBy("folder").agg(
        F.collect_set("channel").alias("log_types"))
    return paths.configured_channels(fixture(spark, sf_dir, "lines"), sources)


# -- sequence ------------------------------------------------------------------------

BOTH = """both_forms AS (SELECT * FROM windows UNION ALL
  SELECT folder, session_id, channel, window_sequence, k, concat(file_name, '.gz'), true, length FROM windows WHERE NOT is_gz)"""


@query(oracle(f"""SELECT {W}, file_name, is_gz FROM both_forms QUALIFY
  row_number() OVER (PARTITION BY {W} ORDER BY is_gz) = 1""", BOTH))
def prefer_plain(spark, sf_dir):
    windows = fixture(spark, sf_dir, "windows")
    packed = windows.where("not is_gz").withColumns(
        {"file_name": F.concat("file_name", F.lit(".gz")), "is_gz": F.lit(True)})
    return sequence.prefer_plain(windows.unionByName(packed)).select(*WINDOW, "file_name", "is_gz")


START = """started AS (SELECT w.*, CAST(GREATEST(1, COALESCE(c.file_index, 0)) AS BIGINT) AS start_index,
  CAST(CASE WHEN COALESCE(c.file_index, 0) >= 1 THEN COALESCE(c.read_offset, 0) ELSE 0 END AS BIGINT) AS start_offset
  FROM windows w LEFT JOIN cursors c USING (folder, session_id, channel))"""


@query(oracle(f"SELECT {W}, start_index, start_offset FROM started", START))
def windows_with_cursors(spark, sf_dir):
    known = sequence.attach_cursors(fixture(spark, sf_dir, "windows"), fixture(spark, sf_dir, "cursors"))
    return known.select(*WINDOW, "start_index", "start_offset")


@query(oracle(f"SELECT {W}, file_name FROM started WHERE window_sequence >= start_index", START))
def resume_windows(spark, sf_dir):
    pending = sequence.resume_windows(fixture(spark, sf_dir, "windows"), fixture(spark, sf_dir, "cursors"))
    return pending.select(*WINDOW, "file_name")


ISLANDS = f"""islands AS (SELECT *, window_sequence - row_number() OVER (PARTITION BY {S} ORDER BY window_sequence) AS island
  FROM started WHERE window_sequence >= start_index)"""


@query(oracle(f"SELECT {W}, file_name FROM islands WHERE island = start_index - 1", START, ISLANDS))
def ready_prefix(spark, sf_dir):
    ready = sequence.ready_prefix(fixture(spark, sf_dir, "windows"), fixture(spark, sf_dir, "cursors"))
    return ready.select(*WINDOW, "file_name")


@query(oracle(f"""SELECT {S}, CAST(before + 1 AS BIGINT) AS gap_from, window_sequence - 1 AS gap_to FROM (
  SELECT *, COALESCE(LAG(window_sequence) OVER (PARTITION BY {S} ORDER BY window_sequence), start_index - 1) AS before
  FROM started WHERE window_sequence >= start_index) WHERE window_sequence - before > 1""", START))
def sequence_gaps(spark, sf_dir):
    return sequence.sequence_gaps(fixture(spark, sf_dir, "windows"), fixture(spark, sf_dir, "cursors"))


ACKED = f"""acked AS (SELECT s.* FROM sidecars s JOIN acks a USING ({W}, window_id)
  WHERE s.meta_channel = s.channel AND s.meta_window_sequence = s.window_sequence)"""
PRESENT = "present AS (SELECT * FROM windows WHERE k % 4 <> 0)"


def acked(spark, sf_dir):
    return integrity.acked_windows(fixture(spark, sf_dir, "sidecars"), fixture(spark, sf_dir, "acks"))


@query(oracle(f"""SELECT {W}, CASE WHEN p.k IS NOT NULL THEN 'present' ELSE 'done' END AS status
  FROM present p FULL JOIN (SELECT {W} FROM acked) a USING ({W})""", ACKED, PRESENT))
def tombstone_skip(spark, sf_dir):
    return sequence.tombstone_skip(fixture(spark, sf_dir, "windows").where("k % 4 <> 0"), acked(spark, sf_dir))


@query(oracle(f"""SELECT {W} FROM (
  SELECT s.*, s.window_sequence - row_number() OVER (PARTITION BY {S} ORDER BY s.window_sequence) AS island, start_index
  FROM (SELECT {W}, bool_or(here) AS here FROM (SELECT {W}, true AS here FROM present UNION ALL SELECT {W}, false FROM acked)
        GROUP BY ALL) s
  JOIN (SELECT {S}, GREATEST(1, COALESCE(MAX(file_index), 0)) AS start_index
        FROM (SELECT DISTINCT {S} FROM windows) LEFT JOIN cursors USING ({S}) GROUP BY ALL) c USING ({S})
  WHERE s.window_sequence >= start_index) WHERE island = start_index - 1 AND here""", ACKED, PRESENT))
def ready_prefix_after_cleanup(spark, sf_dir):
    ready = sequence.ready_prefix(
        fixture(spark, sf_dir, "windows").where("k % 4 <> 0"), fixture(spark, sf_dir, "cursors"), acked(spark, sf_dir))
    return ready.select(*WINDOW)


@query(oracle(f"""SELECT {S}, CAST(GREATEST(1, COALESCE(file_index, 0)) AS BIGINT) AS window_sequence
  FROM (SELECT DISTINCT {S} FROM windows UNION SELECT {S} FROM cursors) w LEFT JOIN cursors USING ({S})
  WHERE ({S}, GREATEST(1, COALESCE(file_index, 0))) IN (SELECT ({S}, window_sequence) FROM losses)"""))
def prior_failures(spark, sf_dir):
    return sequence.blocked_streams(
        fixture(spark, sf_dir, "windows"), fixture(spark, sf_dir, "cursors"), fixture(spark, sf_dir, "losses"))


@query(oracle("""SELECT DISTINCT folder, session_id FROM lines EXCEPT
  SELECT folder, session_id FROM windows WHERE k % 41 = 0"""))
def no_readable_window(spark, sf_dir):
    return sequence.unreadable_sessions(
        fixture(spark, sf_dir, "lines"), fixture(spark, sf_dir, "windows").where("k % 41 = 0"))


# -- integrity -----------------------------------------------------------------------

VALID = """COALESCE(s.schema_version = 1 AND s.type = 'transport_window' AND s.meta_session_id = w.session_id
  AND s.meta_channel = w.channel AND s.payload_file = w.file_name AND s.payload_bytes >= 0, false)"""
ATTACHED = f"""attached AS (SELECT w.*, s.window_id, s.window_id IS NOT NULL AS has_sidecar, COALESCE(s.malformed, false) AS malformed,
  {VALID} AS valid, CASE WHEN s.window_id IS NULL THEN true
    ELSE s.payload_bytes = w.length AND s.payload_crc32 = w.k - CASE WHEN w.k % 41 = 0 THEN 1 ELSE 0 END END AS same
  FROM windows w LEFT JOIN sidecars s USING ({W}))"""


def hashed(spark, sf_dir):
    crc = F.col("k") - F.when(F.col("k") % 41 == 0, 1).otherwise(0)
    return fixture(spark, sf_dir, "windows").withColumn("crc32", crc)


def attached(spark, sf_dir):
    return integrity.attach_sidecars(hashed(spark, sf_dir), fixture(spark, sf_dir, "sidecars"))


@query(oracle(f"SELECT {W}, file_name, window_id, has_sidecar, malformed FROM attached", ATTACHED))
def windows_with_sidecars(spark, sf_dir):
    return attached(spark, sf_dir).select(*WINDOW, "file_name", "window_id", "has_sidecar", "malformed")


@query(oracle(f"SELECT {W}, valid FROM attached", ATTACHED))
def sidecar_is_valid(spark, sf_dir):
    return attached(spark, sf_dir).select(*WINDOW, fc.sidecar_is_valid().alias("valid"))


@query(oracle(f"SELECT {W}, same FROM attached", ATTACHED))
def checksum_ok(spark, sf_dir):
    same = fc.checksum_ok(F.col("has_sidecar"), F.col("length"), F.col("crc32"))
    return attached(spark, sf_dir).select(*WINDOW, same.alias("same"))


@query(oracle(f"SELECT {W}, window_id FROM acked", ACKED))
def acked_windows(spark, sf_dir):
    return acked(spark, sf_dir).select(*WINDOW, "window_id")


REASON = """CASE WHEN NOT is_gz THEN 'not_compressed' WHEN NOT has_sidecar THEN 'no_sidecar'
  WHEN NOT valid THEN 'sidecar_mismatch' WHEN a.window_id IS NULL THEN 'not_acknowledged' ELSE 'acknowledged' END"""
MANIFEST = f"""manifest AS (SELECT {W}, file_name, {REASON} AS reason
  FROM attached LEFT JOIN (SELECT {W}, window_id FROM acked) a USING ({W}))"""


@query(oracle("SELECT *, reason = 'acknowledged' AS delete FROM manifest", ATTACHED, ACKED, MANIFEST))
def cleanup_manifest(spark, sf_dir):
    return integrity.cleanup_manifest(
        fixture(spark, sf_dir, "windows"), fixture(spark, sf_dir, "sidecars"), fixture(spark, sf_dir, "acks"))


@query(oracle(f"""SELECT {W}, file_name FROM started JOIN (SELECT {W} FROM acked) USING ({W})
  WHERE is_gz AND window_sequence < start_index""", START, ACKED))
def requeue_acked(spark, sf_dir):
    return integrity.requeue_acked(
        fixture(spark, sf_dir, "windows"), fixture(spark, sf_dir, "sidecars"),
        fixture(spark, sf_dir, "acks"), fixture(spark, sf_dir, "cursors"))


DECIDED = f"""decided AS (SELECT t.*, CASE WHEN l.source IS NOT NULL THEN 'prior_failure' WHEN NOT is_gz THEN 'line_path'
    WHEN NOT has_sidecar AND owner_state = 'LEGACY_NO_LOCK' THEN 'legacy_send' WHEN NOT has_sidecar THEN 'retry_wait'
    WHEN malformed THEN 'permanent_malformed' WHEN NOT valid THEN 'permanent_mismatch'
    WHEN NOT same THEN 'permanent_checksum' ELSE 'verified_send' END AS decision
  FROM attached t LEFT JOIN losses l USING ({W}) LEFT JOIN sessions USING (folder, session_id))"""
IDENTITY = "CASE WHEN decision = 'verified_send' THEN window_id END"
REASONS = """CASE decision WHEN 'permanent_malformed' THEN concat('window identity metadata is malformed for ', file_name)
  WHEN 'permanent_mismatch' THEN concat('window metadata does not match payload ', file_name)
  WHEN 'permanent_checksum' THEN concat('payload_checksum_mismatch:', file_name) END"""


def decisions(spark, sf_dir):
    return integrity.window_decision(
        hashed(spark, sf_dir), fixture(spark, sf_dir, "sidecars"), fixture(spark, sf_dir, "sessions"),
        fixture(spark, sf_dir, "losses"))


@query(oracle(f"SELECT {W}, file_name, {IDENTITY} AS window_id, decision, {REASONS} AS reason FROM decided", ATTACHED, DECIDED))
def window_decision(spark, sf_dir):
    return decisions(spark, sf_dir)


# -- responses and ledgers -----------------------------------------------------------

OUTCOME = """CASE WHEN status BETWEEN 200 AND 299 THEN CASE WHEN window_id IS NOT NULL
    AND body = '{"window_acknowledged":true}' THEN 'accepted_identity' ELSE 'accepted_legacy' END
  WHEN status = 409 AND window_id IS NOT NULL AND contains(body, 'window_identity_conflict') THEN 'retry'
  WHEN status IN (402, 409) THEN 'accepted_legacy' ELSE 'retry' END"""


@query(oracle(f"""SELECT request_id, {OUTCOME} AS outcome, ({OUTCOME}) <> 'retry' AS accepted,
  ({OUTCOME}) = 'accepted_identity' AS identity_acknowledged FROM responses"""))
def classify_stream_response(spark, sf_dir):
    return delivery.classify_stream_response(fixture(spark, sf_dir, "responses")).select(
        "request_id", "outcome", "accepted", "identity_acknowledged")


@query(oracle("""SELECT request_id, CASE WHEN status BETWEEN 200 AND 299 OR status = 402 THEN 'advance' ELSE 'retry' END AS outcome
  FROM responses"""))
def classify_event_response(spark, sf_dir):
    return delivery.classify_event_response(fixture(spark, sf_dir, "responses")).select("request_id", "outcome")


DONE = "status BETWEEN 200 AND 299 OR status BETWEEN 400 AND 499"


@query(oracle(f"""SELECT request_id, CASE WHEN {DONE} THEN 'done' WHEN attempt < 3 THEN 'retry' ELSE 'give_up' END AS outcome,
  CAST(CASE WHEN NOT ({DONE}) THEN CASE attempt WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 8 END END AS BIGINT) AS next_delay_s
  FROM responses"""))
def classify_complete_response(spark, sf_dir):
    return delivery.classify_complete_response(fixture(spark, sf_dir, "responses")).select(
        "request_id", "outcome", "next_delay_s")


ADVANCED = f"""moved AS (SELECT {S}, MIN(window_sequence) FILTER (NOT accepted) AS stop, MAX(window_sequence) + 1 AS after
  FROM results WHERE session_id <> 's3' GROUP BY ALL),
advanced AS (SELECT {S}, CAST(COALESCE(stop, after) AS BIGINT) AS file_index, CAST(COALESCE(retry_offset, 0) AS BIGINT) AS read_offset
  FROM moved LEFT JOIN (SELECT {S}, window_sequence AS stop, retry_offset FROM results) r USING ({S}, stop)
  UNION ALL SELECT * FROM cursors WHERE session_id = 's3')"""


@query(oracle("SELECT * FROM advanced", ADVANCED))
def advance_cursor(spark, sf_dir):
    results = fixture(spark, sf_dir, "results").where("session_id <> 's3'")
    return delivery.advance_cursor(results, fixture(spark, sf_dir, "cursors"))


@query(oracle(f"SELECT {W}, window_id FROM results r WHERE identity_acknowledged AND NOT EXISTS (SELECT 1 FROM acks a "
              "WHERE a.folder = r.folder AND a.session_id = r.session_id AND a.channel = r.channel "
              "AND a.window_sequence = r.window_sequence)"))
def record_acks(spark, sf_dir):
    results = fixture(spark, sf_dir, "results")
    return delivery.record_acks(results.union(results), fixture(spark, sf_dir, "acks"))


LOST = f"""lost AS (SELECT {W}, '{PRODUCER}-agent' AS source, {REASONS} AS reason,
  concat('.{PRODUCER}-transport-loss.agent-', channel, '.', window_sequence, '.json') AS marker
  FROM decided WHERE decision LIKE 'permanent%')"""


@query(oracle(f"""SELECT *, concat('{{"schema_version":1,"source":"{PRODUCER}-agent","channel":"', channel,
  '","window_sequence":', window_sequence, ',"reason":"', reason, '"}}') AS body FROM lost""", ATTACHED, DECIDED, LOST))
def record_losses(spark, sf_dir):
    return delivery.record_losses(decisions(spark, sf_dir), fixture(spark, sf_dir, "losses"), PRODUCER)


@query(oracle(f"""SELECT {W}, concat('{{"schema_version":1,"source":"x","channel":', CAST(to_json(channel) AS VARCHAR),
  ',"window_sequence":', window_sequence, ',"reason":', CAST(to_json(concat(reason, chr(10), '\\')) AS VARCHAR), '}}') AS body,
  concat('.{PRODUCER}-transport-loss.agent-a_b_', channel, '.', window_sequence, '.json') AS marker FROM losses"""))
def loss_record_json(spark, sf_dir):
    reason = F.concat("reason", F.lit("\n\\"))
    return fixture(spark, sf_dir, "losses").select(
        *WINDOW,
        delivery.loss_record(F.col("channel"), F.col("window_sequence"), reason, "x").alias("body"),
        delivery.loss_marker_name(F.concat(F.lit("a/b."), "channel"), F.col("window_sequence"), PRODUCER).alias("marker"))


HEADERS = [("Content-Type", "'application/x-ndjson'", "true"), ("Content-Encoding", "'gzip'", "true"),
           ("X-Acme-Session-Id", "session_id", "true"), ("X-Acme-Hostname", f"'{HOST}'", "true"),
           ("X-Acme-Window-Id", "window_id", "has_sidecar"), ("X-Acme-Window-Channel", "channel", "has_sidecar"),
           ("X-Acme-Window-Sequence", "CAST(window_sequence AS VARCHAR)", "has_sidecar"),
           ("X-Acme-Window-CRC32", "CAST(k AS VARCHAR)", "has_sidecar")]


@query(oracle("\nUNION ALL ".join(
    f"SELECT {W}, '{name}' AS header, {value} AS value FROM attached WHERE {when}" for name, value, when in HEADERS), ATTACHED))
def request_headers(spark, sf_dir):
    headers = F.explode(delivery.request_headers(HOST, "Acme")).alias("header", "value")
    return attached(spark, sf_dir).select(*WINDOW, headers)


@query(oracle(f"""SELECT {W}, window_id, decision, concat('/zone/', file_name) AS path,
  'https://collector.example/api/v1/events/stream' AS url FROM decided WHERE decision IN ('verified_send', 'legacy_send')""",
              ATTACHED, DECIDED))
def outbox_windows(spark, sf_dir):
    files = fixture(spark, sf_dir, "windows").select(*WINDOW, F.concat(F.lit("/zone/"), "file_name").alias("path"))
    return delivery.outbox_windows(decisions(spark, sf_dir), files, URL).select(
        *WINDOW, "window_id", "decision", "path", "url")


# -- one whole round of the window path ------------------------------------------------

ROUND = f"""ready AS (SELECT {W} FROM islands WHERE island = start_index - 1),
sent AS (SELECT d.*, d.decision IN ('verified_send', 'legacy_send', 'line_path') AND d.k % 6 <> 0 AS accepted
  FROM decided d JOIN ready USING ({W})),
stops AS (SELECT {S}, MIN(window_sequence) FILTER (NOT accepted) AS stop, MAX(window_sequence) + 1 AS after FROM sent GROUP BY ALL),
round AS (SELECT {S}, CAST(COALESCE(stop, after) AS BIGINT) AS file_index, CAST(0 AS BIGINT) AS read_offset FROM stops
  UNION ALL SELECT {S}, c.file_index, c.read_offset FROM cursors c ANTI JOIN stops USING ({S}))"""


@query(oracle("SELECT * FROM round", START, ISLANDS, ATTACHED, DECIDED, ROUND))
def window_path(spark, sf_dir):
    answers = fixture(spark, sf_dir, "windows").select(
        *WINDOW, F.when(F.col("k") % 6 != 0, 200).otherwise(503).alias("status"),
        F.lit('{"window_acknowledged":true}').alias("body"))
    done = window_round(
        hashed(spark, sf_dir), fixture(spark, sf_dir, "sidecars"), fixture(spark, sf_dir, "acks").where("false"),
        fixture(spark, sf_dir, "losses"), fixture(spark, sf_dir, "cursors"), fixture(spark, sf_dir, "sessions"),
        send=lambda requests: requests.join(answers, WINDOW), producer=PRODUCER)
    return done["cursors"]
