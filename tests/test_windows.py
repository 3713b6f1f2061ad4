import pytest
from pyspark.sql import functions as F

from logharbor.operators import delivery, integrity, sequence
from logharbor.schemas import WINDOW

STREAM = ("f", "s", "device")
WINDOWS = "folder string, session_id string, channel string, window_sequence bigint, file_name string, is_gz boolean, length bigint, crc32 bigint"
CURSORS = "folder string, session_id string, channel string, file_index bigint, read_offset bigint"
KEYED = "folder string, session_id string, channel string, window_sequence bigint"
SIDECARS = KEYED + (", schema_version int, type string, window_id string, meta_session_id string, meta_channel string, "
                    "meta_window_sequence bigint, payload_file string, payload_bytes bigint, payload_crc32 bigint, malformed boolean")


def windows(spark, numbers, gz=True):
    rows = [(*STREAM, n, f"device.{n}.log" + (".gz" if gz else ""), gz, 10, 99) for n in numbers]
    return spark.createDataFrame(rows, WINDOWS)


def sidecar(n, **change):
    row = dict(folder="f", session_id="s", channel="device", window_sequence=n, schema_version=1, type="transport_window",
               window_id=f"w{n}", meta_session_id="s", meta_channel="device", meta_window_sequence=n,
               payload_file=f"device.{n}.log.gz", payload_bytes=10, payload_crc32=99, malformed=False)
    row.update(change)
    return tuple(row.values())


def numbers(df):
    return sorted(r.window_sequence for r in df.collect())


def cursors(spark, *rows):
    return spark.createDataFrame([(*STREAM, *r) for r in rows], CURSORS)


@pytest.mark.parametrize("present,start,done,ready,gaps", [
    ([3, 1, 2], None, [], [1, 2, 3], []),
    ([1, 2, 4], None, [], [1, 2], [(3, 3)]),
    ([2, 3], None, [], [], [(1, 1)]),
    ([1, 2, 3, 9], (3, 0), [], [3], [(4, 8)]),
    ([2, 4], None, [1, 3], [2, 4], []),
    ([1, 2], (0, 7), [], [1, 2], []),
    ([1, 5000, 9000], None, [], [1], [(2, 4999), (5001, 8999)]),
    ([4095, 4096, 4097, 8192], (4095, 0), [], [4095, 4096, 4097], [(4098, 8191)]),
])
def test_only_the_gap_free_run_is_ready(spark, present, start, done, ready, gaps):
    position = cursors(spark, *([start] if start else []))
    settled = spark.createDataFrame([(*STREAM, n) for n in done], KEYED)
    assert numbers(sequence.ready_prefix(windows(spark, present), position, settled)) == ready
    found = sequence.sequence_gaps(windows(spark, present), position, settled).collect()
    assert sorted((r.gap_from, r.gap_to) for r in found) == gaps


def test_plain_file_is_preferred(spark):
    both = windows(spark, [1, 2]).union(windows(spark, [2], gz=False))
    assert sorted(r.file_name for r in sequence.prefer_plain(both).collect()) == ["device.1.log.gz", "device.2.log"]


def test_resume_keeps_whole_lines_from_the_offset(spark):
    lines = spark.createDataFrame([(*STREAM, w, n, "x" * n) for w in (1, 2) for n in (1, 2, 3)],
                                  KEYED + ", line_no bigint, line string")
    rows = sequence.resume_lines(sequence.line_offsets(lines), cursors(spark, (1, 2))).collect()
    assert sorted((r.window_sequence, r.line_no) for r in rows) == [(1, 2), (1, 3), (2, 1), (2, 2), (2, 3)]
    rows = sequence.resume_lines(sequence.line_offsets(lines), cursors(spark, (2, 3))).collect()
    assert sorted((r.window_sequence, r.line_no) for r in rows) == [(2, 3)]


def test_line_offsets_across_buckets(spark):
    rows = [(*STREAM, 1, n, "é" * (n % 3)) for n in range(0, 300_000, 1000)]
    lines = spark.createDataFrame(rows, KEYED + ", line_no bigint, line string")
    at = 0
    for row in sequence.line_offsets(lines).orderBy("line_no").collect():
        size = len(row.line.encode()) + 1
        assert (row.byte_start, row.byte_end) == (at, at + size)
        at += size


def decide(spark, side, lock="UNOWNED", gz=True, lost=(), stream_mode=True):
    sidecars = spark.createDataFrame(side, SIDECARS)
    sessions = spark.createDataFrame([("f", "s", lock)], "folder string, session_id string, owner_state string")
    losses = spark.createDataFrame([(*STREAM, n) for n in lost], KEYED)
    return integrity.window_decision(windows(spark, [1], gz), sidecars, sessions, losses, stream_mode).first()


@pytest.mark.parametrize("change,decision", [
    ({}, "verified_send"), ({"malformed": True}, "permanent_malformed"), ({"meta_session_id": "other"}, "permanent_mismatch"),
    ({"window_id": " "}, "permanent_mismatch"), ({"schema_version": 2}, "permanent_mismatch"), ({"type": "x"}, "permanent_mismatch"),
    ({"payload_file": "device.1.log"}, "permanent_mismatch"), ({"payload_bytes": -1}, "permanent_mismatch"),
    ({"payload_bytes": 11}, "permanent_checksum"), ({"payload_crc32": 98}, "permanent_checksum"),
    ({"meta_channel": "scope"}, "permanent_mismatch"), ({"meta_window_sequence": 2}, "permanent_mismatch"),
])
def test_decision_by_sidecar(spark, change, decision):
    row = decide(spark, [sidecar(1, **change)])
    assert row.decision == decision
    assert (row.reason is not None) == decision.startswith("permanent")


def test_decision_without_sidecar(spark):
    assert decide(spark, [], "LEGACY_NO_LOCK").decision == "legacy_send"
    for lock in ("ACTIVE", "UNOWNED", "UNKNOWN"):
        assert decide(spark, [], lock).decision == "retry_wait"
    assert decide(spark, [], gz=False).decision == "line_path"
    assert decide(spark, [sidecar(1)], stream_mode=False).decision == "line_path"
    assert decide(spark, [sidecar(1)], lost=[1]).decision == "prior_failure"


def acks(spark, *rows):
    return spark.createDataFrame([(*STREAM, n, w) for n, w in rows], KEYED + ", window_id string")


def test_cleanup_needs_sidecar_own_ack_and_validity(spark):
    present = windows(spark, [1, 2, 3, 4]).union(windows(spark, [5], gz=False))
    sidecars = spark.createDataFrame([sidecar(1), sidecar(2), sidecar(4, meta_session_id="x"), sidecar(5)], SIDECARS)
    marks = acks(spark, (1, "w1"), (2, "other"), (3, "w3"), (4, "w4"), (5, "w5"))
    got = {r.window_sequence: (r.delete, r.reason) for r in integrity.cleanup_manifest(present, sidecars, marks).collect()}
    assert got == {1: (True, "acknowledged"), 2: (False, "not_acknowledged"), 3: (False, "no_sidecar"),
                   4: (False, "sidecar_mismatch"), 5: (False, "not_compressed")}


def test_acked_payloads_below_the_cursor_are_requeued(spark):
    sidecars = spark.createDataFrame([sidecar(1), sidecar(2), sidecar(3)], SIDECARS)
    marks = acks(spark, (1, "w1"), (2, "no"), (3, "w3"))
    assert numbers(integrity.requeue_acked(windows(spark, [1, 2, 3]), sidecars, marks, cursors(spark, (3, 0)))) == [1]
    assert sequence.tombstone_skip(windows(spark, [2]), integrity.acked_windows(sidecars, marks)).where(
        "status = 'done'").select("window_sequence").orderBy("window_sequence").collect() == [(1,), (3,)]


def test_blocked_streams(spark):
    losses = spark.createDataFrame([(*STREAM, 1)], KEYED)
    streams, none = windows(spark, [1]), cursors(spark, (0, 0)).limit(0)
    assert numbers(sequence.blocked_streams(streams, none, losses)) == [1]
    assert numbers(sequence.blocked_streams(streams, cursors(spark, (0, 0)), losses)) == [1]
    assert numbers(sequence.blocked_streams(streams, cursors(spark, (2, 0)), losses)) == []


@pytest.mark.parametrize("results,after", [
    ([(1, True, None), (2, True, None)], (3, 0)),
    ([(1, True, None), (2, False, 40), (3, True, None)], (2, 40)),
    ([(1, False, None)], (1, 0)),
])
def test_cursor_stops_at_the_first_unaccepted_window(spark, results, after):
    rows = spark.createDataFrame([(*STREAM, *r) for r in results], KEYED + ", accepted boolean, retry_offset bigint")
    other = spark.createDataFrame([("f", "s", "scope", 4, 8)], CURSORS)
    got = {r.channel: (r.file_index, r.read_offset) for r in delivery.advance_cursor(rows, other).collect()}
    assert got == {"device": after, "scope": (4, 8)}


ACKED, CONFLICT = '{"window_acknowledged":true}', '{"code":"window_identity_conflict"}'


@pytest.mark.parametrize("status,body,window_id,size,outcome", [
    (200, ACKED, "w", 1, "accepted_identity"), (202, ACKED, "w", 1, "accepted_identity"), (200, ACKED, None, 1, "accepted_legacy"),
    (202, '{"accepted_for_processing":true,"spool_id":"legacy"}', "w", 1, "accepted_legacy"), (200, "", "w", 1, "accepted_legacy"),
    (200, "not json", "w", 1, "accepted_legacy"), (200, '{"window_acknowledged":false}', "w", 1, "accepted_legacy"),
    (200, None, "w", 1, "accepted_legacy"), (409, CONFLICT, "w", 1, "retry"), (409, CONFLICT, None, 1, "accepted_legacy"),
    (409, "", "w", 1, "accepted_legacy"), (402, "", "w", 1, "accepted_legacy"), (404, "", "w", 1, "retry"),
    (500, "", None, 1, "retry"), (302, "", None, 1, "retry"), (None, None, "w", 1, "retry"), (None, None, "w", 0, "accepted_legacy"),
])
def test_stream_responses(spark, status, body, window_id, size, outcome):
    df = spark.createDataFrame([(status, body, window_id, size)], "status int, body string, window_id string, payload_bytes bigint")
    row = delivery.classify_stream_response(df).first()
    assert (row.outcome, row.accepted, row.identity_acknowledged) == (
        outcome, outcome != "retry", outcome == "accepted_identity")


@pytest.mark.parametrize("status,event,complete", [
    (200, "advance", "done"), (402, "advance", "done"), (404, "retry", "done"), (409, "retry", "done"),
    (500, "retry", "retry"), (302, "retry", "retry"), (None, "retry", "retry"),
])
def test_other_responses(spark, status, event, complete):
    df = spark.createDataFrame([(status, 2)], "status int, attempt int")
    assert delivery.classify_event_response(df).first().outcome == event
    row = delivery.classify_complete_response(df).first()
    assert (row.outcome, row.next_delay_s) == (complete, None if complete == "done" else 4)


def test_completion_is_given_up_after_three_tries(spark):
    df = spark.createDataFrame([(500, n) for n in (1, 2, 3)], "status int, attempt int")
    rows = delivery.classify_complete_response(df).orderBy("attempt").collect()
    assert [(r.outcome, r.next_delay_s) for r in rows] == [("retry", 2), ("retry", 4), ("give_up", 8)]


def test_records_are_written_once(spark):
    new = spark.createDataFrame([(*STREAM, 1, "w1", True), (*STREAM, 1, "w1", True), (*STREAM, 2, "w2", False), (*STREAM, 3, "w3", True)],
                                KEYED + ", window_id string, identity_acknowledged boolean")
    assert numbers(delivery.record_acks(new, acks(spark, (3, "kept")))) == [1]
    decided = spark.createDataFrame([(*STREAM, n, d, "why") for n, d in ((1, "permanent_checksum"), (2, "verified_send"), (3, "permanent_mismatch"))],
                                    KEYED + ", decision string, reason string")
    lost = delivery.record_losses(decided, spark.createDataFrame([(*STREAM, 3)], KEYED), "acme").collect()
    assert [(r.window_sequence, r.marker) for r in lost] == [(1, ".acme-transport-loss.agent-device.1.json")]
    assert lost[0].body == ('{"schema_version":1,"source":"acme-agent","channel":"device","window_sequence":1,"reason":"why"}')


def test_loss_record_escapes(spark):
    df = spark.createDataFrame([("a/b", 'x"\\\r\n'), (None, None)], "channel string, reason string")
    rows = df.select(delivery.loss_record(F.col("channel"), F.lit(1), F.col("reason"), "x").alias("body"),
                     delivery.loss_marker_name(F.col("channel"), F.lit(1), "p").alias("name")).collect()
    assert rows[0].body.endswith('"channel":"a/b","window_sequence":1,"reason":"x\\"\\\\\\r\\n"}')
    assert [r.name for r in rows] == [".p-transport-loss.agent-a_b.1.json", ".p-transport-loss.agent-unknown.1.json"]
    assert rows[1].body.endswith('"channel":"","window_sequence":1,"reason":""}')


def test_headers(spark):
    schema = KEYED + ", window_id string, payload_crc32 bigint"
    df = spark.createDataFrame([(*STREAM, 7, "w", 4294967295), (*STREAM, 8, None, None)], schema)
    full, bare = [r[0] for r in df.orderBy("window_sequence").select(delivery.request_headers("h", "Acme")).collect()]
    assert full["X-Acme-Window-CRC32"] == "4294967295" and full["X-Acme-Window-Sequence"] == "7"
    assert bare == {"Content-Type": "application/x-ndjson", "Content-Encoding": "gzip",
                    "X-Acme-Session-Id": "s", "X-Acme-Hostname": "h"}
    assert set(WINDOW) <= set(df.columns)


def test_compressed_bodies(spark):
    import gzip

    df = spark.createDataFrame([("a\né\n",)], "body string")
    assert gzip.decompress(delivery.gzip_bodies(df).first().body_gz).decode() == "a\né\n"


def test_kafka_options():
    from logharbor.sources.kafka import kafka_options

    assert kafka_options("b:9092") == {"kafka.bootstrap.servers": "b:9092", "kafka.compression.type": "snappy", "kafka.linger.ms": "100"}
    assert kafka_options("b", "zstd", 5)["kafka.compression.type"] == "zstd"
