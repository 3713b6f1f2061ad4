import gzip
import json
import os
import zlib

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from logharbor.functions.paths import archive_keys, channel_filter, configured_channels, parse_channels, parse_window_path
from logharbor.operators import sessions
from logharbor.operators.integrity import cleanup_manifest
from logharbor.sources import files, landing


def put(path, content=b""):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return path


def entries(spark, root):
    return landing.scan_landing_zone(spark, [str(root)], landing.CONTROL_FILES)


def expected_lines(data):
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\n", at)
        stop = len(data) if end < 0 else end
        after = stop if end < 0 else end + 1
        out.append((len(out) + 1, at, after, data[at:stop].decode("utf-8", "replace")))
        at = after
    return out


CONTENTS = [
    b"", b"\n", b"a", b"a\n", b"a\r\nb\r\n\nc", "é\nß".encode(), b"x\xffy\nz\n", b"\n\n  \n", b"line\n" * 5000 + b"end",
]


@pytest.mark.parametrize("block", [3, 4 << 20])
def test_lines_with_exact_positions(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(files, "BLOCK", block)
    contents = CONTENTS if block > 3 else CONTENTS[:-1]
    for n, content in enumerate(contents, 1):
        put(tmp_path / "s" / f"device.{n}.log", content)
        put(tmp_path / "s" / f"scope.{n}.log.gz", gzip.compress(content))
    put(tmp_path / "s" / "system.1.log.gz", gzip.compress(b"one\n") + gzip.compress(b"two"))
    windows = landing.list_windows(entries(spark, tmp_path))
    got = {}
    for r in files.read_lines(windows.select("channel", "window_sequence", "path", "is_gz")).collect():
        got.setdefault((r.channel, r.window_sequence), []).append((r.line_no, r.byte_start, r.byte_end, r.line))
    for n, content in enumerate(contents, 1):
        for channel in ("device", "scope"):
            assert sorted(got.get((channel, n), [])) == expected_lines(content)
    assert [x[3] for x in sorted(got["system", 1])] == ["one", "two"]


def test_checksums(spark, tmp_path):
    text = b"x" * 600
    packed = gzip.compress(text)
    put(tmp_path / "s" / "device.1.log", text)
    put(tmp_path / "s" / "device.2.log.gz", packed)
    put(tmp_path / "s" / "device.3.log.gz", b"not gzip")
    put(tmp_path / "s" / "device.4.log")
    rows = {r.window_sequence: r for r in files.hash_payloads(landing.list_windows(entries(spark, tmp_path))).collect()}
    head = zlib.crc32(text[:512])
    assert (rows[1].length, rows[1].crc32, rows[1].head_sig) == (600, zlib.crc32(text), head)
    assert (rows[2].length, rows[2].crc32, rows[2].head_sig) == (len(packed), zlib.crc32(packed), head)
    assert (rows[3].crc32, rows[3].head_sig) == (zlib.crc32(b"not gzip"), 0)
    assert (rows[4].length, rows[4].head_sig) == (0, 0)


def test_window_paths(spark):
    names = ["device.1.log", "device.02.log", "device.0.log", "device.log", "scope.12.log.gz", "x.1.txt", "a.b.1.log",
             "custom_x-1.3.log", "device.99999999999999999999.log"]
    df = spark.createDataFrame([(f"/z/g/s/{n}",) for n in names], "path string")
    rows = {r.path.split("/")[-1]: r for r in parse_window_path(df).collect()}
    assert set(rows) == {"device.1.log", "scope.12.log.gz", "custom_x-1.3.log"}
    row = rows["scope.12.log.gz"]
    assert (row.folder, row.session_id, row.channel, row.window_sequence, row.is_gz) == ("/z/g", "s", "scope", 12, True)


def test_control_records(spark, tmp_path):
    good = {"schema_version": 1, "type": "transport_window", "window_id": "w", "session_id": "s", "channel": "device",
            "window_sequence": 1, "payload_file": "device.1.log.gz", "payload_bytes": 5, "payload_crc32": 4294967295, "new": {}}
    texts = [json.dumps(good), "null", "[]", "{oops", '{"schema_version":"x"}', "", '{"payload_bytes":null}']
    for n, text in enumerate(texts, 1):
        put(tmp_path / "s" / f".acme-window.device.{n}.json", text)
    put(tmp_path / "s" / ".acme-window-ack.device.1", "w \n")
    put(tmp_path / "s" / ".acme-transport-loss.agent-device.4.json", '{"source":"acme-agent","reason":"r"}')
    put(tmp_path / "s" / ".acme-transport-loss.client.json", "{}")
    put(tmp_path / "t" / ".failed")
    # Markers of another program say nothing about these windows.
    put(tmp_path / "s" / ".other-window.device.1.json", json.dumps({**good, "window_id": "x"}))
    put(tmp_path / "s" / ".other-window-ack.device.2", "w")
    put(tmp_path / "s" / ".other-transport-loss.agent-device.5.json", "{}")
    found = entries(spark, tmp_path)
    rows = {r.window_sequence: r for r in landing.scan_sidecars(found, "acme").collect()}
    assert landing.scan_sidecars(found, "acme").count() == len(texts)
    assert [rows[n].malformed for n in range(1, 8)] == [False, True, True, True, True, True, False]
    assert rows[1].payload_crc32 == 4294967295 and rows[1].opened_mono_ms == 0
    assert rows[7].payload_bytes == 0 and rows[7].schema_version == 0
    assert [(r.channel, r.window_sequence, r.window_id) for r in landing.scan_acks(found, "acme").collect()] == [("device", 1, "w")]
    losses = landing.scan_losses(found, "acme").collect()
    assert sorted((r.channel or "", r.window_sequence or 0, r.reason or "") for r in losses) == [("", 0, ""), ("device", 4, "r")]
    assert [(r.session_id, r.outcome) for r in landing.scan_settled(found).collect()] == [("t", "failed")]


def test_cursor_files(spark, tmp_path):
    path = put(tmp_path / "cursor.json", json.dumps({"streams": {
        "s.1.device": {"fileIndex": 2, "offset": 9}, "s.scope": {"fileIndex": 1, "offset": 0, "fileKey": "k", "fileSize": 3, "headSig": 4}}}))
    known = spark.createDataFrame([("f", "s.1"), ("g", "s.1"), ("f", "s")], "folder string, session_id string")
    rows = landing.scan_cursors(spark, str(path), known).collect()
    assert sorted((r.folder, r.session_id, r.channel, r.file_index, r.read_offset, r.head_sig) for r in rows) == [
        ("f", "s", "scope", 1, 0, 4), ("f", "s.1", "device", 2, 9, 0), ("g", "s.1", "device", 2, 9, 0)]
    for text in ("", "  \n", "{corrupt", "{}"):
        assert landing.parse_cursors(spark.createDataFrame([(text,)], "value string")).count() == 0


def test_markers_are_created_once(spark, tmp_path):
    target = f"{tmp_path}/s/.acme-window-ack.device.1"
    df = spark.createDataFrame([(target, bytearray(b"first\n"))], "path string, content binary")
    assert [r.written for r in files.write_new_files(df).collect()] == [True]
    again = df.withColumn("content", F.lit(b"second"))
    assert [r.written for r in files.write_new_files(again).collect()] == [False]
    assert open(target).read() == "first\n" and os.listdir(f"{tmp_path}/s") == [".acme-window-ack.device.1"]


def test_archive_copies_verbatim_and_tells_shared_keys(spark, tmp_path):
    put(tmp_path / "in" / "s1" / "device.1.log.gz", b"one")
    put(tmp_path / "in" / "s2" / "device.1.log.gz", b"twoo")
    keyed = archive_keys(landing.list_windows(entries(spark, tmp_path / "in")))
    assert [(r.archive_key, r.key_count) for r in keyed.collect()] == [("raw-events/device.1.log.gz", 2)] * 2
    rows = files.archive_windows(keyed, f"{tmp_path}/out").collect()
    assert {open(r.archive_path, "rb").read() for r in rows} == {b"one", b"twoo"}
    assert sorted(r.copied_bytes for r in rows) == [3, 4] and {r.status for r in rows} == {"copied"}
    # Again: the same bytes are there; other bytes are never replaced; a vanished payload is no copy.
    (tmp_path / "in" / "s2" / "device.1.log.gz").write_bytes(b"other")
    again = {r.session_id: (r.copied_bytes, r.status) for r in files.archive_windows(keyed, f"{tmp_path}/out").collect()}
    assert again == {"s1": (3, "present"), "s2": (None, "conflict")}
    gone = spark.createDataFrame(
        [("a b", "s", "device", 1, "/none", "k"), ("a_b", "s", "device", 1, f"{tmp_path}/in/s1/device.1.log.gz", "k"),
         ("../x", "..", "device", 1, f"{tmp_path}/in/s1/device.1.log.gz", "k")],
        "folder string, session_id string, channel string, window_sequence long, path string, archive_key string")
    got = {r.folder: r for r in files.archive_windows(gone, f"{tmp_path}/out").collect()}
    assert [got[f].status for f in ("a b", "a_b", "../x")] == ["unreadable", "copied", "copied"]
    assert len({r.archive_path for r in got.values()}) == 3 and os.path.realpath(got["../x"].archive_path).startswith(f"{tmp_path}/out")


def test_manifest_waits_for_the_archive(spark):
    keys = "folder string, session_id string, channel string, window_sequence long"
    record = [("f", "s", "device", n, 1, "transport_window", f"w{n}", "s", "device", n, f"device.{n}.log.gz", 1, 1) for n in (1, 2)]
    sidecars = spark.createDataFrame(
        record, f"{keys}, schema_version int, type string, window_id string, meta_session_id string, meta_channel string, "
        "meta_window_sequence long, payload_file string, payload_bytes long, payload_crc32 long")
    windows = spark.createDataFrame([("f", "s", "device", n, f"device.{n}.log.gz", True) for n in (1, 2)], f"{keys}, file_name string, is_gz boolean")
    acks = spark.createDataFrame([("f", "s", "device", n, f"w{n}") for n in (1, 2)], f"{keys}, window_id string")
    archived = spark.createDataFrame([("f", "s", "device", 1, "present"), ("f", "s", "device", 2, "conflict")], f"{keys}, status string")
    rows = {r.window_sequence: (r.reason, r.delete) for r in cleanup_manifest(windows, sidecars, acks, archived).collect()}
    assert rows == {1: ("acknowledged", True), 2: ("not_archived", False)}
    assert cleanup_manifest(windows, sidecars, acks).where("delete").count() == 2


def test_only_files_of_sessions_are_windows(spark, tmp_path):
    put(tmp_path / "device.3.log", "x")
    put(tmp_path / "s" / "device.1.log", "x")
    put(tmp_path / "s" / ".tmp" / "device.2.log", "x")
    put(tmp_path / "s" / "x" / "device.4.log", "x")
    put(tmp_path / ".hid" / "device.5.log", "x")
    put(tmp_path / "g" / "t" / "scope.6.log.gz", "x")
    put(tmp_path / "g" / "t" / "y" / "device.7.log", "x")
    want = [("s", 1), ("t", 6)]
    for found in (landing.list_windows(entries(spark, tmp_path)), landing.scan_windows(spark, [str(tmp_path)]),
                  landing.scan_windows(spark, [f"file://{tmp_path}/"])):
        assert sorted((r.session_id, r.window_sequence) for r in found.collect()) == want


def test_a_broken_window_ends_alone(spark, tmp_path):
    whole = gzip.compress(os.urandom(200_000).hex().encode() + b"\nend\n")
    put(tmp_path / "s" / "device.1.log.gz", whole)
    put(tmp_path / "s" / "device.2.log.gz", whole[:-2000])
    put(tmp_path / "s" / "device.3.log.gz", gzip.compress(b"fine\n"))
    windows = landing.list_windows(entries(spark, tmp_path)).select("window_sequence", "path", "is_gz")
    gone = windows.limit(1).selectExpr("4L AS window_sequence", "'/none/device.4.log' AS path", "false AS is_gz")
    got = {}
    for r in files.read_lines(windows.union(gone), with_faults=True).collect():
        got.setdefault(r.window_sequence, []).append((r.line is None, r.fault is not None))
    assert got[1] == [(False, False)] * 2 and got[3] == [(False, False)]
    assert got[2][-1] == got[4][-1] == (True, True)
    with pytest.raises(PythonException):
        files.read_lines(windows).collect()


def test_channels(spark):
    assert parse_channels(None) == parse_channels(" , ") == ["device", "scope", "system", "sass"]
    assert parse_channels(" device, ,custom ") == ["device", "custom"]
    df = spark.createDataFrame([("f", "s", c) for c in ("device", "scope", "x")], "folder string, session_id string, channel string")
    assert channel_filter(df, None).count() == 2 and channel_filter(df, "x").count() == 1 and channel_filter(df, ["x"]).count() == 1
    source = spark.createDataFrame([("f", ["x"]), ("g", ["device"])], "folder string, log_types array<string>")
    assert [r.channel for r in configured_channels(df, source).collect()] == ["x"]


def catalog(spark, root):
    rows = sessions.session_catalog(entries(spark, root)).collect()
    return sorted((r.folder.removeprefix(str(root)).strip("/"), r.session_id, r.settled) for r in rows)


def test_session_discovery(spark, tmp_path):
    put(tmp_path / "flat" / "device.1.log")
    put(tmp_path / "flat" / "nested" / "device.1.log")        # below a session: not descended
    put(tmp_path / "group" / "a" / "scope.3.log.gz")
    put(tmp_path / "group" / "b" / "readme.txt")              # no channel file
    put(tmp_path / "group" / ".c" / "device.log")             # hidden
    put(tmp_path / ".hidden" / "device.log")
    put(tmp_path / "deep" / "x" / "y" / "device.log")         # too deep
    put(tmp_path / "grave" / ".acme-window.system.2.json", "{}")  # tombstone only
    put(tmp_path / "done" / "sass.log")
    put(tmp_path / "done" / ".uploaded")
    put(tmp_path / "done" / "inner" / "device.log")           # settled session: not descended either
    put(tmp_path / "live" / ".tmp" / "device.log")            # still in the working directory only
    put(tmp_path / "odd" / "device.x.log")
    assert catalog(spark, tmp_path) == [
        ("", "done", True), ("", "flat", False), ("", "grave", False), ("group", "a", False)]


def test_flat_files_are_reported_once_per_folder(spark, tmp_path):
    for name in ("run.scope.2.log.gz", "app.device.log", "device.log", "notes.txt"):
        put(tmp_path / name)
    rows = sessions.legacy_flat_files(entries(spark, tmp_path)).collect()
    assert [(r.folder, r.file_name) for r in rows] == [(str(tmp_path), "app.device.log")]


def test_newest_change_of_the_working_directory(spark, tmp_path):
    inside = put(tmp_path / "g" / "s" / ".tmp" / "device.log")
    put(tmp_path / "g" / "s" / "device.1.log")
    os.utime(inside, (2_000_000_000, 2_000_000_000))
    put(tmp_path / "t" / ".tmp" / "x")
    os.utime(tmp_path / "t" / ".tmp" / "x", (1000, 1000))
    os.utime(tmp_path / "t" / ".tmp", (5000, 5000))
    rows = sessions.tmp_newest_mtime(entries(spark, tmp_path)).collect()
    assert sorted((r.session_dir, r.tmp_mtime_ms) for r in rows) == [("g/s", 2_000_000_000_000), ("t", 5_000_000)]


def test_missing_folder_is_empty(spark, tmp_path):
    assert entries(spark, tmp_path / "none").count() == 0


def test_payload_bytes(spark, tmp_path):
    put(tmp_path / "s" / "device.1.log.gz", b"\x00one")
    put(tmp_path / "s" / "device.2.log.gz", b"two")
    rows = files.read_payloads(landing.list_windows(entries(spark, tmp_path))).collect()
    assert {r.window_sequence: bytes(r.content) for r in rows} == {1: b"\x00one", 2: b"two"}
