"""The line path over files: refused requests, faults, and keys with null parts."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from logharbor.operators import clean, delivery, packing, sequence
from logharbor.operators.skew import join_keys, lookup, previous_value, running_total
from logharbor.plans.line_round import line_round
from logharbor.schemas import STREAM, WINDOW
from logharbor.session import shared_dir

CURSORS = "folder string, session_id string, channel string, file_index long, read_offset long"
WINDOWS = "folder string, session_id string, channel string, window_sequence long, file_name string, path string, is_gz boolean, length long, mtime_ms long"


def zone(spark, folder, files):
    """Windows written below the folder: ``{(session, channel, number): bytes}``."""
    rows = []
    for (session, channel, number), content in files.items():
        name = f"{channel}.{number}.log.gz"
        path = folder / session / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(content)
        rows.append((str(folder), session, channel, number, name, str(path), True, len(content), 5))
    return spark.createDataFrame(rows, WINDOWS)


class Receiver:
    """Accepts requests in order up to those that it is told to refuse; keeps what it accepted."""

    def __init__(self, refuse):
        self.refuse, self.accepted = set(refuse), []

    def __call__(self, requests):
        out, stopped = [], set()
        for r in requests.orderBy(*WINDOW, "batch_id").collect():
            stream = (r.folder, r.session_id, r.channel)
            if stream in stopped:
                continue
            key = (r.channel, r.window_sequence, r.batch_id)
            refused = key in self.refuse
            out.append((*stream, r.window_sequence, r.batch_id, 503 if refused else 200, ""))
            if refused:
                self.refuse.discard(key)
                stopped.add(stream)
            else:
                self.accepted.append((r.channel, r.body))
        kinds = "folder string, session_id string, channel string, window_sequence long, batch_id long, status int, body string"
        return requests.sparkSession.createDataFrame(out, kinds)


def text(first, count):
    return "".join(f'{{"n":{i}}}\n' if i % 5 else ("{bad\n" if i % 2 else "  \n") for i in range(first, first + count))


def test_a_refused_request_is_where_its_window_resumes(spark, tmp_path):
    files = {("s", "device", 1): text(1, 20), ("s", "device", 2): text(21, 9), ("s", "scope", 1): text(100, 4), ("s", "scope", 3): text(120, 4)}
    windows = zone(spark, tmp_path, {k: gzip.compress(t.encode()) for k, t in files.items()})
    receiver = Receiver({("device", 1, 2)})
    cursors = spark.createDataFrame([], CURSORS)
    first = line_round(windows, cursors, receiver, "http://h", max_lines=3)
    at = {r.channel: (r.file_index, r.read_offset) for r in first["cursors"].collect()}
    refused = first["requests"].where("channel = 'device' and window_sequence = 1 and batch_id = 2").first()
    assert at == {"device": (1, refused.start_offset), "scope": (2, 0)}  # scope waits for its window 2
    assert refused.body.splitlines()[0] == '{"n":8}' and text(1, 20).encode()[refused.start_offset :].startswith(b'{"n":8}')
    second = line_round(windows, first["cursors"], receiver, "http://h", max_lines=3)
    assert {r.channel: (r.file_index, r.read_offset) for r in second["cursors"].collect()} == {"device": (3, 0), "scope": (2, 0)}
    for channel, want in (("device", range(1, 30)), ("scope", range(100, 104))):
        got = "".join(body for c, body in receiver.accepted if c == channel)
        assert got == "".join(f'{{"n":{i}}}\n' for i in want if i % 5)
    third = line_round(windows, second["cursors"], receiver, "http://h", max_lines=3)
    assert third["requests"].count() == 0 and third["cursors"].count() == 2


def test_windows_with_nothing_to_send_are_passed(spark, tmp_path):
    windows = zone(spark, tmp_path, {("s", "device", 1): gzip.compress(b""), ("s", "device", 2): gzip.compress(b"{bad\n \n")})
    found = line_round(windows, spark.createDataFrame([], CURSORS), Receiver(()), "http://h")
    assert [(r.file_index, r.read_offset) for r in found["cursors"].collect()] == [(3, 0)]


def test_a_broken_window_resumes_at_the_fault(spark, tmp_path):
    import random

    rng = random.Random(1)
    lines = "".join(f'{{"n":{rng.random()}}}\n' for _ in range(60_000)).encode()
    whole = gzip.compress(lines)
    files = {("s", "device", 1): whole[: len(whole) // 2], ("s", "device", 2): gzip.compress(b'{"n":1}\n'), ("s", "scope", 1): gzip.compress(b'{"n":2}\n')}
    receiver = Receiver(())
    found = line_round(zone(spark, tmp_path, files), spark.createDataFrame([], CURSORS), receiver, "http://h")
    at = {r.channel: (r.file_index, r.read_offset) for r in found["cursors"].collect()}
    sent = "".join(body for c, body in receiver.accepted if c == "device").encode()
    assert at["scope"] == (2, 0) and at["device"][0] == 1
    assert lines[: at["device"][1]] == sent[: at["device"][1]]
    windows = zone(spark, tmp_path, {**files, ("s", "device", 1): whole})
    again = line_round(windows, found["cursors"], receiver, "http://h")
    assert {r.channel: r.file_index for r in again["cursors"].collect()} == {"device": 3, "scope": 2}


# -- null key parts --------------------------------------------------------------------

PARTS = [("f", "s", "c"), (None, "s", "c"), ("f", None, "c"), ("f", "s", None), (None, None, None)]


@pytest.mark.parametrize("how, rows", [("inner", 1), ("left", 2), ("left_semi", 1), ("left_anti", 1)])
def test_null_is_a_key_like_others(spark, how, rows):
    left = spark.createDataFrame([(None, 1), ("b", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 3), ("c", 4)], "k string, y int")
    assert join_keys(left, right, ["k"], how).count() == lookup(left, right, ["k"], ["x"], how).count() == rows


def test_positions_and_offsets_with_null_parts(spark):
    lines = spark.createDataFrame([(*p, 1, n, "x" * n) for p in PARTS for n in (1, 2, 3)],
                                  "folder string, session_id string, channel string, window_sequence long, line_no long, line string")
    rows = sequence.line_offsets(lines).collect()
    assert len(rows) == lines.count() and {(r.line_no, r.byte_start, r.byte_end) for r in rows} == {(1, 0, 2), (2, 2, 5), (3, 5, 9)}
    linked = previous_value(lines.where("line_no <> 2"), WINDOW, "line_no", "before", 2)
    assert sorted(r.before or 0 for r in linked.collect()) == [0] * 5 + [1] * 5
    total = running_total(lines, WINDOW, "line_no", F.lit(1), "n", 2)
    assert total.where("n = line_no").count() == lines.count()
    packed = packing.pack_batches(lines, 2, 1000)
    assert packed.count() == lines.count() and packing.batch_bodies(packed).count() == 2 * len(PARTS)


def test_gaps_and_cursors_with_null_parts(spark):
    windows = spark.createDataFrame([(*p, n) for p in PARTS for n in (1, 2, 4)], "folder string, session_id string, channel string, window_sequence long")
    cursors = spark.createDataFrame([(*p, 2, 7) for p in PARTS], CURSORS)
    gaps = sequence.sequence_gaps(windows, cursors).collect()
    assert len(gaps) == len(PARTS) and {(r.gap_from, r.gap_to) for r in gaps} == {(3, 3)}
    ready = sequence.ready_prefix(windows, cursors).collect()
    assert len(ready) == len(PARTS) and {(r.window_sequence, r.start_offset) for r in ready} == {(2, 7)}
    results = windows.where("window_sequence = 2").withColumns({"accepted": F.lit(True), "retry_offset": F.lit(None).cast("long")})
    moved = delivery.advance_cursor(results, cursors)
    assert moved.count() == len(PARTS) and {r.file_index for r in moved.collect()} == {3}
    assert moved.select(*STREAM).distinct().count() == len(PARTS)


def test_batches_with_null_parts_are_deduplicated_not_dropped(spark):
    batch = '{"type":"device_metric_batch","columns":["device_id","gpu_util"],"rows":[[1,5],[1,5]]}'
    keys = [(None, "s"), ("f", None), ("f", "s")]
    lines = spark.createDataFrame([(f, s, "system", 1, 1, 1000, batch) for f, s in keys],
                                  "folder string, session_id string, channel string, window_sequence long, line_no long, sent_ms long, line string")
    sent = clean.dedup_lines(clean.clean_lines(lines), "sent_ms").collect()
    assert len(sent) == len(keys) and all(r.line.endswith('"rows":[[1,5]]}') for r in sent)


def test_lines_beyond_the_parsers_limit_stay(spark):
    big = F.concat(F.lit('{"type":"big","x":"'), F.expr("repeat('x', 140000000)"), F.lit('"}'))
    lines = spark.range(3).select("id", F.when(F.col("id") == 0, big).when(F.col("id") == 1, F.concat(big, F.lit(" tail"))).otherwise('{"type":"small"}').alias("line"))
    found = {r.id: r.event_type for r in clean.clean_lines(lines).select("id", "event_type").collect()}
    assert found == {0: "big", 2: "small"}


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Fake:
        conf = type("C", (), {"get": lambda self, key, default=None: default})()
        sparkContext = type("S", (), {"master": "local-cluster[2,1,1024]"})()

    with pytest.raises(ValueError):
        shared_dir(Fake())
