import gzip
import json
import os
import random
import time
import zlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from logharbor.session import listing_tasks
from logharbor.sources import files, landing
from logharbor.streaming.rounds import RoundTables, dedup_rounds, retry_round, window_rounds
from logharbor.streaming.stateful import dedup_with_state
from logharbor.streaming.windows import poll_windows, stream_lines, stream_windows
from tests.models import keep_changed
from tests.test_ordered import SAMPLE, sample_rows


def run(writer, checkpoint):
    query = writer.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination()


def write_samples(spark, path, rows):
    spark.createDataFrame([tuple(r.values()) for r in rows], SAMPLE).coalesce(1).write.mode("append").parquet(str(path))
    time.sleep(1.1)  # files are taken in order of their modification time


@pytest.mark.parametrize("kind", ["state", "rounds"])
def test_dedup_stream_equals_batch_across_a_restart(spark, tmp_path, kind):
    rows = sample_rows(random.Random(5), 900, 0.97, 1000)
    source = tmp_path / "in"
    schema = spark.createDataFrame([], SAMPLE).schema

    def stream():
        samples = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        if kind == "rounds":
            return dedup_rounds(samples, str(tmp_path / "out"), ["session_id", "device_id"], ["ts_ms", "row_no"])
        return dedup_with_state(samples).writeStream.format("parquet").option("path", str(tmp_path / "out" / "kept"))

    write_samples(spark, source, rows[:300])
    write_samples(spark, source, rows[300:500])
    run(stream(), tmp_path / "checkpoint")
    write_samples(spark, source, rows[500:])
    run(stream(), tmp_path / "checkpoint")
    got = sorted(r.row_no for r in spark.read.parquet(str(tmp_path / "out" / "kept")).collect())
    assert got == [r["row_no"] for r in keep_changed(rows)]


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    tables = RoundTables(spark, str(tmp_path))
    df = spark.createDataFrame([(1,)], "n bigint")
    for _ in range(2):
        tables.write(df, "t", 0)
    tables.write(df.withColumn("n", F.lit(2).cast("bigint")), "t", 1)
    assert sorted(r.n for r in tables.history("t", 2, df.schema).collect()) == [1, 2]
    assert [r.n for r in tables.history("t", 1, df.schema).collect()] == [1]
    assert [r.n for r in tables.snapshot("t", 1, df.schema).collect()] == [1]
    assert tables.snapshot("t", 0, df.schema).count() == 0 and tables.history("other", 0, df.schema).count() == 0
    for lost in (tables.snapshot, tables.history):
        with pytest.raises(AnalysisException):
            lost("other", 1, df.schema)


def put_window(root, n, text, sidecar=True, fault=0):
    data = gzip.compress(text.encode())
    folder = root / "s"
    folder.mkdir(parents=True, exist_ok=True)
    record = {"schema_version": 1, "type": "transport_window", "window_id": f"w{n}", "session_id": "s", "channel": "device",
              "window_sequence": n, "payload_file": f"device.{n}.log.gz", "payload_bytes": len(data) + fault,
              "payload_crc32": zlib.crc32(data)}
    if sidecar:
        (folder / f".acme-window.device.{n}.json").write_text(json.dumps(record))
    (folder / f"device.{n}.log.gz").write_bytes(data)
    (folder / ".tmp").mkdir(exist_ok=True)
    (folder / ".tmp" / "device.log").write_text("unfinished")


def test_stream_of_windows_and_lines(spark, tmp_path):
    root = tmp_path / "zone"
    put_window(root, 1, "a\nb")
    lines = stream_lines(stream_windows(spark, str(root)).select("channel", "window_sequence", "path", "is_gz"))
    writer = lambda: lines.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    run(writer(), tmp_path / "checkpoint")
    put_window(root, 2, "c\n")
    run(writer(), tmp_path / "checkpoint")
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.channel, r.window_sequence, r.line_no, r.line) for r in rows) == [
        ("device", 1, 1, "a"), ("device", 1, 2, "b"), ("device", 2, 1, "c")]


def test_delivery_rounds_hold_back_refused_and_later_windows(spark, tmp_path):
    root, base = tmp_path / "zone", tmp_path / "tables"
    sent, refused = [], {4}

    def control(session):
        found = landing.scan_landing_zone(session, [str(root)], landing.CONTROL_FILES)
        owners = session.createDataFrame([(str(root), "s", "UNOWNED")], "folder string, session_id string, owner_state string")
        return landing.scan_sidecars(found, "acme"), owners

    def send(requests):
        requests = requests.where(F.col("window_sequence") <= min(refused, default=99))
        sent.extend(r.window_sequence for r in requests.collect())
        status = F.when(F.col("window_sequence").isin(*(refused or {0})), 503).otherwise(200)
        return requests.withColumns({"status": status, "body": F.lit('{"window_acknowledged":true}')})

    def deliver():
        found = files.hash_payloads(stream_windows(spark, str(root)))
        run(window_rounds(found, str(base), control, send, "acme"), tmp_path / "checkpoint")
        tables = RoundTables(spark, str(base))
        last = max(int(p.name.split("=")[1]) for p in (base / "cursors").iterdir())
        got = [r.file_index for r in spark.read.parquet(str(base / "cursors" / f"epoch={last}")).collect()]
        acked = sorted(r.window_sequence for r in tables.all("acks").collect())
        return got, acked

    put_window(root, 1, "one")
    put_window(root, 3, "three")
    assert deliver() == ([2], [1])
    put_window(root, 2, "two")
    put_window(root, 4, "four")
    put_window(root, 5, "five")
    assert deliver()[0] == [4]
    # Without a new file the refused window is tried again, and what waits behind it goes too.
    assert retry_round(spark, str(base), control, send, "acme")
    refused.clear()
    assert retry_round(spark, str(base), control, send, "acme")
    assert sorted(r.window_sequence for r in RoundTables(spark, str(base)).all("acks").collect()) == [1, 2, 3, 4, 5]
    assert not retry_round(spark, str(base), control, send, "acme")
    assert sorted(set(sent)) == [1, 2, 3, 4, 5] and sent.count(4) == 3 and sent.count(5) == 1
    put_window(root, 6, "six", fault=1)
    put_window(root, 7, "seven")
    got, acked = deliver()
    assert got == [6] and acked == [1, 2, 3, 4, 5]
    losses = RoundTables(spark, str(base)).all("losses").collect()
    assert [(r.window_sequence, r.reason) for r in losses] == [(6, "payload_checksum_mismatch:device.6.log.gz")]
    # A loss is recorded once and keeps its stream blocked.
    put_window(root, 8, "eight")
    assert deliver()[0] == [6]
    assert RoundTables(spark, str(base)).all("losses").count() == 1
    assert 7 not in sent


def test_a_trigger_of_many_files_takes_few_tasks(spark, tmp_path):
    root, tasks = tmp_path / "zone", []
    for n in range(1, 81):
        put_window(root, n, "a\n", sidecar=False)
    lines = stream_lines(stream_windows(spark, str(root)).select("channel", "window_sequence", "path", "is_gz"))
    query = lines.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    status = spark.sparkContext.statusTracker()
    for job in status.getJobIdsForGroup(str(query.runId)):
        tasks += [status.getStageInfo(stage).numTasks for stage in status.getJobInfo(job).stageIds if status.getStageInfo(stage)]
    assert tasks and max(tasks) <= listing_tasks(spark) < 80
    assert spark.read.parquet(str(tmp_path / "out")).count() == 80


def test_delivery_rounds_open_only_the_sidecars_in_question(spark, tmp_path):
    root, base, asked = tmp_path / "zone", tmp_path / "tables", []
    for n in (1, 2, 3, 5, 6):
        put_window(root, n, f"{n}\n", sidecar=n != 3)

    def lookup_sidecars(windows):
        asked.append(sorted(r.window_sequence for r in windows.collect()))
        return landing.sidecars_of(windows, "acme")

    def control(session):
        return lookup_sidecars, session.createDataFrame([(str(root), "s", "UNOWNED")], "folder string, session_id string, owner_state string")

    answer = {"status": F.lit(200), "body": F.lit('{"window_acknowledged":true}')}
    found = files.hash_payloads(stream_windows(spark, str(root)))
    run(window_rounds(found, str(base), control, lambda r: r.withColumns(answer), "acme"), tmp_path / "checkpoint")
    assert asked == [[1, 2, 3]]
    cursor = RoundTables(spark, str(base)).all("cursors").first()
    assert cursor.file_index == 3

    listed = landing.scan_landing_zone(spark, [str(root)], landing.CONTROL_FILES)
    every = landing.list_windows(listed)
    by_listing, by_name = landing.scan_sidecars(listed, "acme"), landing.sidecars_of(every, "acme")
    assert by_name.schema.names == by_listing.schema.names
    assert sorted(map(tuple, by_name.collect())) == sorted(map(tuple, by_listing.collect()))


def test_a_listing_opens_no_file_whose_text_nobody_asks_for(spark, tmp_path):
    root = tmp_path / "zone"
    put_window(root, 1, "a\n")
    marker = root / "s" / ".acme-window-ack.device.1"
    marker.symlink_to("/proc/self/mem")  # can be looked at, but not read from its start
    listed = landing.scan_landing_zone(spark, [str(root)], landing.CONTROL_FILES)
    assert {r.name for r in listed.select("name").collect()} >= {marker.name, "device.1.log.gz"}


def test_a_round_leaves_alone_what_waits_behind_a_gap(spark, tmp_path):
    root, base = tmp_path / "zone", tmp_path / "tables"
    owners = [(str(root), "s", "UNOWNED")]
    control = lambda s: (lambda w: landing.sidecars_of(w, "acme"), s.createDataFrame(owners, "folder string, session_id string, owner_state string"))
    send = lambda r: r.withColumns({"status": F.lit(200), "body": F.lit("")})
    tables = RoundTables(spark, str(base))

    def written(table):
        numbers = tables.epochs("windows")[-1:]
        return sorted(r.window_sequence for n in numbers for r in spark.read.parquet(f"{base}/{table}/epoch={n}").collect())

    def deliver(*new):
        for n in new:
            put_window(root, n, f"{n}\n")
        run(window_rounds(files.hash_payloads(stream_windows(spark, str(root))), str(base), control, send, "acme"), tmp_path / "checkpoint")
        last = tables.epochs("windows")[-1]
        return spark.read.parquet(f"{base}/cursors/epoch={last}").collect()

    assert deliver(3, 4, 6) == [] and (written("held"), written("windows"), written("near")) == ([3, 4, 6], [], [])
    # The round reads, and writes, only what its own windows bring into reach.
    assert [r.file_index for r in deliver(1)] == [2] and (written("held"), written("near")) == ([], [1])
    assert [r.file_index for r in deliver(2, 8)] == [5] and (written("held"), written("near")) == ([8], [2, 3, 4])
    assert retry_round(spark, str(base), control, send, "acme") and (written("held"), written("near")) == ([6, 8], [])


def test_a_listing_spares_the_driver_the_names_of_windows(spark, tmp_path):
    root, listing, out = tmp_path / "zone", str(tmp_path / "listing"), str(tmp_path / "out")
    for n in range(1, 6):
        put_window(root, n, f"{n}\n", sidecar=False)
    (root / "s" / "device.6.log.gz").write_bytes(b"")
    for name in ("_hidden.1.log", ".dot.1.log", "device.x.log"):
        (root / "s" / name).write_text("no window")
    (root / "device.1.log").write_text("beside the sessions")
    (root / "_g" / "s").mkdir(parents=True)
    (root / "_g" / "s" / "device.1.log").write_text("hidden")
    sizes = []

    def deliver(make, checkpoint, out):
        query = make.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
        query.awaitTermination()
        sizes.append([p.numInputRows for p in query.recentProgress if p.numInputRows])
        return sorted(map(tuple, spark.read.parquet(out).collect()))

    def listed():
        return deliver(stream_windows(spark, str(root), 2, listing=listing), tmp_path / "checkpoint", out)

    by_listing = listed()
    assert by_listing == deliver(stream_windows(spark, str(root)), tmp_path / "other", str(tmp_path / "by_source"))
    assert sorted(sizes[0]) == [1, 2, 2]
    log = "".join(p.read_text() for p in (tmp_path / "checkpoint" / "sources" / "0").iterdir() if not p.name.startswith("."))
    assert "part-" in log and ".log.gz" not in log
    # What was published is known to the next poll, and what comes later is delivered once.
    assert poll_windows(spark, str(root), listing, 2) == 0
    put_window(root, 7, "7\n", sidecar=False)
    assert len(listed()) == 6 and sizes[-1] == [1]
    put_window(root, 8, "8\n", sidecar=False)
    os.utime(root / "s" / "device.8.log.gz", (1_000_000_000, 1_000_000_000))
    assert poll_windows(spark, str(root), listing, 2, max_file_age="1h") == 0 and poll_windows(spark, str(root), listing, 2) == 1
    lines = stream_lines(stream_windows(spark, str(root), 2, listing=listing).select("window_sequence", "path", "is_gz"))
    assert [r[:1] + r[-1:] for r in deliver(lines, tmp_path / "lines", str(tmp_path / "texts"))] == [(n, str(n)) for n in (1, 2, 3, 4, 5, 7, 8)]
