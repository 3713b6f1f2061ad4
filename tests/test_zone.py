import os
import time

import pytest
from pyspark.sql import functions as F

from logharbor.sources import landing
from logharbor.streaming.zone import stream_landing_zone, stream_listed_windows
from tests.test_files import put
from tests.test_streaming import run


def names(spark, path):
    if not path.exists():
        return []
    return sorted("/".join(p for p in (r.rel_dir, r.name) if p) for r in spark.read.parquet(str(path)).where("NOT is_dir").collect())


@pytest.mark.parametrize("resting_ms", [10_000, 100])
def test_every_entry_comes_once_across_restarts(spark, tmp_path, resting_ms):
    root, out = tmp_path / "zone", tmp_path / "out"
    put(root / "flat" / "device.1.log", "")
    put(root / "group" / "s" / "device.1.log.gz", "x")
    put(root / "group" / "s" / ".tmp" / "device.log", "unfinished")
    put(root / "flat" / ".acme-window-ack.device.1", "id")

    def poll():
        found = stream_landing_zone(spark, [str(root) + "/"], landing.CONTROL_FILES, resting_ms)
        run(found.writeStream.format("parquet").option("path", str(out)), tmp_path / "checkpoint")

    poll()
    first = [".acme-window-ack.device.1", "device.1.log"]
    start = [f"flat/{n}" for n in first] + ["group/s/.tmp/device.log", "group/s/device.1.log.gz"]
    assert names(spark, out) == start
    assert [r.content for r in spark.read.parquet(str(out)).where("name LIKE '.acme%'").collect()] == ["id"]
    poll()
    assert names(spark, out) == start
    time.sleep(0.2)
    # An old time, as a file published late has; the directory's own time tells of it.
    os.utime(put(root / "group" / "s" / "device.2.log", ""), (1, 1))
    put(root / "group" / "t" / "scope.1.log", "")
    put(root / "flat" / ".acme-window-ack.device.1", "longer")
    poll()
    time.sleep(0.2)
    poll()
    assert names(spark, out) == sorted([*start, "flat/.acme-window-ack.device.1", "group/s/device.2.log", "group/t/scope.1.log"])
    windows = stream_listed_windows(spark.read.parquet(str(out)), [str(root)])
    assert sorted((r.session_id, r.channel, r.window_sequence, r.length) for r in windows.collect()) == [
        ("flat", "device", 1, 0), ("s", "device", 1, 1), ("s", "device", 2, 0), ("t", "scope", 1, 0)]


def test_a_resting_session_is_not_opened_again(spark, tmp_path):
    root, out = tmp_path / "zone", tmp_path / "out"
    put(root / "group" / "s" / "device.1.log", "")

    def poll():
        found = stream_landing_zone(spark, [str(root)], resting_ms=1)
        run(found.writeStream.format("parquet").option("path", str(out)), tmp_path / "checkpoint")

    old = time.time() - 100
    os.utime(root / "group" / "s", (old, old))
    poll()
    put(root / "group" / "s" / "device.2.log", "")
    os.utime(root / "group" / "s", (old, old))  # as if nothing had changed
    poll()
    assert names(spark, out) == ["group/s/device.1.log"]
    os.utime(root / "group" / "s")
    poll()
    assert names(spark, out) == ["group/s/device.1.log", "group/s/device.2.log"]


def test_a_group_of_many_sessions_is_spread_and_old_ones_stay_closed(spark, tmp_path):
    for n in range(400):
        put(tmp_path / "group" / f"s{n}" / "device.1.log", "")
    old = time.time() - 1000
    for n in range(300):
        os.utime(tmp_path / "group" / f"s{n}", (old, old))
    found = landing.scan_landing_zone(spark, [str(tmp_path)])
    opened = found.where("NOT is_dir").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in opened) == 400 and len(opened) == 8 and max(r["count"] for r in opened) < 100
    since = int((old + 500) * 1000)
    recent = landing.scan_landing_zone(spark, [str(tmp_path)], since_ms=since)
    assert recent.where("NOT is_dir").count() == 100 and recent.where("is_dir").count() == 401


def test_no_folders_and_folders_that_are_not_there(spark, tmp_path):
    assert landing.scan_landing_zone(spark, []).count() == 0
    assert landing.scan_landing_zone(spark, [str(tmp_path / "none")]).count() == 0
