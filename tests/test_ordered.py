import random

import numpy as np
import pytest

from logharbor.operators.dedup import ChangeFold, INPUTS, metric_dedup
from logharbor.operators.packing import PackFold, pack_batches
from tests.models import keep_changed, pack

SAMPLE = (
    "session_id string, device_id int, row_no bigint, ts_ms bigint, gpu_util int, mem_util int, "
    "temp_c int, power_mw int, used_mib bigint, clock_sm int"
)


def sample_rows(rng, n, idle, step):
    rows, ts = [], 0
    for i in range(n):
        ts += rng.choice([0, step, step, 2 * step, 70_000 if rng.random() < 0.01 else step])
        hot = rng.random() < 0.6
        rows.append({
            "session_id": "hot" if hot else f"s{rng.randrange(3)}",
            "device_id": 0 if hot else rng.randrange(4),
            "row_no": i,
            "ts_ms": ts,
            "gpu_util": 5 if rng.random() < idle else rng.randrange(3),
            "mem_util": 1,
            "temp_c": rng.choice([40, 40, 41, 41, 42, 43]),
            "power_mw": rng.choice([0, 100, 105, 110, 111, 122]),
            "used_mib": 512,
            "clock_sm": 1400,
        })
    return rows


@pytest.mark.parametrize("idle,step", [(1.0, 1000), (1.0, 20_000), (0.97, 1000), (0.3, 500)])
def test_metric_dedup_matches_the_sequential_rule(spark, idle, step):
    rows = sample_rows(random.Random(7), 4000, idle, step)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SAMPLE).repartition(5)
    got = {r.row_no for r in metric_dedup(df).collect()}
    assert got == {r["row_no"] for r in keep_changed(rows)}


def test_constant_idle_samples_use_only_the_forced_interval(spark):
    rows = [("s", 0, i, i * 1000, 0, 0, 40, 100, 1, 1) for i in range(2000)]
    got = sorted(r.row_no for r in metric_dedup(spark.createDataFrame(rows, SAMPLE)).collect())
    assert got == list(range(0, 2000, 61))


def test_samples_of_one_instant(spark):
    rows = [("s", 0, i, 5, 0, 0, 40 + i % 3, 100, 1, 1) for i in range(900)]
    dicts = [dict(zip([c.split()[0] for c in SAMPLE.split(", ")], r)) for r in rows]
    got = {r.row_no for r in metric_dedup(spark.createDataFrame(rows, SAMPLE)).collect()}
    assert got == {r["row_no"] for r in keep_changed(dicts)}


def test_change_fold_parts_agree_with_one_run():
    rng = np.random.default_rng(3)
    fold = ChangeFold()
    for trial in range(300):
        n = int(rng.integers(2, 60))
        columns = [np.zeros(n, dtype=np.int64) for _ in INPUTS]
        columns[0] = np.cumsum(rng.integers(0, 30_000, n))
        columns[1] = rng.integers(40, 44, n)
        columns[2] = rng.integers(90, 125, n)
        if trial % 3 == 0:
            columns[3] = rng.integers(0, 2, n) * (rng.random(n) < 0.1)
        cut = int(rng.integers(1, n))
        whole, state = fold.run(columns, None)
        _, entry = fold.run([c[:cut] for c in columns], None)
        collector = fold.collector()
        middle = (cut + n) // 2
        for lo, hi in ((cut, middle), (middle, n)):
            if hi > lo:
                collector.add([c[lo:hi] for c in columns])
        assert fold.advance(entry, np.asarray(collector.table())) == state
        assert whole[0]


def test_pack_fold_parts_agree_with_one_run():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(2, 80))
        sizes = rng.integers(1, 40, n)
        fold = PackFold(int(rng.integers(1, 12)), int(rng.integers(1, 150)))
        whole, state = fold.run([sizes], None)
        assert whole.tolist() == pack(sizes.tolist(), fold.max_lines, fold.max_bytes)
        cut = int(rng.integers(1, n))
        head, entry = fold.run([sizes[:cut]], None)
        collector = fold.collector()
        collector.add([sizes[cut:]])
        assert fold.advance(entry, collector.table()) == state
        assert fold.run([sizes[cut:]], entry)[0].tolist() == whole[cut:].tolist()


@pytest.mark.parametrize("max_lines,max_bytes", [(7, 10_000), (1000, 300), (9, 200), (1, 1)])
def test_pack_batches_matches_the_sequential_rule(spark, max_lines, max_bytes):
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        window = ("s", 1) if rng.random() < 0.5 else (f"s{rng.randrange(3)}", rng.randrange(4))
        rows.append(("f", window[0], "device", window[1], i, "x" * rng.randrange(1, 60)))
    df = spark.createDataFrame(
        rows,
        "folder string, session_id string, channel string, window_sequence bigint, "
        "line_no bigint, line string",
    ).repartition(6)
    got = {r.line_no: r.batch_id for r in pack_batches(df, max_lines, max_bytes).collect()}
    groups = {}
    for row in rows:
        groups.setdefault(row[1:4], []).append(row)
    for group in groups.values():
        expected = pack([len(r[5]) + 1 for r in group], max_lines, max_bytes)
        assert [got[r[4]] for r in group] == expected


def test_leaping_changes_nothing():
    rng = np.random.default_rng(9)
    plain, eager = ChangeFold(), ChangeFold()
    plain.leap_share, eager.leap_share = 10**9, 1
    for trial in range(500):
        n = int(rng.integers(1, 120))
        columns = [np.zeros(n, dtype=np.int64) for _ in INPUTS]
        columns[0] = np.cumsum(rng.integers(0, 30_000, n))
        columns[1] = rng.integers(40, 40 + int(rng.integers(1, 5)), n)
        columns[2] = rng.integers(90, 130, n) * int(rng.integers(0, 2))
        columns[3] = (rng.random(n) < 0.05).astype(np.int64)
        state = None if trial % 3 == 0 else [int(rng.integers(-90_000, 50_000)), 41, int(rng.integers(0, 2)) * 100, 0, 0, 0, 0]
        a, b = plain.run([c.copy() for c in columns], state), eager.run([c.copy() for c in columns], state)
        assert (a[0] == b[0]).all() and a[1] == b[1]


def test_folds_of_nothing(spark):
    empty = spark.createDataFrame([], SAMPLE)
    assert metric_dedup(empty).count() == 0
    lines = spark.createDataFrame(
        [], "folder string, session_id string, channel string, window_sequence bigint, line_no bigint, line string")
    assert pack_batches(lines).count() == 0
