import pytest
from pyspark.sql import functions as F

from logharbor.functions.checks import since_cutoff, tmp_is_stale
from logharbor.operators import sessions, sessions as ops
from logharbor.plans.settlement import settlement

CHANNEL = ("folder string, session_id string, channel string, has_failure boolean, next_present boolean, "
           "tmp_present boolean, tmp_mtime_ms bigint, quiet_since_ms bigint, owner_state string")
NOW = 100_000


def channels(spark, *rows):
    base = dict(has_failure=False, next_present=False, tmp_present=False, tmp_mtime_ms=None, quiet_since_ms=0, owner_state="UNOWNED")
    data = [("f", s, c, *{**base, **change}.values()) for s, c, change in rows]
    return spark.createDataFrame(data, CHANNEL)


@pytest.mark.parametrize("change,state", [
    ({}, "finished_clean"),
    ({"has_failure": True, "next_present": True}, "finished_orphaned"),
    ({"next_present": True}, "draining"),
    ({"tmp_present": True}, "finished_orphaned"),
    ({"tmp_present": True, "owner_state": "ACTIVE", "tmp_mtime_ms": 0}, "waiting"),
    ({"tmp_present": True, "owner_state": "UNKNOWN"}, "waiting"),
    ({"tmp_present": True, "owner_state": "LEGACY_NO_LOCK", "tmp_mtime_ms": NOW - 30_000}, "waiting"),
    ({"tmp_present": True, "owner_state": "LEGACY_NO_LOCK", "tmp_mtime_ms": NOW - 30_001}, "finished_orphaned"),
    ({"owner_state": "ACTIVE"}, "waiting"), ({"owner_state": "UNKNOWN"}, "waiting"),
    ({"owner_state": "LEGACY_NO_LOCK"}, "finished_clean"),
    ({"quiet_since_ms": NOW - 4_499}, "waiting"), ({"quiet_since_ms": NOW - 4_500}, "finished_clean"),
])
def test_channel_state(spark, change, state):
    df = channels(spark, ("s", "device", change))
    assert sessions.channel_state(df, F.lit(NOW)).first().state == state


def configured(spark, *names):
    return spark.createDataFrame([("f", n, ["device", "scope"]) for n in names], "folder string, session_id string, log_types array<string>")


@pytest.mark.parametrize("prune,stream", [(False, True), (True, True), (True, False)])
def test_settlement(spark, prune, stream):
    orphan = {"tmp_present": True}
    rows = channels(
        spark, ("clean", "device", {}), ("clean", "scope", {}), ("crashed", "device", {}), ("crashed", "scope", orphan),
        ("lossy", "device", {}), ("lossy", "scope", orphan), ("busy", "device", {}), ("busy", "scope", {"next_present": True}),
        ("partial", "device", {}))
    losses = spark.createDataFrame([("f", "lossy")], "folder string, session_id string")
    known = configured(spark, "clean", "crashed", "lossy", "busy", "partial")
    got = {r.session_id: (r.outcome, r.url is not None)
           for r in settlement(rows, known, losses, F.lit(NOW), "http://x", stream, prune).collect()}
    assert got == {"clean": ("uploaded", stream), "crashed": ("pruned" if prune else "failed", stream), "lossy": ("failed", False)}


SESSION = "folder string, session_id string, mtime_ms bigint, tmp_present boolean, tmp_mtime_ms bigint"


@pytest.mark.parametrize("row,since,active", [
    (("s", 50, True, NOW), 0, True), (("s", 50, True, NOW - 120_000), 0, False), (("s", 50, False, None), 0, False),
    ((".s", 50, True, NOW), 0, False), (("s", 50, True, NOW), 51, False), (("s", 51, True, NOW), 51, True),
])
def test_any_active(spark, row, since, active):
    df = spark.createDataFrame([("f", *row)], SESSION)
    assert sessions.any_active(df, F.lit(NOW), since).first().any_active is active
    assert sessions.any_active(df.where("false"), F.lit(NOW)).first().any_active is False


def test_drain_status(spark):
    idle = spark.createDataFrame([("f", "s", 50, False, None)], SESSION)
    done = sessions.channel_state(channels(spark, ("s", "device", {})), F.lit(NOW))
    none = idle.where("false")
    row = sessions.drain_status(idle, done, none, idle, F.lit(NOW)).first()
    assert (row.started_any, row.channels_closed, row.cleanup_idle, row.any_active, row.drained) == (True, True, True, False, True)
    assert sessions.drain_status(none, done, none, idle, F.lit(NOW)).first().drained is False
    assert sessions.drain_status(idle, done, idle, idle, F.lit(NOW)).first().drained is False


def test_sources_first_setting_wins(spark):
    schema = "folder string, log_types array<string>, position bigint"
    one = spark.createDataFrame([("a", ["device"], 0)], schema)
    two = spark.createDataFrame([("a", ["scope"], 0), ("b", [], 1), ("c", ["x"], 2), ("c", ["y"], 3)], schema)
    got = {r.folder: r.log_types for r in sessions.union_sources(one, two).collect()}
    assert got == {"a": ["device"], "b": ["device", "scope", "system", "sass"], "c": ["x"]}


def test_session_sets(spark):
    key = "folder string, session_id string"
    every = spark.createDataFrame([("f", "a"), ("f", "b"), ("f", "b"), ("g", "b")], key)
    old = spark.createDataFrame([("f", "a"), ("g", "x")], key)
    assert sorted(map(tuple, sessions.new_sessions(every, old).collect())) == [("f", "b"), ("g", "b")]
    assert sorted(map(tuple, sessions.pending_sessions(every, old).collect())) == [("f", "b"), ("f", "b"), ("g", "b")]
    seen = spark.createDataFrame([("f", "a", True), ("f", "b", True), ("g", "b", None)], key + ", readable boolean")
    assert sorted(r[:2] for r in map(tuple, sessions.sessions_with_loss(seen, old).collect())) == [("f", "a"), ("g", "b")]


def test_cutoffs(spark):
    df = spark.createDataFrame([(30_000, 30_001)], "edge bigint, over bigint")
    row = df.select(tmp_is_stale(F.col("edge"), F.lit(0)), tmp_is_stale(F.col("over"), F.lit(0)),
                    since_cutoff(F.col("edge"), 30_000), since_cutoff(F.col("edge"), 30_001), since_cutoff(F.col("edge"), 0)).first()
    assert tuple(row) == (False, True, True, False, True)


def test_a_finished_channel_that_is_not_configured_settles_nothing(spark):
    states = spark.createDataFrame(
        [("f", "s", "device", "finished_clean"), ("f", "s", "system", "finished_clean"), ("f", "s", "scope", "waiting")],
        "folder string, session_id string, channel string, state string")
    sessions = spark.createDataFrame([("f", "s", ["device", "scope"])], "folder string, session_id string, log_types array<string>")
    row = ops.session_completion(states, sessions).first()
    assert (row.channels_expected, row.channels_done, row.complete) == (2, 1, False)


def test_an_unreadable_session_is_never_uploaded(spark):
    states = spark.createDataFrame([("f", "s", "device", "finished_clean")], "folder string, session_id string, channel string, state string")
    sessions = spark.createDataFrame([("f", "s", ["device"], False)], "folder string, session_id string, log_types array<string>, readable boolean")
    losses = spark.createDataFrame([], "folder string, session_id string")
    row = ops.settle_sessions(ops.session_completion(states, sessions), losses).first()
    assert (row.outcome, row.complete_signal) == ("failed", False)
