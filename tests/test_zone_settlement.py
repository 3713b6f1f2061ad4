import os
import shutil

import pytest
from pyspark.sql import functions as F

from logharbor.plans.zone_settlement import settlement_poll
from logharbor.session import materialize
from logharbor.sources import landing
from tests.test_files import put

T0 = 2_000_000_000_000


@pytest.fixture
def poll(spark, tmp_path):
    root, last = tmp_path / "zone", [None]

    def at(now, owner="UNOWNED", sent=1):
        entries = landing.scan_landing_zone(spark, [str(root)], landing.CONTROL_FILES)
        sessions = spark.createDataFrame([(str(root), "s", ["device"])], "folder string, session_id string, log_types array<string>")
        cursors = spark.createDataFrame([(str(root), "s", "device", sent + 1)], "folder string, session_id string, channel string, file_index long")
        owners = spark.createDataFrame([(str(root), "s", owner)] if owner else [], "folder string, session_id string, owner_state string")
        states = settlement_poll(entries, sessions, cursors, owners, "acme", F.lit(T0 + now), last[0])
        last[0] = materialize(states, "states")
        (row,) = last[0].collect()
        return row.state

    put(root / "s" / "device.1.log", "x")
    return root, at


def test_a_closed_channel_finishes_after_the_grace(poll):
    _, at = poll
    assert [at(0), at(4_499), at(4_500)] == ["waiting", "waiting", "finished_clean"]


def test_a_straggler_is_sent_and_starts_the_grace_anew(poll):
    root, at = poll
    assert at(0) == "waiting"
    put(root / "s" / "device.2.log", "")
    assert at(4_000) == "draining"
    assert [at(5_000, sent=2), at(9_000, sent=2), at(9_500, sent=2)] == ["waiting", "waiting", "finished_clean"]


def test_an_acknowledged_window_without_payload_is_still_to_be_passed(poll):
    root, at = poll
    put(root / "s" / ".acme-window-ack.device.2", "id")
    assert at(10_000) == "draining"


def test_an_owner_or_an_unknown_one_keeps_it_waiting_and_starts_the_grace_anew(poll):
    _, at = poll
    assert [at(0), at(3_000, "ACTIVE"), at(5_000), at(9_400), at(9_500)] == ["waiting"] * 4 + ["finished_clean"]
    assert at(20_000, None) == "waiting"


def test_a_working_directory_is_orphaned_when_stale_or_unowned(poll):
    root, at = poll
    log = put(root / "s" / ".tmp" / "device.log", "live")
    for path in (log, root / "s" / ".tmp"):
        os.utime(path, (T0 / 1000, T0 / 1000))
    legacy = "LEGACY_NO_LOCK"
    assert [at(30_000, legacy), at(30_001, legacy), at(30_001, "ACTIVE"), at(0)] == [
        "waiting", "finished_orphaned", "waiting", "finished_orphaned"]
    shutil.rmtree(root / "s" / ".tmp")
    assert [at(40_000, legacy), at(44_500, legacy)] == ["waiting", "finished_clean"]


def test_a_lost_window_ends_the_channel(poll):
    root, at = poll
    put(root / "s" / ".acme-transport-loss.agent-device.2.json", "{}")
    assert at(0, "ACTIVE") == "finished_orphaned"
