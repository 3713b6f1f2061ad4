"""Sources, sessions and their outcome."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import NOW_MS, URL, fixture, oracle
from checks.registry import query
from logharbor.functions import checks as fc
from logharbor.operators import delivery, sessions as ops
from logharbor.plans.settlement import settlement as settle
from logharbor.schemas import SESSION



def now():
    return F.lit(3_000_000)

NOW_SQL = "3000000"


def types(*names):
    return F.array(*map(F.lit, names))


@query(oracle("""SELECT folder, array_to_string(log_types, ',') AS log_types FROM (
  SELECT folder, log_types, row_number() OVER (PARTITION BY folder ORDER BY setting, position) AS n FROM (
    SELECT session_id AS folder, ['device'] AS log_types, 0 AS setting, MIN(k) AS position FROM windows WHERE k % 3 = 0 GROUP BY ALL
    UNION ALL SELECT session_id, ['scope', 'sass'], 1, k FROM windows WHERE k % 11 = 0
    UNION ALL SELECT DISTINCT session_id, ['device', 'scope', 'system', 'sass'], 2, 0 FROM lines)) WHERE n = 1"""))
def union_sources(spark, sf_dir):
    windows = fixture(spark, sf_dir, "windows").withColumn("folder", F.col("session_id"))
    first = windows.where("k % 3 = 0").groupBy("folder").agg(F.min("k").alias("position")).withColumn(
        "log_types", types("device"))
    second = windows.where("k % 11 = 0").select("folder", types("scope", "sass").alias("log_types"),
                                                F.col("k").alias("position"))
    rest = fixture(spark, sf_dir, "lines").select(F.col("session_id").alias("folder")).distinct().select(
        "folder", F.lit(None).cast("array<string>").alias("log_types"), F.lit(0).cast("bigint").alias("position"))
    return ops.union_sources(first, second, rest).select("folder", F.array_join("log_types", ",").alias("log_types"))


@query(oracle("SELECT folder, session_id FROM sessions WHERE NOT starts_with(session_id, 's1')"))
def drop_hidden_dirs(spark, sf_dir):
    named = fixture(spark, sf_dir, "sessions").withColumn(
        "name", F.when(F.col("session_id").startswith("s1"), F.concat(F.lit("."), "session_id")).otherwise(F.col("session_id")))
    return ops.drop_hidden_dirs(named, "name").select(*SESSION)


@query(oracle("SELECT folder, session_id FROM sessions WHERE mtime_ms % 7000 >= 3000"))
def since_cutoff(spark, sf_dir):
    return fixture(spark, sf_dir, "sessions").where(fc.since_cutoff(F.col("mtime_ms") % 7000, 3000)).select(*SESSION)


@query(oracle(f"SELECT folder, session_id, {NOW_SQL} - tmp_mtime_ms > 30000 AS stale FROM sessions"))
def tmp_is_stale(spark, sf_dir):
    return fixture(spark, sf_dir, "sessions").select(*SESSION, fc.tmp_is_stale(now(), F.col("tmp_mtime_ms")).alias("stale"))


@query(oracle("SELECT folder, session_id FROM sessions WHERE owner_state <> 'UNOWNED'"))
def pending_sessions(spark, sf_dir):
    every = fixture(spark, sf_dir, "sessions")
    return ops.pending_sessions(every, every.where("owner_state = 'UNOWNED'")).select(*SESSION)


@query(oracle("SELECT folder, session_id FROM sessions WHERE channels <> 3 AND NOT tmp_present"))
def new_sessions(spark, sf_dir):
    every = fixture(spark, sf_dir, "sessions")
    found = fixture(spark, sf_dir, "windows").join(every.where("channels <> 3"), SESSION, "left_semi")
    return ops.new_sessions(found.select(*SESSION), every.where("tmp_present"))


@query(oracle("""SELECT folder, session_id FROM sessions s WHERE NOT readable
  OR EXISTS (SELECT 1 FROM losses l WHERE l.folder = s.folder AND l.session_id = s.session_id)"""))
def sessions_with_loss(spark, sf_dir):
    return ops.sessions_with_loss(
        fixture(spark, sf_dir, "sessions"), fixture(spark, sf_dir, "losses")).select(*SESSION)


STATE = f"""CASE WHEN has_failure THEN 'finished_orphaned' WHEN next_present THEN 'draining'
  WHEN owner_state IN ('ACTIVE', 'UNKNOWN') THEN 'waiting'
  WHEN tmp_present THEN CASE WHEN owner_state = 'UNOWNED' OR {NOW_SQL} - tmp_mtime_ms > 30000 THEN 'finished_orphaned' ELSE 'waiting' END
  WHEN {NOW_SQL} - quiet_since_ms >= 4500 THEN 'finished_clean' ELSE 'waiting' END"""
STATES = f"states AS (SELECT *, {STATE} AS state FROM channel_rows)"
COMPLETION = """configured AS (SELECT folder, session_id, CAST(COUNT(*) AS BIGINT) AS channels_expected
  FROM channel_rows WHERE channel_rows.session_id <> 's2' GROUP BY ALL UNION ALL SELECT DISTINCT folder, session_id, 9 FROM channel_rows WHERE session_id = 's2'),
completion AS (SELECT folder, session_id, channels_expected, CAST(COUNT(*) FILTER (starts_with(state, 'finished')) AS BIGINT) AS channels_done,
  bool_or(state = 'finished_orphaned') AS orphaned FROM loose JOIN configured USING (folder, session_id) GROUP BY ALL)"""
# Sessions of even number have no channel under way, so that some of them complete.
LOOSE = """loose AS (SELECT * REPLACE (CASE WHEN CAST(substr(session_id, 2, 9) AS INT) % 2 = 0 AND NOT starts_with(state, 'finished')
  THEN 'finished_clean' ELSE state END AS state) FROM states)"""


def states(spark, sf_dir):
    return ops.channel_state(fixture(spark, sf_dir, "channel_rows"), now())


def loose_states(spark, sf_dir):
    even = F.expr("CAST(substr(session_id, 2, 9) AS INT) % 2 = 0")
    done = F.col("state").startswith("finished")
    return states(spark, sf_dir).withColumn(
        "state", F.when(even & ~done, "finished_clean").otherwise(F.col("state")))


def configured(spark, sf_dir):
    own = fixture(spark, sf_dir, "channel_rows").groupBy(*SESSION).agg(F.collect_set("channel").alias("found"))
    more = F.slice(F.concat("found", F.sequence(F.lit(1), F.lit(9)).cast("array<string>")), 1, 9)
    wanted = F.when(F.col("session_id") == "s2", more)
    return own.select(*SESSION, F.coalesce(wanted, F.col("found")).alias("log_types"))


@query(oracle("SELECT folder, session_id, channel, state FROM states", STATES))
def channel_state(spark, sf_dir):
    return states(spark, sf_dir).select(*SESSION, "channel", "state")


@query(oracle("SELECT *, channels_done >= channels_expected AS complete FROM completion", STATES, LOOSE, COMPLETION))
def session_completion(spark, sf_dir):
    return ops.session_completion(loose_states(spark, sf_dir), configured(spark, sf_dir))


SETTLED = """settled AS (SELECT c.folder, c.session_id, orphaned, l.folder IS NOT NULL AS has_loss,
  CASE WHEN l.folder IS NOT NULL THEN 'failed' WHEN orphaned THEN 'pruned' ELSE 'uploaded' END AS outcome, l.folder IS NULL AS complete_signal
  FROM completion c LEFT JOIN (SELECT DISTINCT folder, session_id FROM losses) l USING (folder, session_id)
  WHERE channels_done >= channels_expected)"""


@query(oracle("SELECT * FROM settled", STATES, LOOSE, COMPLETION, SETTLED))
def settle_sessions(spark, sf_dir):
    completion = ops.session_completion(loose_states(spark, sf_dir), configured(spark, sf_dir))
    return ops.settle_sessions(completion, fixture(spark, sf_dir, "losses"), prune_failed=True)


@query(oracle("""SELECT folder, session_id, 'https://collector.example/api/v1/events/session-complete' AS url
  FROM settled WHERE complete_signal""", STATES, LOOSE, COMPLETION, SETTLED))
def outbox_complete(spark, sf_dir):
    return delivery.outbox_complete(settle_sessions(spark, sf_dir), URL)


ACTIVE = f"tmp_present AND NOT ({NOW_SQL} - tmp_mtime_ms > 30000)"


@query(oracle(f"SELECT bool_or({ACTIVE}) AS any_active FROM sessions"))
def any_active(spark, sf_dir):
    return ops.any_active(fixture(spark, sf_dir, "sessions"), now())


@query(oracle(f"""SELECT *, started_any AND channels_closed AND cleanup_idle AND NOT any_active AS drained FROM (
  SELECT (SELECT COUNT(*) > 0 FROM sessions) AS started_any,
         (SELECT COUNT(*) FILTER (NOT starts_with(state, 'finished')) = 0 FROM states) AS channels_closed,
         (SELECT COUNT(*) = 0 FROM losses WHERE reason = 'none') AS cleanup_idle,
         (SELECT bool_or({ACTIVE}) FROM sessions) AS any_active)""", STATES))
def drain_status(spark, sf_dir):
    every = fixture(spark, sf_dir, "sessions")
    cleanup = fixture(spark, sf_dir, "losses").where("reason = 'none'")
    return ops.drain_status(every, states(spark, sf_dir), cleanup, every, now())


# Channels of even sessions have no window left and no owner.
QUIET = """quiet AS (SELECT * REPLACE (CASE WHEN CAST(substr(session_id, 2, 9) AS INT) % 2 = 0 THEN 'UNOWNED' ELSE owner_state END AS owner_state,
  next_present AND CAST(substr(session_id, 2, 9) AS INT) % 2 = 1 AS next_present) FROM channel_rows)"""


@query(oracle("""SELECT folder, session_id, outcome, CASE WHEN complete_signal
  THEN 'https://collector.example/api/v1/events/session-complete' END AS url FROM settled""",
              QUIET, STATES.replace("channel_rows", "quiet").replace("states AS", "loose AS"), COMPLETION, SETTLED))
def settlement(spark, sf_dir):
    even = F.expr("CAST(substr(session_id, 2, 9) AS INT) % 2 = 0")
    quiet = fixture(spark, sf_dir, "channel_rows").withColumns({
        "owner_state": F.when(even, "UNOWNED").otherwise(F.col("owner_state")),
        "next_present": F.col("next_present") & ~even,
    })
    return settle(
        quiet, configured(spark, sf_dir), fixture(spark, sf_dir, "losses"), now(), URL, prune_failed=True)
