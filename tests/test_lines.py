import json

import pytest
from pyspark.sql import functions as F

from logharbor.functions.lines import END_MARK, envelope, event_type, http_event, is_blank, kafka_record
from logharbor.functions.metrics import percent_diff
from logharbor.operators import clean
from logharbor.operators.clean import clean_lines, dedup_lines, malformed_lines
from logharbor.operators.dedup import metric_dedup

LINES = "folder string, session_id string, channel string, window_sequence bigint, line_no bigint, sent_ms bigint, line string"


def frame(spark, texts, channel="system", times=None):
    times = times or [1000 * n for n in range(len(texts))]
    return spark.createDataFrame(
        [("f", "s", channel, 1, n, t, x) for n, (t, x) in enumerate(zip(times, texts))], LINES)


@pytest.mark.parametrize("line,kind", [
    ('{"type":"kernel_event","name":"k1"}', "kernel_event"),
    ("{}", "unknown"), ("[1]", "unknown"), ("7", "unknown"), ("null", "unknown"), ('"x"', "unknown"),
    ('{"type":null}', "unknown"), ('{"type":{"a":1}}', "unknown"), ('{"type":[1]}', "unknown"),
    ('{"type":7}', "7"), ('{"type":true}', "true"), ('{"type":"{x"}', "{x"), ('{"type":"a","type":"b"}', "b"),
    ('[{"type":"z"}]', "unknown"), ('  {"type":"pad"}  ', "pad"), ('{"type":"é\\u0041"}', "éA"),
    ("not-json-at-all", None), ("{} trailing", None), ("{} {}", None), ("{'a':1}", None), ("01", None), ("NaN", None),
    ("1, 2", None), ("1],[2", None), ('1},{"v":2', None), ('1, "v":2', None), ("", None), ('{"type":"t"', None),
    (f'{{"type":"{END_MARK}"}}', END_MARK), (f'1,"{END_MARK}"', None), (f'1,"{END_MARK}"],[2', None),
])
def test_event_type(spark, line, kind):
    assert spark.createDataFrame([(line,)], "line string").select(event_type(F.col("line"))).first()[0] == kind


def test_blank_and_malformed_lines_are_dropped(spark):
    lines = frame(spark, ['{"type":"a"}', "", "   ", "\t", "not-json-at-all", "[]"])
    assert sorted(r.line for r in clean_lines(lines).collect()) == ["[]", '{"type":"a"}']
    assert [r.line for r in malformed_lines(lines).collect()] == ["not-json-at-all"]
    assert lines.where(is_blank(F.col("line"))).count() == 3


def test_records(spark):
    text = '{"type":"a","s":"q\\"é\\n"}'
    row = frame(spark, [text]).withColumn("e", envelope(F.col("line"), F.lit("a"), F.lit(5), "h", "i")).select(
        *kafka_record(F.col("line"), F.col("channel")), *http_event(F.col("e"), F.col("channel"), "http://x/")).first()
    assert (row.topic, row.key) == ("gpu-trace", "system")
    assert row.value.startswith('"') and json.loads(row.value) == text
    assert row.url == "http://x/api/v1/events/a"
    assert json.loads(row.body) == {"agentSendingTime": 5, "data": text, "type": "a", "hostname": "h", "ipAddr": "i"}
    assert row.headers == {"Content-Type": "application/json", "X-Topic": "gpu-trace", "X-Key": "system"}


def batch(rows, columns=("device_id", "gpu_util"), **extra):
    return json.dumps({"type": "device_metric_batch", "columns": list(columns), "rows": rows, **extra},
                      separators=(",", ":"), ensure_ascii=False)


def sent(spark, texts, times=None, channel="system"):
    out = dedup_lines(clean_lines(frame(spark, texts, channel, times)), "sent_ms")
    return [r.line for r in out.orderBy("line_no").collect()]


def test_batches_lose_their_unchanged_rows(spark):
    first = batch([[0, 10], [1, 5]])
    assert sent(spark, [first, first]) == [first]
    assert sent(spark, [first, batch([[0, 20], [1, 5]], host="é")]) == [first, batch([[0, 20]], host="é")]
    assert sent(spark, [first, "{invalid}"]) == [first]


def test_batches_that_cannot_be_compared_pass_unchanged(spark):
    texts = [
        batch([[0, 1], [0, 1]], ("device_id", "temp_c")),
        batch([[0, 1], [2]], ("gpu_util", "device_id")),
        batch([[0, 1], 5]),
        '{"type":"device_metric_batch","columns":["device_id","gpu_util"]}',
        '{"type":"device_metric_batch","columns":["device_id","gpu_util"],"rows":7}',
        '{"type":"scope_event"}',
    ]
    assert sent(spark, texts + texts) == texts + texts


def test_dedup_is_for_its_channel_only(spark):
    text = batch([[0, 1]])
    assert sent(spark, [text, text], channel="device") == [text, text]


def test_empty_batches_are_dropped_and_short_rows_filled_with_zero(spark):
    wide = ("device_id", "gpu_util", "mem_util")
    assert sent(spark, [batch([])]) == []
    assert sent(spark, [batch([[0, 1]], wide), batch([[0, 1, 0]], wide)]) == [batch([[0, 1]], wide)]


SAMPLE = ("session_id string, device_id int, row_no bigint, ts_ms bigint, gpu_util int, mem_util int, "
          "temp_c int, power_mw int, used_mib bigint, clock_sm int")


@pytest.mark.parametrize("times,temps,powers,kept", [
    ([0, 60_000], [40, 40], [100, 100], [0]),
    ([0, 60_001], [40, 40], [100, 100], [0, 1]),
    ([0, 1, 2, 3], [40, 41, 42, 43], [100] * 4, [0, 2]),
    ([0, 1], [40, 40], [100, 110], [0]),
    ([0, 1], [40, 40], [100, 111], [0, 1]),
    ([0, 1], [40, 40], [100, 89], [0, 1]),
    ([0, 1, 2], [40] * 3, [0, 0, 1], [0, 2]),
    ([0, 1], [40, 40], [-100, 500], [0]),
    ([0, 1], [40, 40], [1, 2_000_000_000], [0, 1]),
])
def test_dedup_boundaries(spark, times, temps, powers, kept):
    rows = [("s", 0, n, t, 1, 1, c, p, 1, 1) for n, (t, c, p) in enumerate(zip(times, temps, powers))]
    assert sorted(r.row_no for r in metric_dedup(spark.createDataFrame(rows, SAMPLE)).collect()) == kept


def test_percent_diff(spark):
    pairs = [(110, 100, 10), (111, 100, 11), (119, 100, 19), (0, 0, 0), (5, 0, 100), (-50, -100, -50)]
    df = spark.createDataFrame(pairs, "a int, b int, want bigint")
    assert df.where(percent_diff(F.col("a"), F.col("b")) != F.col("want")).count() == 0


def test_a_batch_that_cannot_be_written_anew_goes_out_as_it_came(spark):
    lines = ['{"s":"\\ud800","rows":[[1],[2]]}', '{"s":"é","rows":[[1],[2]]}', "[" * 100_000]
    rows = [(t, "rewrite", [1], None) for t in lines]
    summary = spark.createDataFrame(rows, "line string, action string, kept_rows array<int>, batch string")
    got = {r.line for r in clean.repack_metric_batch(summary).collect()}
    assert got == {lines[0], '{"s":"é","rows":[[2]]}', lines[2]}
