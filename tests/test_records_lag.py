import base64
import decimal
import json
import random

import pytest

from tidelog.operators import lag
from tidelog.operators.records import connect_records, json_records
from tidelog.sources.offset_log import read_offset_log


def number(encoded, scale):
    unscaled = int.from_bytes(base64.b64decode(encoded), "big", signed=True)
    return decimal.Decimal(unscaled).scaleb(-scale)


def test_connect_record_of_every_type(spark):
    df = spark.sql("""SELECT 1 AS i, CAST(2 AS BIGINT) AS l, 'q"é' AS s, 1.5D AS d, true AS b,
        date'1969-12-31' AS day, timestamp'2024-01-02 03:04:05.678' AS ts, timestamp_millis(-1) AS old,
        CAST(-1.28 AS DECIMAL(12,2)) AS n, CAST('-12345678901234567890.12' AS DECIMAL(22,2)) AS w,
        CAST(NULL AS STRING) AS gone, CAST(NULL AS DECIMAL(30,4)) AS goneN""")
    row = connect_records(df, "st.TB", ["i"], df.columns).first()
    assert json.loads(row.key) == {
        "schema": {"type": "struct", "optional": False, "name": "st.TB.Key",
                   "fields": [{"field": "i", "type": "int64", "optional": False}]}, "payload": {"i": 1}}
    value = json.loads(row.value)
    fields = {f["field"]: f for f in value["schema"]["fields"]}
    assert value["schema"]["name"] == "st.TB.Value"
    assert fields["l"]["type"] == "int64" and fields["d"]["type"] == "double"
    assert fields["day"] == {"field": "day", "type": "int32", "optional": False,
                             "name": "org.apache.kafka.connect.data.Date", "version": 1}
    assert fields["ts"]["name"] == "org.apache.kafka.connect.data.Timestamp" and fields["ts"]["type"] == "int64"
    assert fields["n"]["parameters"] == {"scale": "2", "connect.decimal.precision": "12"}
    assert fields["gone"]["optional"] is True
    payload = value["payload"]
    assert payload["day"] == -1 and payload["ts"] == 1704164645678 and payload["old"] == -1
    assert payload["n"] == "/////////4A=" and payload["s"] == 'q"é'
    assert number(payload["w"], 2) == decimal.Decimal("-12345678901234567890.12")
    assert payload["gone"] is None and payload["goneN"] is None


@pytest.mark.parametrize("precision,scale", [(18, 4), (19, 0), (38, 0), (38, 20), (38, 38)])
def test_decimal_bytes(spark, precision, scale):
    top = 10 ** precision - 1
    raw = [0, 1, -1, top, -top, 2 ** 31, -2 ** 32, 2 ** 63, -2 ** 63, -2 ** 63 - 1, 2 ** 64, -2 ** 64, 2 ** 64 + 5]
    values = [decimal.Decimal(r).scaleb(-scale, decimal.Context(prec=60)) for r in raw if abs(r) <= top]
    df = spark.createDataFrame([(v,) for v in values], f"v decimal({precision},{scale})")
    got = [json.loads(r.value)["payload"]["v"]
           for r in connect_records(df, "t", value_columns=["v"]).collect()]
    context = decimal.Context(prec=60)
    back = [decimal.Decimal(int.from_bytes(base64.b64decode(g), "big", signed=True)).scaleb(-scale, context)
            for g in got]
    assert back == values


def test_tombstones_and_value_only(spark):
    df = spark.createDataFrame([(1, "x")], "k bigint, v string")
    stone = connect_records(df, "t", ["k"]).first()
    assert stone.value is None and json.loads(stone.key)["payload"] == {"k": 1}
    assert connect_records(df, "t", value_columns=["v"]).columns == ["value"]
    with pytest.raises(ValueError):
        connect_records(df, "t")


def test_plain_json(spark):
    df = spark.createDataFrame([(1, None)], "k bigint, v string")
    assert json_records(df, ["k", "v"], ignore_nulls=True).first().value == '{"k":1}'
    assert json_records(df, ["k", "v"], ignore_nulls=False).first().value == '{"k":1,"v":null}'


def test_offset_log_files(spark, tmp_path):
    for app, topic in (("ONE", "prod.a"), ("TWO", "prod.b")):
        folder = tmp_path / app / "offsets"
        folder.mkdir(parents=True)
        for n in (0, 9, 10):
            (folder / str(n)).write_text(
                'v1\n{"batchWatermarkMs":0,"conf":{"spark.sql.shuffle.partitions":"6"}}\n'
                + json.dumps({topic: {"0": n * 10, "1": n}}))
    got = read_offset_log(spark, str(tmp_path))
    assert {tuple(r) for r in got.collect()} == {
        ("ONE", 10, "prod.a", 0, 100), ("ONE", 10, "prod.a", 1, 10),
        ("TWO", 10, "prod.b", 0, 100), ("TWO", 10, "prod.b", 1, 10)}
    ends = spark.createDataFrame([("prod.a", 0, 130), ("prod.a", 1, 9)], "topic string, partition int, end_offset bigint")
    assert {(r.app, r.partition, r.lag) for r in lag.consumer_lag(got, ends).collect()} == {
        ("ONE", 0, 30), ("ONE", 1, 0), ("TWO", 0, None), ("TWO", 1, None)}
    more = spark.createDataFrame([("prod.a", 0, 130), ("prod.a", 2, 7), ("prod.c", 0, 4)], ends.schema)
    assert {(r.app, r.topic, r.partition, r.committed, r.lag) for r in lag.consumer_lag(got.filter("app = 'ONE'"), more).collect()} == {
        ("ONE", "prod.a", 0, 100, 30), ("ONE", "prod.a", 1, 10, None), ("ONE", "prod.a", 2, None, 7), (None, "prod.c", 0, None, 4)}


def test_lag_totals(spark):
    df = spark.createDataFrame([("c", "t1", 5), ("c", "t1", 6), ("c", "t2", 1), ("d", "t1", 2)],
                               "consumer string, topic string, current_lag bigint")
    assert {tuple(r) for r in lag.lag_by_topic(df).collect()} == {
        ("c", "t1", False, 11), ("c", "t2", False, 1), ("c", None, True, 12),
        ("d", "t1", False, 2), ("d", None, True, 2)}


def brute_runs(samples, max_gap):
    out, last = {}, {}
    for consumer, no, status in sorted(samples):
        before = last.get(consumer)
        same = before and before[1] == status and (max_gap is None or no - before[0] <= max_gap)
        run = before[2] + 1 if same else 1
        last[consumer] = (no, status, run)
        out[(consumer, no)] = run
    return out


@pytest.mark.parametrize("block,max_gap", [(3, None), (7, 1), (1000, 2), (1, 1)])
def test_runs_across_blocks(spark, block, max_gap):
    rng = random.Random(block)
    samples, status = [], "OK"
    for consumer in ("hot", "other"):
        for no in range(150 if consumer == "hot" else 20):
            if rng.random() < 0.1:
                continue
            if rng.random() < 0.2:
                status = rng.choice(["OK", "ERR", "WARN", "STOP", "STALL"])
            samples.append((consumer, no, status))
    df = spark.createDataFrame(samples, "consumer string, sample_no bigint, status string")
    got = {(r.consumer, r.sample_no): r.run for r in lag.status_runs(df, max_gap, block).collect()}
    expected = brute_runs(samples, max_gap)
    assert got == expected
    alarms = {(r.consumer, r.sample_no) for r in lag.lag_alerts(df, max_gap, block=block).collect()}
    status_of = {(c, n): s for c, n, s in samples}
    assert alarms == {k for k, run in expected.items()
                      if status_of[k] != "OK" and (run == 1 or run % 5 == 0)}


def test_alert_texts(spark):
    df = spark.createDataFrame([("c", i, "STOP") for i in range(1, 131)], "consumer string, sample_no bigint, status string")
    text = {r.run: (r.status_text, r.elapsed) for r in lag.lag_alerts(df).collect()}
    assert text[1] == ("status needs a check", "first occurrence")
    assert text[5][1] == "5m elapsed" and text[125][1] == "2h 5m elapsed" and 6 not in text
