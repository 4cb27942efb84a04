import datetime
import decimal
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StringType, TimestampType

from tests.model import ABSENT, SPEC, frame, record
from tidelog.functions.sentinels import decode_nulls, default_for, encode_nulls
from tidelog.operators.fold import current_rows, fold_changes
from tidelog.operators.parse import flatten, parse_changes, parse_operations, presence_flags, rejected_changes
from tidelog.spec import TableSpec


def test_absent_null_and_value_differ(spark):
    raw = frame(spark, [record(1, "U", 0, A="x"), record(2, "U", 1, A=None), record(3, "U", 2, B=5)])
    rows = {r.ID: r for r in parse_changes(raw, SPEC).collect()}
    assert rows[1].A.v == "x" and rows[1].B is None
    assert rows[2].A is not None and rows[2].A.v is None
    assert rows[3].A is None and rows[3].B.v == 5


def test_tombstone_is_a_delete_of_its_key(spark):
    row = parse_changes(frame(spark, [record(7, "tombstone", 4, partition=3)]), SPEC).first()
    assert (row.ID, row["__OP_TYPE"], row.KFK_PTT, row.KFK_OFFSET) == (7, "D", 3, 4)


def test_types_are_exact(spark):
    spec = TableSpec.of("T", {"K": StringType()}, {
        "D": DecimalType(22, 2), "N": DecimalType(5, 2), "TS": TimestampType(), "OLD": TimestampType(),
        "DAY": DateType(), "S": StringType(), "TXT": TimestampType()})
    value = ('{"payload":{"D":12345678901234567890.12,"N":"-1.28","TS":1700000000123,"OLD":-1,'
             '"DAY":10502,"S":"  padded ","TXT":"2024-01-02 03:04:05.678","__OP_TYPE":"I"}}')
    raw = frame(spark, [('{"payload":{"K":" a:b\'c "}}', value, "t", 0, 0)])
    row = flatten(parse_changes(raw, spec), spec).select(
        "*", F.unix_millis("TS").alias("ms"), F.unix_millis("OLD").alias("old_ms"),
        F.unix_millis("TXT").alias("txt_ms")).first()
    assert row.K == "a:b'c"
    assert row.D == decimal.Decimal("12345678901234567890.12")
    assert row.N == decimal.Decimal("-1.28")
    assert row.ms == 1700000000123 and row.old_ms == -1
    assert row.DAY == datetime.date(1998, 10, 3)
    assert row.S == "padded"
    assert row.txt_ms == 1704164645678


@pytest.mark.parametrize("key,value", [
    ('{"payload":{}}', '{"payload":{"A":"x","__OP_TYPE":"I"}}'),
    ('{"payload":{"ID":1}}', '{"payload":{"A":"x"}}'),
    ('{"payload":{"ID":1}}', "not json"),
    ('{"payload":{"ID":1}}', '{"payload":{"A":"x","__OP_TYPE":"X"}}'),
])
def test_malformed_changes_fail_the_job(spark, key, value):
    raw = frame(spark, [(key, value, "t", 0, 9)])
    with pytest.raises(Exception, match="malformed change"):
        parse_changes(raw, SPEC).collect()
    assert parse_changes(raw, SPEC, strict=False).count() == 1


LENIENT = TableSpec.of("T", {"ID": LongType()}, {"A": StringType(), "N": DecimalType(5, 2), "TS": TimestampType(), "DAY": DateType()})


@pytest.mark.parametrize("key,value,fault", [
    ('{"payload":{"ID":"x"}}', '{"payload":{"A":"x","__OP_TYPE":"I"}}', "key ID"),
    ('{"payload":{}}', '{"payload":{"ID":"y","__OP_TYPE":"I"}}', "key ID"),
    ('{"payload":{"ID":1}}', '{"payload":{"N":"abc","__OP_TYPE":"U"}}', "value N"),
    ('{"payload":{"ID":1}}', '{"payload":{"N":1234.5,"__OP_TYPE":"U"}}', "value N"),
    ('{"payload":{"ID":1}}', '{"payload":{"TS":"yesterday","__OP_TYPE":"U"}}', "value TS"),
    ('{"payload":{"ID":1}}', '{"payload":{"DAY":{"d":1},"__OP_TYPE":"U"}}', "value DAY"),
    ('{"payload":{"ID":1}}', '{"payload":{"A":"x","__OP_TYPE":7}}', "operation"),
    ('{"payload":{"ID":1}}', "cut off", "operation"),
])
def test_unfit_values_stay_without_operation(spark, key, value, fault):
    good = ('{"payload":{"ID":5}}', '{"payload":{"N":null,"A":" x ","__OP_TYPE":"U"}}', "t", 0, 3)
    raw = frame(spark, [(key, value, "t", 2, 9), good])
    rows = {r.KFK_OFFSET: r for r in parse_changes(raw, LENIENT, strict=False).collect()}
    assert rows[9]["__OP_TYPE"] is None and rows[3]["__OP_TYPE"] == "U" and rows[3].N.v is None and rows[3].A.v == "x"
    rejected = rejected_changes(raw, LENIENT).collect()
    assert [tuple(r) for r in rejected] == [(key, value, "t", 2, 9, fault)]
    assert [r.ID for r in current_rows(fold_changes(parse_changes(raw, LENIENT, strict=False), LENIENT), LENIENT).collect()] == [5]
    with pytest.raises(Exception, match=f"malformed change, partition and offset: 2 9 in {fault}"):
        parse_changes(raw, LENIENT).collect()


def test_operations_alone_do_not_look_at_values(spark):
    raw = frame(spark, [('{"payload":{"ID":1}}', '{"payload":{"N":"abc","__OP_TYPE":"U"}}', "t", 2, 9)])
    row = parse_operations(raw, LENIENT).first()
    assert row.asDict() == {"ID": 1, "__OP_TYPE": "U", "KFK_PTT": 2, "KFK_OFFSET": 9}


def test_sentinels_round_trip(spark):
    raw = frame(spark, [record(1, "U", 0, A=None, B=None), record(2, "I", 1, A=None, B=3),
                        record(3, "U", 2, A="v")])
    coded = encode_nulls(parse_changes(raw, SPEC), SPEC)
    rows = {r.ID: (r.A, r.B) for r in coded.collect()}
    assert rows == {1: ("__UPDATE_NULL__", -999999999), 2: (None, 3), 3: ("v", None)}
    back = {r.ID: (r.A, r.B) for r in decode_nulls(coded, ["A", "B"]).collect()}
    assert back == {1: (None, None), 2: (None, 3), 3: ("v", None)}


def test_default_of_a_type_too_narrow_is_refused(spark):
    with pytest.raises(ValueError):
        default_for(DecimalType(5, 2))
    row = spark.range(1).select(default_for(TimestampType()).alias("t"), default_for(DateType()).alias("d"),
                                default_for(LongType()).alias("n")).select(F.unix_millis("t"), "d", "n").first()
    assert tuple(row) == (300000000000, datetime.date(1979, 2, 16), -999999999)


def test_presence_flags(spark):
    raw = frame(spark, [record(1, "U", 0, A=None, B=ABSENT)])
    row = presence_flags(parse_changes(raw, SPEC), SPEC).first()
    assert row.A_present and not row.B_present


def test_each_text_is_parsed_once_and_offsets_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    frame(spark, [record(i, "U", i, A="x") for i in range(5)]).write.parquet(path)
    changes = parse_changes(spark.read.parquet(path), SPEC)
    plan = changes.filter((F.col("__OP_TYPE") == "U") & (F.col("KFK_OFFSET") > 2))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("parseJson(VALUE") == 1
    assert "GreaterThan(offset,2)" in text
    assert plan.count() == 2
    assert json.loads(record(1, "U", 0)[0]) == {"payload": {"ID": 1}}
