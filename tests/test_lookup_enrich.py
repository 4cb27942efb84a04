from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tests.model import SPEC, frame, record
from tidelog.functions.stored_text import from_stored_text, to_stored_text
from tidelog.operators import enrich, lookup
from tidelog.operators import versioned_lookup as vl
from tidelog.operators.parse import parse_changes

SCHEMA = StructType([StructField("A", StringType()), StructField("B", LongType())])


def store(spark, hashes):
    rows = [(f"T:{k}", f, v) for k, fields in hashes.items() for f, v in fields.items()]
    return spark.createDataFrame(rows, "rk string, field string, value string")


def test_versioned_lookup_statuses(spark):
    changes = parse_changes(frame(spark, [
        record(1, "U", 9, A="x"), record(1, "U", 10, A="y"),
        record(2, "U", 11, A="x"), record(3, "U", 12, A="x"), record(4, "I", 13, A="x"),
        record(5, "I", 14, A="x"), record(6, "U", 15, A="x"), record(6, "tombstone", 16),
        record(7, "I", 17, A="x")]), SPEC)
    kv = store(spark, {
        1: {"A": "y", "B": "None", "KFK_OFFSET": "10"}, 2: {"A": "o", "KFK_OFFSET": "10"},
        3: {"A": "o"}, 4: {"A": "n", "KFK_OFFSET": "3"}, 6: {"A": "n", "KFK_OFFSET": "99"},
        7: {"OTHER": "1"}})
    got = vl.versioned_lookup(changes, kv, "T", ["ID"], SCHEMA)
    assert {r.ID: (r.status, r.A, r.B) for r in got.collect()} == {
        1: ("ok", "y", None), 2: ("stale", None, None), 3: ("unversioned", None, None),
        4: ("ok", "n", None), 5: ("missing", None, None), 7: ("ok", None, None)}
    assert {r.ID for r in vl.ready_rows(got, ["ID"], SCHEMA).collect()} == {1, 4, 7}
    plain = vl.lookup_keys(changes, kv, "T", ["ID"], SCHEMA)
    assert {r.ID for r in plain.collect()} == {1, 2, 3, 4, 6, 7}


def test_pending_keys_are_retried_then_dropped_or_fail(spark):
    changes = parse_changes(frame(spark, [record(1, "I", 1, A="x"), record(2, "U", 2, A="x")]), SPEC)
    kv = store(spark, {2: {"A": "o", "KFK_OFFSET": "1"}})
    got = vl.versioned_lookup(changes, kv, "T", ["ID"], SCHEMA)
    at = [datetime(2024, 1, 1, 0, n, tzinfo=timezone.utc) for n in range(3)]
    first = vl.waiting_rows(got, ["ID"], None, at[0])
    second = vl.waiting_rows(got, ["ID"], first, at[1])
    assert {(r.ID, r.status, r.attempts) for r in second.collect()} == {(1, "missing", 2), (2, "stale", 2)}
    assert vl.pending_rows(second, ["ID"], at[1], 120).count() == 2 and vl.expired_rows(second, at[1], 120).isEmpty()
    third = vl.waiting_rows(got, ["ID"], second, at[2])
    with pytest.raises(Exception, match="stale"):
        vl.pending_rows(third, ["ID"], at[2], 120).collect()
    assert vl.pending_rows(third.filter("ID = 1"), ["ID"], at[2], 120).isEmpty()
    assert [r.ID for r in vl.expired_rows(third, at[2], 120).collect()] == [1]


def test_newer_change_starts_waiting_anew(spark):
    kv = store(spark, {1: {"A": "o", "KFK_OFFSET": "1"}})
    found = [vl.versioned_lookup(parse_changes(frame(spark, [record(1, "U", offset, A="x")]), SPEC), kv, "T", ["ID"], SCHEMA)
             for offset in (5, 99)]
    at = [datetime(2024, 1, 1, 0, n, tzinfo=timezone.utc) for n in range(2)]
    old = vl.waiting_rows(found[0], ["ID"], vl.waiting_rows(found[0], ["ID"], None, at[0]), at[0])
    new = vl.waiting_rows(found[1], ["ID"], old, at[1])
    assert [(r.KFK_OFFSET, r.attempts) for r in new.collect()] == [(99, 1)]
    assert vl.pending_rows(new, ["ID"], at[1], 60).count() == 1


def test_stored_text_round_trip(spark):
    df = spark.sql("SELECT timestamp_millis(1700000000123) AS t, timestamp_millis(-5) AS u, "
                   "CAST(NULL AS bigint) AS n, 'None' AS s, 'oops' AS bad")
    row = df.select(to_stored_text(F.col("t"), TimestampType()).alias("t"),
                    to_stored_text(F.col("u"), TimestampType()).alias("u"),
                    to_stored_text(F.col("n"), LongType()).alias("n"), "s", "bad")
    assert tuple(row.first()) == ("1700000000123", "-5", "None", "None", "oops")
    back = row.select(F.unix_millis(from_stored_text(F.col("t"), TimestampType())),
                      F.unix_millis(from_stored_text(F.col("u"), TimestampType())),
                      from_stored_text(F.col("n"), LongType()), from_stored_text(F.col("s"), StringType()),
                      from_stored_text(F.col("bad"), LongType())).first()
    assert tuple(back) == (1700000000123, -5, None, None, None)


def test_semi_join_lookup_with_hot_and_null_keys(spark):
    target = spark.createDataFrame([(1 if i % 3 else None, i, "a'b") for i in range(90)] + [(2, 90, "z")],
                                   "k bigint, v bigint, s string")
    sensors = spark.createDataFrame([(1, "a'b"), (1, "a'b"), (None, "a'b"), (3, "z")], "key bigint, txt string")
    one = lookup.semi_join_lookup(target, sensors, {"key": "k"}, ["v"])
    assert {r.v for r in one.collect()} == {i for i in range(90) if i % 3}
    two = lookup.semi_join_lookup(target, sensors, {"key": "k", "txt": "s"}, ["v"])
    assert two.count() == 60
    none = lookup.semi_join_lookup(target, sensors.limit(0), {"key": "k"}, ["v", "s"])
    assert none.columns == ["v", "s"] and none.isEmpty()


def test_query_with_frames(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, x string")
    two = spark.createDataFrame([(1, 10)], "id bigint, y bigint")
    got = lookup.query_with_frames(
        spark, "SELECT df1.id, df1.x, y FROM df1 JOIN df2 ON df1.id = df2.id JOIN big ON big.id = df1.id",
        one, two, big=one)
    assert [tuple(r) for r in got.collect()] == [(1, "a", 10)]
    empty = lookup.query_with_frames(spark, "SELECT * FROM df1", one.limit(0))
    assert empty.isEmpty() and empty.columns == ["id", "x"]


def test_mapping_reload(spark):
    old = spark.createDataFrame([("a", 1), (None, 9), ("a", 3)], "k string, v bigint")
    mapping = lookup.mapping_max(old, "k", "v")
    assert [tuple(r) for r in mapping.collect()] == [("a", 3)]
    kept = lookup.reload_or_keep(mapping.limit(0), mapping, ["k"])
    assert kept is mapping
    fresh = lookup.reload_or_keep(spark.createDataFrame([("b", 2)], "k string, v bigint"), mapping, ["k"], 2)
    assert [tuple(r) for r in fresh.collect()] == [("b", 2)] and fresh.is_cached
    fresh.unpersist()


def test_enrichment(spark):
    changes = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "null", None), (2, "set", 0)],
                                    "k bigint, v string, KFK_OFFSET bigint")
    view = spark.createDataFrame([(1, "w"), (2, "u")], "k bigint, w string")
    assert {tuple(r) for r in enrich.enrich_latest(changes, view, ["k"]).select("k", "v", "w").collect()} == {
        (1, "new", "w"), (2, "set", "u")}
    touched = spark.createDataFrame([(1, 1), (1, 1), (2, 5), (3, 1)], "a bigint, b bigint")
    assert {tuple(r) for r in enrich.vanished_keys(
        touched, spark.createDataFrame([(1, 1)], "a bigint, b bigint"), ["a", "b"]).collect()} == {(2, 5), (3, 1)}
    stamped = enrich.with_load_time(view, "2024-11-11 00:00:00").first()
    assert str(stamped.LOADED_AT).startswith("2024-11-1") and "LOADED_AT" in enrich.with_load_time(view).columns
    row = spark.sql("SELECT timestamp'2024-11-11 01:02:03' AS t, 'Jack' AS n").select(
        enrich.compact_time(F.col("t")), enrich.category_code(F.col("n"), "J%", "02", "01"), enrich.category_code(F.lit("jim"), "J%", "02", "01"))
    assert tuple(row.first()) == ("20241111010203", "02", "01")
