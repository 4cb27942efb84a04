"""Keyed store source, pages of a scan, database reads and loads at size."""

import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.operators import hash_store as hs
from tidelog.sinks import jdbc as sink
from tidelog.sources import jdbc as source
from tidelog.sources import kv_source
from tidelog.sources.kv_source import FileKeyedStore, after_prefix

ENTRIES = "rk string, field string, value string, op string"


@pytest.fixture()
def database():
    return {"url": f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true",
            "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture()
def kv(spark, tmp_path):
    kv_source.register(spark)
    return {"store": "tidelog.sources.kv_source:file_store", "root": str(tmp_path / "kv"), "partitions": "4"}


def write(spark, kv, rows, slices=3):
    spark.createDataFrame(rows, ENTRIES).repartition(slices, "rk").write.format("tidelog_kv").options(**kv).mode("append").save()


def read(spark, kv):
    return spark.read.format("tidelog_kv").options(**kv).load()


def entries(df):
    return sorted(tuple(r) for r in df.select("rk", "field", "value").collect())


def test_keyed_source_round_trip(spark, kv):
    assert entries(read(spark, kv)) == []
    write(spark, kv, [(f"T:{i:03d}", f, f"{f}{i}", "set") for i in range(200) for f in ("A", "B")])
    write(spark, kv, [("T:001", None, None, "del"), ("T:001", "A", "again", "set"), ("T:002", "A", None, "hdel"),
                      ("T:003", None, None, "del"), ("U:1", "A", "x", "set")])
    want = {(f"T:{i:03d}", f): f"{f}{i}" for i in range(200) for f in ("A", "B") if i not in (1, 3)}
    del want["T:002", "A"]
    want |= {("T:001", "A"): "again", ("U:1", "A"): "x"}
    want = sorted((k, f, v) for (k, f), v in want.items())
    assert entries(read(spark, kv)) == want
    assert read(spark, kv).rdd.getNumPartitions() == 4
    for condition in ("rk = 'T:005'", "rk IN ('T:001', 'T:150', 'none')", "rk LIKE 'T:01%'", "rk >= 'T:190' AND rk < 'T:195'",
                      "rk > 'T:198'", "rk <= 'T:002' AND field = 'B'", "rk = 'T:005' AND rk IN ('T:006')", "rk IS NULL"):
        assert entries(read(spark, kv).filter(condition)) == entries(spark.createDataFrame(want, "rk string, field string, value string").filter(condition)), condition


def test_conditions_on_the_key_reach_the_store(spark, kv):
    write(spark, kv, [(f"T:{i}", "A", "x", "set") for i in range(50)])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert " Filter (" not in plan(read(spark, kv).filter("rk LIKE 'T:1%'"))
    assert " Filter (" in plan(read(spark, kv).filter("value = 'y'"))
    assert read(spark, kv).filter("rk IN ('T:1', 'T:2')").rdd.getNumPartitions() == 1


def test_failed_write_leaves_nothing_visible(spark, kv):
    write(spark, kv, [("T:1", "A", "old", "set")])
    bad = spark.range(0, 40, 1, 4).select(
        F.concat(F.lit("T:"), "id").alias("rk"), F.lit("A").alias("field"),
        F.when(F.col("id") == 35, F.raise_error(F.lit("lost"))).otherwise("new").alias("value"), F.lit("set").alias("op"))
    with pytest.raises(Exception, match="lost"):
        bad.write.format("tidelog_kv").options(**kv).mode("append").save()
    assert entries(read(spark, kv)) == [("T:1", "A", "old")]


def test_attempt_that_was_not_committed_does_not_count(kv):
    store, rows = FileKeyedStore(kv), lambda v: [pa.table({"rk": ["T:1"], "field": ["A"], "value": [v], "op": ["set"]}).to_batches()[0]]
    lost, kept = store.stage("a" * 32, rows("lost")), store.stage("b" * 32, rows("kept"))
    assert lost == kept == ["T:1"]
    store.publish({"b" * 32: kept})
    assert list(store.scan("", None)) == [("T:1", {"A": "kept"})]
    assert store.hgetall_many(["T:2", "T:1"]) == [{}, {"A": "kept"}]
    store.discard(["a" * 32, "c" * 32])


def test_end_of_a_prefix():
    assert after_prefix("ab") == "ac" and after_prefix("a\U0010ffff") == "b" and after_prefix("") is None
    assert after_prefix("퟿") == ""


def test_pages_of_a_scan(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(f"T:{i:03d}", f, str(i)) for i in range(53) for f in ("A", "B")] + [("U:1", "A", "x")]
    spark.createDataFrame(rows, "rk string, field string, value string").repartition(5).write.parquet(path)
    store = spark.read.parquet(path)
    pages = hs.numbered_pages(store, "T:", 10).collect()
    assert sorted((r.rk, r.field, r.value) for r in pages) == sorted(rows)[:-1]
    assert {r.rk: r.page for r in pages} == {f"T:{i:03d}": i // 10 for i in range(53)}
    after, found = None, []
    while part := sorted(tuple(r) for r in hs.page_after(store, "T:", 10, after).collect()):
        assert len({k for k, _, _ in part}) <= 10
        found, after = found + part, part[-1][0]
    assert found == sorted(rows)[:-1]
    scan = hs.page_after(store, "T:", 10, "T:020")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(rk,T:020)" in scan and "StringStartsWith(rk,T:)" in scan
    assert hs.numbered_pages(store, "none", 10).collect() == []


def test_balanced_splits_of_a_skewed_column(spark, database):
    skewed = spark.range(4000).select("id", F.pow(F.col("id") / 400, F.lit(6)).cast("bigint").alias("w"))
    sink.append(skewed, database, "t")
    strides = source.read_table(spark, database, "t", '"w"', 8)
    balanced = source.read_balanced(spark, database, "t", '"w"', 8)
    sizes = lambda df: sorted(len(p) for p in df.rdd.glom().collect())
    assert sizes(strides)[-1] > 2000
    found = sizes(balanced)
    assert sum(found) == 4000 and found[-1] <= 2 * found[len(found) // 2]
    with_nulls = spark.createDataFrame([(None, 1), (2, 2), (2, 3), (9, 4)], "w bigint, n int")
    sink.append(with_nulls, database, "u")
    assert sorted(r.n for r in source.read_balanced(spark, database, "u", '"w"', 3).collect()) == [1, 2, 3, 4]
    sink.append(with_nulls.limit(0), database, "without_rows")
    assert source.read_balanced(spark, database, "without_rows", '"w"', 3).count() == 0


def test_ranges_cover_keys_with_the_least_over_read(spark):
    values = [1, 2, 3, 50, 51, 400, 1000, 1001, 1003]
    keys = spark.createDataFrame([(v,) for v in [*values, 1, None]], "k bigint").repartition(4)
    assert source.key_ranges(keys, "k", 1) == [(1, 1003)]
    assert source.key_ranges(keys, "k", 3) == [(1, 51), (400, 400), (1000, 1003)]
    assert source.key_ranges(keys, "k", 99) == [(v, v) for v in values]
    assert source.key_ranges(keys.limit(0), "k", 3) == []


def test_many_keys_read_a_part_of_the_table(spark, database):
    sink.append(spark.range(120_000).select("id", (F.col("id") % 7).alias("v")), database, "t")
    keys = spark.range(100_000).filter("id % 20000 < 10000").select(F.col("id").alias("k"))
    found = source.lookup_in_database(spark, database, "t", keys, {"k": '"id"'}, ['"id"', '"v"'], keys_per_query=50)
    assert sorted(r.id for r in found.collect()) == [i for i in range(100_000) if i % 20_000 < 10_000]
    covers = source.key_ranges(keys, "k", 50)
    assert sum(high - low + 1 for low, high in covers) < 60_000 and len(covers) <= 50


def test_keys_without_a_range_are_not_read_silently(spark, database):
    sink.append(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"), database, "t", column_types="k VARCHAR(9)")
    keys = spark.createDataFrame([("a",), ("c",), ("d",)], "key string")
    with pytest.warns(UserWarning, match="one connection"):
        found = source.lookup_in_database(spark, database, "t", keys, {"key": '"k"'}, ['"n"'], max_pushed_keys=1)
    assert [r.n for r in found.collect()] == [1]


def test_load_is_appended_once(spark, database):
    rows = spark.range(100).select("id", F.concat(F.lit("n"), "id").alias("s"))
    types = "s VARCHAR(20)"
    assert sink.append_once(rows, database, "t", "first", column_types=types) == 100
    assert sink.append_once(rows, database, "t", "first", column_types=types) == 0
    assert sink.append_once(rows.filter("id < 5"), database, "t", "sec'ond", column_types=types) == 5
    assert source.read_table(spark, database, "t").count() == 105
    assert source.read_table(spark, database, "t_staging").count() == 0


def test_attempts_that_failed_after_their_commit_add_nothing(spark, database, monkeypatch):
    """The staged rows of a slice written twice, as by a task whose first attempt committed and was lost."""
    rows = spark.range(60).select("id").repartition(3, "id")
    staged = sink._with_attempts

    def repeated(df):
        marked = staged(df)
        return marked.unionByName(marked.filter("slice_no = 1").withColumn("attempt_no", F.col("attempt_no") + 1000))

    monkeypatch.setattr(sink, "_with_attempts", repeated)
    assert sink.append_once(rows, database, "t", "load") == 60
    got = [r.id for r in source.read_table(spark, database, "t").collect()]
    assert sorted(got) == list(range(60))


def test_load_that_was_broken_off_starts_anew(spark, database):
    rows = spark.range(30).select("id")
    with pytest.raises(Exception, match="lost"):
        sink.append_once(rows.repartition(3).withColumn("id", F.when(F.col("id") == 29, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint")),
                         database, "t", "load")
    assert source.read_table(spark, database, "t").count() == 0
    assert sink.append_once(rows, database, "t", "load") == 30
    assert source.read_table(spark, database, "t").count() == 30
