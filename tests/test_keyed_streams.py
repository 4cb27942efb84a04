"""Streams with keyed state: seeded sync, lookups woken by the store, lag alarms, progress records."""

import time
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tests.model import SPEC, as_rows, frame, record, replay
from tidelog.operators.fold import ALIVE, lift_changes, lift_rows
from tidelog.operators.lag import lag_alerts
from tidelog.operators.parse import parse_changes
from tidelog.plans import catalog
from tidelog.sources.change_stream import file_stream
from tidelog.streaming.alerts import SILENT, stream_lag_alerts
from tidelog.streaming.micro_batch import run_micro_batches
from tidelog.streaming.progress import ProgressRecords, observed_step
from tidelog.spec import OFFSET, PARTITION, TableSpec
from tidelog.streaming import stateful
from tidelog.streaming.stateful import _flat, _reduced, state_rows, stateful_sync
from tidelog.streaming.wakeup import fail_on_stale, lookup_wakeups

NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
COLUMNS = StructType([StructField("A", StringType()), StructField("B", LongType())])
STORED = "ID bigint, KFK_OFFSET bigint, __gone boolean, A string, B bigint"
ASKED = "ID bigint, __OP_TYPE string, KFK_OFFSET bigint"


@pytest.fixture(autouse=True)
def no_empty_batches(spark):
    spark.conf.set(NO_DATA, "false")
    yield
    spark.conf.unset(NO_DATA)


def deliver(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def drain(rows, checkpoint):
    """Rows of every batch of what is there."""
    got = []
    run_micro_batches(rows, lambda df, n: got.append(df.collect()), checkpoint).awaitTermination()
    return got


def test_seeded_state_is_the_image(spark, tmp_path):
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "cp")
    first = [record(i, "I", i, partition=i % 2, A=f"a{i}", B=2**60 + i) for i in range(6)]
    later = [record(1, "U", 10, partition=1, A=None), record(2, "tombstone", 11), record(9, "I", 12, partition=1, B=5),
             record(3, "U", 2, partition=1, A="older")]
    image = spark.createDataFrame([(k, v["A"], v["B"], p, o) for k, (v, p, o) in replay(first).items()],
                                  "ID bigint, A string, B bigint, KFK_PTT int, KFK_OFFSET bigint")
    deliver(frame(spark, later), topic)
    rows = stateful_sync(parse_changes(file_stream(spark, topic), SPEC), SPEC, image=image)
    emitted = {r.ID: r for batch in drain(rows, checkpoint) for r in batch}
    assert set(emitted) == {1, 2, 9} and not emitted[2][ALIVE] and emitted[1].B == 2**60 + 1
    assert as_rows(state_rows(spark, checkpoint, SPEC).filter(ALIVE)) == replay(first + later[:3])
    assert state_rows(spark, checkpoint, SPEC).count() == 7


def test_deleted_keys_are_forgotten(spark, tmp_path):
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "cp")
    deliver(frame(spark, [record(1, "I", 0, A="x"), record(2, "I", 1, A="y"), record(3, "I", 2, A="z")]), topic)
    deliver(frame(spark, [record(1, "tombstone", 5), record(2, "tombstone", 6)]), topic)
    deliver(frame(spark, [record(2, "I", 7, A="again")]), topic)
    deliver(frame(spark, [record(3, "U", 8, B=1)]), topic)
    rows = stateful_sync(parse_changes(file_stream(spark, topic), SPEC), SPEC, keep_deleted=0.001)
    drain(rows, checkpoint)
    held = {r.ID: r[ALIVE] for r in state_rows(spark, checkpoint, SPEC).collect()}
    assert held == {2: True, 3: True}


def test_keys_share_the_groups_of_the_state(spark, tmp_path, monkeypatch):
    """Forty keys in three groups, whose seed and changes come in frames of four rows."""
    monkeypatch.setattr(stateful, "BUCKETS", 3)
    topic, checkpoint = str(tmp_path / "topic"), str(tmp_path / "cp")
    first = [record(2**60 + i, "I", i, partition=i % 2, A=f"a{i}", B=i) for i in range(30)]
    later = [[record(2**60 + i, "U", 100 + i, B=2**60 + i) for i in range(20, 40)],
             [record(2**60 + i, "tombstone", 200 + i) for i in range(15, 25)] + [record(2**60 + 30, "U", 50, A="late")]]
    image = spark.createDataFrame([(k, v["A"], v["B"], p, o) for k, (v, p, o) in replay(first).items()],
                                  "ID bigint, A string, B bigint, KFK_PTT int, KFK_OFFSET bigint")
    for part in later:
        deliver(frame(spark, part), topic)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        drain(stateful_sync(parse_changes(file_stream(spark, topic), SPEC), SPEC, image=image), checkpoint)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    held = state_rows(spark, checkpoint, SPEC)
    assert as_rows(held.filter(ALIVE)) == replay(first + later[0] + later[1]) and held.count() == 40
    groups = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", stateful.STATE).load()
    assert 1 <= groups.select("key").distinct().count() <= 3


class MapOfState(dict):
    """A map of the state held in memory."""

    exists, getValue, updateValue, removeKey = dict.__len__, dict.get, dict.__setitem__, lambda self, key: self.pop(key, None)
    iterator = lambda self: iter(self.items())


def test_a_group_emits_one_frame_and_forgets_each_key_in_its_time():
    maps, timers = {}, set()
    handle = SimpleNamespace(getMapState=lambda name, *_: maps.setdefault(name, MapOfState()), listTimers=lambda: iter(timers),
                             registerTimer=timers.add, deleteTimer=timers.discard)
    at = lambda ms: SimpleNamespace(getCurrentProcessingTimeInMs=lambda: ms, getExpiryTimeInMs=lambda: ms)
    sync = stateful.KeyedSync(SPEC, keep_deleted=1)
    sync.init(handle)

    def change(key, offset, deleted, a=None):
        live = stateful.NEVER if deleted else offset
        return {"x_bucket": 0, "x_k_0": key, PARTITION: 0, OFFSET: offset, "x_deleted_at": offset if deleted else stateful.NEVER,
                "x_live_at": live, "x_at_0": live, "x_v_0": a, "x_at_1": stateful.NEVER, "x_v_1": None}

    def batch(ms, *changes):
        return [[tuple(r)[:3] for r in f.itertuples(index=False)] for f in sync.handleInputRows((0,), iter([pd.DataFrame(changes)]), at(ms))]

    def expire(ms):
        assert timers and min(timers) <= ms
        due = min(timers)
        assert list(sync.handleExpiredTimer((0,), at(ms), at(due))) == []
        timers.discard(due)
        return {key for key, in maps[stateful.STATE]}

    assert batch(0, *[change(k, i, False, k) for i, k in enumerate("abcd")]) == [[(k, True, k) for k in "abcd"]]
    assert timers == set()
    assert batch(100, change("a", 10, True), change("b", 11, True)) == [[("a", False, None), ("b", False, None)]]
    assert batch(500, change("c", 12, True), change("b", 13, False, "back"), change("d", 3, False, "d")) == [
        [("c", False, None), ("b", True, "back")]]
    assert expire(1100) == {"b", "c", "d"} and timers == {1500}
    assert expire(1500) == {"b", "d"} and timers == set()


def test_keys_of_the_hour_that_comes_twice_stay_apart(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spec = TableSpec.of("T", {"ID": TimestampType()}, {"A": StringType()})
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.sql("SELECT timestamp_seconds(1730610000 + 3600 * id) AS ID, 'x' AS A, 0 AS KFK_PTT, id AS KFK_OFFSET FROM range(3)")
        flat = _flat(lift_rows(rows, spec), spec)
        back = flat.select(F.unix_seconds(stateful._typed(F.col("x_k_0"), TimestampType())).alias("s"))
        assert sorted(r.s - 1730610000 for r in back.collect()) == [0, 3600, 7200] and flat.select("x_k_0").distinct().count() == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_hot_key_reaches_the_state_as_few_rows(spark):
    log = parse_changes(frame(spark, [record(1, "U", i, A=f"v{i}") for i in range(500)] + [record(1, "U", 600, B=3)]).coalesce(1), SPEC)
    reduced = _reduced(_flat(lift_changes(log, SPEC), SPEC), SPEC).collect()
    assert len(reduced) == 1 and reduced[0][OFFSET] == 600
    assert (reduced[0]["x_at_0"], reduced[0]["x_v_0"], reduced[0]["x_at_1"], reduced[0]["x_v_1"]) == (499, "v499", 600, "3")


def test_one_file_of_a_log_is_read_by_many_tasks(spark):
    """A row group is read by one task: half a million changes in a single file must not be one."""
    rows = spark.range(500_000).select(
        F.format_string('{"payload":{"ID":%d}}', "id").alias("KEY"), F.format_string('{"payload":{"A":"%s"}}', F.sha1(F.hex("id"))).alias("VALUE"),
        F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"), F.col("id").alias("offset"))
    path = catalog._log_files(spark, rows, 1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    try:
        log = spark.read.parquet(path)
        shares = [r["count"] for r in log.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(log.inputFiles()) == 1 and sum(shares) == 500_000 and max(shares) <= 250_000
    assert log.agg(F.sum("offset")).first()[0] == 500_000 * 499_999 // 2


def wakeups(spark, tmp_path, seed, batches, max_wait=3600.0):
    """Outcomes per batch of (changes, store updates)."""
    asked, stored = str(tmp_path / "asked"), str(tmp_path / "stored")
    empty = [spark.createDataFrame([], schema) for schema in (ASKED, STORED)]
    for df, path in zip(empty, (asked, stored)):
        df.write.parquet(path)
    stream = lambda path, like: spark.readStream.schema(like.schema).parquet(path)
    rows = lookup_wakeups(stream(asked, empty[0]), stream(stored, empty[1]), ["ID"], COLUMNS,
                          spark.createDataFrame(seed, STORED), max_wait)
    got = []
    for changes, updates in batches:
        for part, path, schema in ((changes, asked, ASKED), (updates, stored, STORED)):
            if part:
                deliver(spark.createDataFrame(part, schema), path)
        got.append(sorted((r.ID, r.KFK_OFFSET, r.outcome, r.A, r.B) for batch in drain(rows, str(tmp_path / "cp")) for r in batch))
    return got


def test_waiting_keys_are_woken_by_the_store(spark, tmp_path):
    seed = [(1, 10, False, "a", 2**60), (2, 5, False, "b", 2), (3, None, False, "c", 3)]
    got = wakeups(spark, tmp_path, seed, [
        ([(1, "U", 10), (2, "U", 9), (3, "U", 1), (4, "I", 20), (5, "D", 30), (2, "U", 7)], []),
        ([], [(2, 8, False, "b8", 2), (4, 20, False, "d", 4)]),
        ([(1, "U", 40), (6, "I", 41)], [(2, 9, False, "b9", 2), (3, 1, False, "c1", 3)]),
        ([(6, "D", 50), (1, "I", 51)], [(6, 41, False, "f", 6)]),
    ])
    assert got == [
        [(1, 10, "ok", "a", 2**60)],
        [(4, 20, "late", "d", 4)],
        [(2, 9, "late", "b9", 2), (3, 1, "late", "c1", 3)],
        [(1, 51, "ok", "a", 2**60)],
    ]


def test_what_waits_too_long_is_given_up(spark, tmp_path):
    seed = [(1, 5, False, "a", 1), (2, None, False, "b", 2), (4, 9, False, "d", 4)]
    got = wakeups(spark, tmp_path, seed, [
        ([(1, "U", 10), (2, "U", 10), (3, "I", 10), (4, "U", 9)], []),
        ([(4, "U", 9)], [(9, 1, False, "x", 9), (4, 10, True, None, None)]),
        ([(4, "I", 11)], [(3, 10, False, "late", 3)]),
        ([], [(9, 2, False, "x", 9)]),
    ], max_wait=0.001)
    assert got[0] == [(4, 9, "ok", "d", 4)]
    # the deleted row leaves key 4 waiting anew, as its change came once more
    assert got[1] == [(1, 10, "stale", None, None), (2, 10, "unversioned", None, None), (3, 10, "expired", None, None)]
    assert got[3] == [(4, 11, "expired", None, None)]


def test_a_batch_reads_nothing_of_the_store(spark, tmp_path):
    """Only the inputs' own files are scanned after the first batch: the seed is read once."""
    seed_path = str(tmp_path / "seed")
    spark.createDataFrame([(1, 10, False, "a", 1)], STORED).write.parquet(seed_path)
    asked, stored = str(tmp_path / "asked"), str(tmp_path / "stored")
    for schema, path in ((ASKED, asked), (STORED, stored)):
        spark.createDataFrame([], schema).write.parquet(path)
    changes = spark.readStream.schema(spark.read.parquet(asked).schema).parquet(asked)
    updates = spark.readStream.schema(spark.read.parquet(stored).schema).parquet(stored)
    rows = lookup_wakeups(changes, updates, ["ID"], COLUMNS, spark.read.parquet(seed_path))
    deliver(spark.createDataFrame([(1, "U", 10)], ASKED), asked)
    assert len(drain(rows, str(tmp_path / "cp"))[0]) == 1
    for f in (tmp_path / "seed").iterdir():
        f.unlink()
    deliver(spark.createDataFrame([(7, 1, False, "x", 1)], STORED), stored)
    assert [r for batch in drain(lookup_wakeups(changes, updates, ["ID"], COLUMNS), str(tmp_path / "cp")) for r in batch] == []


def test_stale_outcomes_can_fail_the_job(spark):
    outcomes = spark.createDataFrame([(1, "ok"), (2, "stale")], "ID bigint, outcome string")
    with pytest.raises(Exception, match="hash store still stale for key 2"):
        fail_on_stale(outcomes, ["ID"]).collect()


SAMPLES = "consumer string, sample_no bigint, status string"


def test_alarms_of_a_stream_equal_those_of_the_table(spark, tmp_path):
    path, checkpoint = str(tmp_path / "samples"), str(tmp_path / "cp")
    statuses = ["ERR"] * 12 + ["OK"] + ["WARN"] * 3 + [None] + ["STALL"] * 7 + ["ERR"] * 30
    rows = [(c, n * (1 + (c == "b")) + (50 if n > 40 else 0), s) for c in "ab" for n, s in enumerate(statuses)] + [(None, 1, "ERR"), ("a", None, "ERR")]
    spark.createDataFrame([], SAMPLES).write.parquet(path)
    stream = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(path)
    got = []
    for low, high in ((0, 5), (5, 17), (17, 30), (30, 1000)):
        part = [r for r in rows if r[1] is None or low <= r[1] < high]
        deliver(spark.createDataFrame(part + part[:2], SAMPLES), path)
        got += [tuple(r) for batch in drain(stream_lag_alerts(stream, max_gap=20), checkpoint) for r in batch]
    want = lag_alerts(spark.createDataFrame(rows, SAMPLES), max_gap=20)
    assert sorted(got) == sorted(tuple(r) for r in want.select("consumer", "sample_no", "status", "run", "status_text", "elapsed").collect())


def test_silent_consumers_raise_an_alarm(spark, tmp_path):
    path, checkpoint = str(tmp_path / "samples"), str(tmp_path / "cp")
    spark.createDataFrame([], SAMPLES).write.parquet(path)
    stream = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(path)
    alerts = stream_lag_alerts(stream, period=3, silence=0.001)
    deliver(spark.createDataFrame([("quiet", 1, "OK"), ("busy", 1, "OK")], SAMPLES), path)
    got = [[]]
    drain(alerts, checkpoint)
    for n in range(2, 7):
        deliver(spark.createDataFrame([("busy", n, "OK")], SAMPLES), path)
        time.sleep(0.01)
        got.append([(r.consumer, r.sample_no, r.status, r.run) for batch in drain(alerts, checkpoint) for r in batch])
    quiet = [r for part in got for r in part if r[0] == "quiet"]
    assert quiet == [("quiet", 1, SILENT, 1), ("quiet", 1, SILENT, 3)]


def test_progress_records_of_a_named_query(spark, tmp_path):
    topic = str(tmp_path / "topic")
    for n in range(3):
        deliver(frame(spark, [record(i, "U", 10 * n + i, **({"A": "x"} if i % 2 else {})) for i in range(6)]), topic)
    listener = ProgressRecords("watched", "APP", "case")
    read = observed_step(parse_changes(file_stream(spark, topic), SPEC), 1, "read")
    kept = observed_step(read.filter(F.col("A").isNotNull()), 2, "kept: with A")
    spark.streams.addListener(listener)
    try:
        run_micro_batches(kept, lambda df, n: df.write.format("noop").mode("overwrite").save(), str(tmp_path / "cp"), name="watched").awaitTermination()
        listener.wait()
    finally:
        spark.streams.removeListener(listener)
    got = [(r.APP_NAME, r.CASE_NM, r.EPOCH_ID, r.STEM_NUM, r.MSG, r.ROW_CNT) for r in listener.flush(spark).collect()]
    assert got == [("APP", "case", n, s, m, c) for n in range(3) for s, m, c in ((1, "read", 6), (2, "kept: with A", 3))]
    assert listener.flush(spark).count() == 0
