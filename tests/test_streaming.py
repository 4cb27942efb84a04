import fcntl
import json
import os
import random
from datetime import datetime, timezone


from tests.model import SPEC, as_rows, frame, record, replay
from tidelog.operators import hash_store as hs
from tidelog.operators.fold import current_rows, finish_states, fold_changes
from tidelog.operators.parse import parse_changes
from tidelog.operators.records import connect_records
from tidelog.sinks.change_store import ChangeStore
from tidelog.sinks.hash_writer import fetch_hashes, write_mutations
from tidelog.sinks.records import write_record_files
from tidelog.sources.change_stream import file_stream, kafka_options, project_raw
from tidelog.streaming.business import enriched_batch
from tidelog.streaming.micro_batch import run_micro_batches, sync_hashes, sync_store
from tidelog.streaming.pending import PendingLookups
from tidelog.streaming.stateful import stateful_sync
from tidelog.streaming.stats import STATS_KEY, BatchStats


def log(seed, count, start=0, keys=7):
    rng = random.Random(seed)
    return [record(k := rng.randrange(keys), rng.choice(["I", "U", "U", "tombstone"]), start + i,
                   partition=k % 3, **{c: v for c, v in {"A": rng.choice([None, "x", "y"]), "B": i}.items()
                                       if rng.random() < 0.6}) for i in range(count)]


def deliver(spark, path, records):
    """Add one file to the topic folder."""
    frame(spark, records).coalesce(1).write.mode("append").parquet(path)


class FileClient:
    """Hash store client over a JSON file, shared by tasks through a file lock."""

    def __init__(self, path):
        self.path = path

    def _change(self, fn):
        with open(self.path, "a+") as f:
            fcntl.flock(f, fcntl.LOCK_EX)
            f.seek(0)
            data = json.loads(f.read() or "{}")
            fn(data)
            f.seek(0)
            f.truncate()
            f.write(json.dumps(data))

    def hset(self, key, mapping):
        self._change(lambda d: d.setdefault(key, {}).update(mapping))

    def hdel(self, key, *fields):
        def drop(d):
            kept = {k: v for k, v in d.get(key, {}).items() if k not in fields}
            d.pop(key, None)
            if kept:
                d[key] = kept
        self._change(drop)

    def delete(self, *keys):
        self._change(lambda d: [d.pop(k, None) for k in keys])

    def hgetall(self, key):
        return self.content().get(key, {})

    def content(self):
        return json.load(open(self.path)) if os.path.exists(self.path) else {}


def connector(path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

    def connect():
        import sys

        if root not in sys.path:
            sys.path.insert(0, root)
        from tests.test_streaming import FileClient as Client

        return Client(path)

    return connect


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    topic, first, second = str(tmp_path / "topic"), log(1, 60), log(2, 60, start=60)
    store = ChangeStore(spark, str(tmp_path / "store"), SPEC, buckets=4)
    run = lambda: sync_store(file_stream(spark, topic), SPEC, store, str(tmp_path / "cp"),
                             compact_every=2).awaitTermination()
    deliver(spark, topic, first[:30])
    deliver(spark, topic, first[30:])
    run()
    assert as_rows(store.image()) == replay(first)
    deliver(spark, topic, second)
    run()
    run()
    assert as_rows(store.image()) == replay(first + second)


def test_repeated_delivery_after_lost_checkpoint(spark, tmp_path):
    topic, records = str(tmp_path / "topic"), log(3, 50)
    store = ChangeStore(spark, str(tmp_path / "store"), SPEC)
    deliver(spark, topic, records[:25])
    deliver(spark, topic, records[25:])
    for checkpoint in ("one", "two"):
        sync_store(file_stream(spark, topic, 2), SPEC, store, str(tmp_path / checkpoint)).awaitTermination()
        assert as_rows(store.image()) == replay(records)


def expected_hashes(rows):
    out = {}
    for key, (values, partition, offset) in rows.items():
        out[f"T:{key}"] = {**{c: str(v) for c, v in values.items()},
                           "KFK_PTT": str(partition), "KFK_OFFSET": str(offset)}
        for c, v in values.items():
            out.setdefault(f"T:A:{values['A']}", {})[f"{key}:{c}"] = str(v)
    return out


def test_hash_sync_with_index_writes_only_what_changed(spark, tmp_path):
    topic, path = str(tmp_path / "topic"), str(tmp_path / "hashes.json")
    store = ChangeStore(spark, str(tmp_path / "store"), SPEC)
    sink = lambda m: write_mutations(m, connector(path), chunk=7)
    seeded = [record(k, "I", k, partition=k % 3, A="x", B=k) for k in range(7)]
    everything = seeded + log(4, 60, start=7)
    for n, part in enumerate((everything[:30], everything[30:])):
        deliver(spark, topic, part)
        sync_hashes(file_stream(spark, topic), SPEC, store, str(tmp_path / "cp"), sink,
                    pseudo_keys=[["A"]]).awaitTermination()
    got = {k: {f: v for f, v in h.items()} for k, h in FileClient(path).content().items()}
    want = expected_hashes(replay(everything))
    for key, fields in want.items():
        # a column never mentioned since the row began is not stored; it reads as null
        assert {f: got[key].get(f, "None") for f in fields} == fields
    assert set(got) == set(want)
    again = str(tmp_path / "fresh-checkpoint")
    before = FileClient(path).content()
    sync_hashes(file_stream(spark, topic, 5), SPEC, store, again, sink, pseudo_keys=[["A"]]).awaitTermination()
    assert FileClient(path).content() == before


def test_writer_deletes_before_it_sets(spark, tmp_path):
    path = str(tmp_path / "h.json")
    FileClient(path).hset("T:1", {"A": "old", "B": "old"})
    folded = fold_changes(parse_changes(frame(spark, [
        record(1, "tombstone", 1), record(1, "I", 2, A="new"), record(2, "I", 3, A=None)]), SPEC), SPEC)
    write_mutations(hs.folded_mutations(folded, SPEC, with_offsets=False), connector(path))
    assert FileClient(path).content() == {"T:1": {"A": "new"}, "T:2": {"A": "None"}}


def test_keyed_state_matches_the_fold(spark, tmp_path):
    topic, records = str(tmp_path / "topic"), log(5, 80)
    out = str(tmp_path / "out")
    for part in (records[:40], records[20:60], records[60:]):
        deliver(spark, topic, part)
    changes = parse_changes(file_stream(spark, topic), SPEC)
    query = run_micro_batches(
        stateful_sync(changes, SPEC),
        lambda df, n: df.write.mode("append").parquet(out), str(tmp_path / "cp"))
    query.awaitTermination()
    newest = {}
    for r in spark.read.parquet(out).collect():
        if r.ID not in newest or r.KFK_OFFSET > newest[r.ID].KFK_OFFSET:
            newest[r.ID] = r
    alive = {k: ({"A": r.A, "B": r.B}, r.KFK_PTT, r.KFK_OFFSET) for k, r in newest.items() if r["__alive"]}
    assert alive == replay(records)


def test_business_batch_sends_tombstones_and_upserts(spark, tmp_path):
    topic, sent = str(tmp_path / "topic"), str(tmp_path / "sent")
    deliver(spark, topic, [record(1, "I", 0, A="x"), record(2, "I", 1, A="y"), record(3, "U", 2, A="x")])
    view = spark.createDataFrame([(1, "one"), (3, "three")], "ID bigint, NAME string")
    stats = BatchStats("APP", "case")
    on_batch = enriched_batch(
        SPEC, "st.OUT", select=lambda c: c.filter("A.v is not null"),
        touched=lambda c, n: c.select("ID"), result=lambda c, n: c.join(view, "ID").select("ID", "NAME"),
        key_columns=["ID"], value_columns=["ID", "NAME"],
        emit=lambda df: write_record_files(df, sent), stats=stats)
    run_micro_batches(file_stream(spark, topic), on_batch, str(tmp_path / "cp")).awaitTermination()
    rows = [(json.loads(r.key)["payload"]["ID"], r.value and json.loads(r.value)["payload"]["NAME"])
            for r in spark.read.parquet(sent).collect()]
    assert sorted(rows) == [(1, "one"), (2, None), (3, "three")]
    entries = stats.flush(spark)
    assert {(r.EPOCH_ID, r.STEM_NUM, r.MSG, r.ROW_CNT) for r in entries.collect()} == {
        (0, 1, "changes", 3), (0, 2, "rows sent", 2)}
    record_of_stats = connect_records(entries, "st.STAT", STATS_KEY, entries.columns).first()
    assert json.loads(record_of_stats.key)["payload"] == {"APP_NAME": "APP", "CASE_NM": "case", "EPOCH_ID": 0}
    assert stats.flush(spark).isEmpty()


def test_pending_lookups_across_batches(spark, tmp_path):
    minute = [0]
    lookups = PendingLookups(spark, str(tmp_path / "p"), "T", ["ID"], SPEC.values, 240, lambda: datetime(2024, 1, 1, 0, minute[0], tzinfo=timezone.utc))
    changes = parse_changes(frame(spark, [record(1, "U", 5, A="x"), record(2, "I", 6, A="y")]), SPEC)
    kv = lambda offset: spark.createDataFrame(
        [("T:1", "A", "x"), ("T:1", "KFK_OFFSET", str(offset))], "rk string, field string, value string")
    assert lookups.resolve(0, changes, kv(4)).isEmpty()
    nothing = changes.limit(0)
    minute[0] = 1
    for _ in range(2):
        assert lookups.resolve(1, nothing, kv(4)).isEmpty()
    assert {(r.ID, r.attempts) for r in lookups.waiting(1, changes).collect()} == {(1, 2), (2, 2)}
    minute[0] = 2
    assert [tuple(r) for r in lookups.resolve(3, nothing, kv(5)).collect()] == [(1, "x", None)]  # batch 2 was left out
    assert [(r.ID, r.attempts) for r in lookups.waiting(3, changes).collect()] == [(2, 3)]
    minute[0] = 4
    assert lookups.resolve(4, nothing, kv(5)).isEmpty()
    assert lookups.waiting(4, changes).isEmpty()
    assert [(r.ID, r.n) for r in lookups.given_up(changes).collect()] == [(2, 4)]
    assert lookups._batches(lookups.root) == [3, 4]


def test_waiting_keys_get_no_tombstone(spark, tmp_path):
    sent = []
    waiting = spark.createDataFrame([(2,)], "ID bigint")
    on_batch = enriched_batch(
        SPEC, "st.OUT", select=lambda c: c, touched=lambda c, n: c.select("ID"),
        result=lambda c, n: c.filter("ID = 1").select("ID"), key_columns=["ID"], value_columns=["ID"],
        emit=lambda df: sent.extend(df.collect()), waiting=lambda n: waiting)
    on_batch(frame(spark, [record(1, "I", 0, A="x"), record(2, "I", 1, A="y"), record(3, "I", 2, A="z")]), 0)
    assert sorted((json.loads(r.key)["payload"]["ID"], r.value is None) for r in sent) == [(1, False), (3, True)]


def test_reopened_store_gives_one_answer(spark, tmp_path):
    root = str(tmp_path / "s")
    image = spark.createDataFrame([(i, f"a{i}", i, -1, -1) for i in range(20)], "ID bigint, A string, B bigint, KFK_PTT int, KFK_OFFSET bigint")
    ChangeStore(spark, root, SPEC, buckets=8).seed(image)
    updates = parse_changes(frame(spark, [record(i, "U", i, A="new") for i in range(20)]), SPEC)
    other = ChangeStore(spark, root, SPEC)
    other.append(updates)
    want = [(i, "new", i) for i in range(20)]
    rows = lambda df: sorted((r.ID, r.A, r.B) for r in df.collect())
    for buckets in (1, 8, 64):
        store = ChangeStore(spark, root, SPEC, buckets=buckets)
        for limit in (0, 5, 10_000):
            assert rows(current_rows(finish_states(store.states(limit), SPEC), SPEC)) == want
            assert rows(store.rows_of(image, limit)) == want
    other.retire(other.compact())
    assert rows(ChangeStore(spark, root, SPEC, buckets=8).image()) == want
    assert rows(ChangeStore(spark, root, SPEC, buckets=8).rows_of(image)) == want


def test_external_store_is_read_on_the_executors(spark, tmp_path):
    path = str(tmp_path / "store.json")
    with open(path, "w") as f:
        json.dump({"T:1": {"A": "x", "KFK_OFFSET": "5"}, "T:2": {"A": "y"}, "U:1": {"A": "z"}}, f)
    wanted = spark.createDataFrame([("T:1",), ("T:1",), ("T:2",), ("T:9",), (None,)], "rk string")
    got = fetch_hashes(wanted, connector(path))
    assert sorted(tuple(r) for r in got.collect()) == [("T:1", "A", "x"), ("T:1", "KFK_OFFSET", "5"), ("T:2", "A", "y")]


def test_stats_number_steps_within_a_batch(spark):
    stats = BatchStats("APP")
    for epoch, message in [(0, "a"), (0, "b"), (1, "a")]:
        stats.append(epoch, message)
    assert [(r.EPOCH_ID, r.STEM_NUM) for r in stats.flush(spark).collect()] == [(0, 1), (0, 2), (1, 1)]


def test_kafka_projection_and_options(spark):
    raw = spark.sql("SELECT binary('k') AS key, CAST(NULL AS BINARY) AS value, 't' AS topic, 1 AS partition, 2L AS offset")
    assert tuple(project_raw(raw).first()) == ("k", None, "t", 1, 2)
    options = kafka_options("h:1", "topic", "earliest", 5)
    assert options["maxOffsetsPerTrigger"] == "5" and options["failOnDataLoss"] == "true"
    assert kafka_options("h:1", "topic", fail_on_data_loss=False)["failOnDataLoss"] == "false"
