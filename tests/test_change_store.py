"""What a change store reads and writes: only what a batch touches."""

import random

import pytest

from tests.model import SPEC, as_rows, frame, record, replay
from tidelog.operators.fold import ALIVE, current_rows, finish_states
from tidelog.operators.merge import offset_gate
from tidelog.operators.parse import parse_changes
from tidelog.sinks.change_store import ChangeStore


def changes(spark, records):
    return parse_changes(frame(spark, records), SPEC)


def log(seed, count, start=0, keys=40):
    rng = random.Random(seed)
    return [record(k := rng.randrange(keys), rng.choice(["I", "U", "U", "tombstone"]), start + i, partition=k % 3,
                   **{c: v for c, v in {"A": rng.choice([None, "x", "y"]), "B": i}.items() if rng.random() < 0.6})
            for i in range(count)]


def files(df):
    return {f.split("/store/")[1] for f in df.inputFiles()}


@pytest.fixture()
def store(spark, tmp_path):
    return ChangeStore(spark, str(tmp_path / "store"), SPEC, buckets=16)


def test_three_compactions_equal_the_replay(spark, store):
    records = []
    for n in range(4):
        batch = log(n, 60, start=60 * n)
        records += batch
        store.append(changes(spark, batch))
        if n < 3:
            store.retire(store.compact())
        assert as_rows(store.image()) == replay(records)
    assert store.manifest().version == 2 and len(store._complete("delta")) == 1


def test_compaction_writes_the_touched_buckets_only(spark, store):
    store.append(changes(spark, [record(i, "I", i, partition=i % 3, A="a", B=i) for i in range(200)]))
    store.compact()
    assert set(store.manifest().written.values()) == {0} and len(store.manifest().written) == 16
    store.append(changes(spark, [record(7, "U", 500, partition=1, A="new")]))
    store.compact()
    rewritten = [b for b, version in store.manifest().written.items() if version == 1]
    assert len(rewritten) == 1
    assert len(store._glob("base/__version=1/__bucket=*")) == 1
    assert store.manifest().offsets[rewritten[0]][1] == 500
    assert sum("__version=0" in f for f in files(store.states())) >= 15
    assert {r.ID: r.A for r in store.image().collect()}[7] == "new"


def test_merged_deltas_are_not_read_again(spark, store):
    for n in range(3):
        store.append(changes(spark, log(n, 20, start=20 * n)))
    assert sum(f.startswith("delta/") for f in files(store.states())) >= 3
    replaced = store.compact()
    assert len([f for f in replaced if f.startswith("delta/")]) == 3
    # their folders are still there, for readers that began before
    assert len(store._complete("delta")) == 3
    assert not any(f.startswith("delta/") for f in files(store.states()))
    assert store.compact() == replaced and store.manifest().version == 0


def test_a_batch_costs_the_same_late_as_early(spark, store):
    costs = []
    for n in range(12):
        store.append(changes(spark, [record(1, "U", 10 * n, A=str(n))]))
        if n % 3 == 2:
            store.retire(store.compact())
        costs.append(len(files(store.rows_of(spark.createDataFrame([(1,)], "ID bigint")))))
    assert max(costs[3:6]) == max(costs[9:12])
    assert len(store._complete("delta")) == 0 and len(store._complete("manifest")) == 1
    assert len(store._glob("base/__version=*/__bucket=*")) == 1


def test_restart_between_compaction_and_clean_up(spark, store):
    store.append(changes(spark, log(1, 30)))
    store.compact()
    again = ChangeStore(spark, store.root, SPEC, buckets=16)
    again.append(changes(spark, log(2, 30, start=30)))
    again.compact()
    again.retire(again.replaced())
    assert as_rows(again.image()) == replay(log(1, 30) + log(2, 30, start=30))
    assert again._complete("delta") == [] and again.replaced() == []


def test_compaction_without_manifest_does_not_count(spark, store, monkeypatch):
    store.append(changes(spark, log(1, 30)))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_commit", lost)
        with pytest.raises(RuntimeError):
            store.compact()
    assert as_rows(store.image()) == replay(log(1, 30))
    store.compact()
    assert as_rows(store.image()) == replay(log(1, 30))


def test_gate_reads_neither_base_nor_deltas(spark, store):
    first, second = log(1, 60), log(2, 40, start=60)
    store.append(changes(spark, first))
    store.compact()
    store.append(changes(spark, second))
    applied = store.applied_offsets()
    assert all(f.startswith("zone/") for f in files(applied))
    want = {}
    for r in changes(spark, first + second).collect():
        if r["__OP_TYPE"] != "U" or r.A or r.B:
            want[r.KFK_PTT] = max(want.get(r.KFK_PTT, -1), r.KFK_OFFSET)
    assert {r.KFK_PTT: r.KFK_OFFSET for r in applied.collect()} == want
    late = changes(spark, log(3, 30, start=85))
    assert {r.KFK_OFFSET for r in offset_gate(late, applied).collect()} == {
        r.KFK_OFFSET for r in late.collect() if r.KFK_OFFSET > want.get(r.KFK_PTT, -1)}


def test_a_delta_without_zone_map_is_asked_itself(spark, store):
    store.append(changes(spark, [record(1, "I", 7, partition=2, A="a")]))
    store.retire([f"zone/{name}" for name in store._complete("zone")])
    assert [tuple(r) for r in store.applied_offsets().collect()] == [(2, 7)]
    store.compact()
    assert [tuple(r) for r in store.applied_offsets().collect()] == [(2, 7)]


def test_changes_since_an_offset(spark, store):
    store.append(changes(spark, [record(i, "I", i, A="a") for i in range(100)]))
    store.compact()
    store.append(changes(spark, [record(3, "U", 200, B=3), record(4, "tombstone", 201)]))
    found = {r.ID: r[ALIVE] for r in store.changed_since(97).collect()}
    assert found == {98: True, 99: True, 3: True, 4: False}
    assert store.changed_since(500).count() == 0
    store.compact()
    touched = store.changed_since(199)
    assert {r.ID for r in touched.collect()} == {3, 4} and len(files(touched)) <= 2


def test_other_layout_rewrites_the_base(spark, store):
    store.append(changes(spark, log(5, 50)))
    store.compact()
    wide = ChangeStore(spark, store.root, SPEC, buckets=64)
    assert as_rows(wide.image()) == replay(log(5, 50))
    wide.retire(wide.compact())
    assert wide.manifest().buckets == 64 and as_rows(store.image()) == replay(log(5, 50))
    assert as_rows(current_rows(finish_states(store.states(0), SPEC), SPEC)) == replay(log(5, 50))
