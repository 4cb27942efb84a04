import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.model import ABSENT, SPEC, as_rows, frame, record, replay
from tidelog.operators import filters
from tidelog.operators.fold import (
    combine_states,
    current_rows,
    finish_states,
    fold_changes,
    lift_changes,
    lift_rows,
)
from tidelog.operators.merge import (
    max_offset_per_partition,
    merge_small_batch,
    merge_snapshot,
    offset_gate,
)
from tidelog.operators.parse import parse_changes
from tidelog.operators.quality import split_keys
from tidelog.sinks.change_store import ChangeStore

FEW = settings(max_examples=3, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])
COLUMN = st.sampled_from([ABSENT, None, "v1", "v2"])
NUMBER = st.sampled_from([ABSENT, None, 1, 2])
CHANGE = st.tuples(st.integers(0, 24), st.sampled_from(["I", "U", "U", "D", "tombstone"]), COLUMN, NUMBER)
LOG = st.lists(CHANGE, min_size=40, max_size=250)


def build(log, start=0):
    return [record(k, op, start + i, partition=k % 3, A=a, B=b) for i, (k, op, a, b) in enumerate(log)]


def image_of(spark, records):
    return current_rows(fold_changes(parse_changes(frame(spark, records), SPEC), SPEC), SPEC)


@FEW
@given(LOG)
def test_fold_equals_sequential_replay(spark, log):
    records = build(log)
    assert as_rows(image_of(spark, records)) == replay(records)


@FEW
@given(LOG, st.randoms(use_true_random=False))
def test_fold_ignores_order_repetition_and_batching(spark, log, random):
    records = build(log)
    shuffled = records + records[: len(records) // 2]
    random.shuffle(shuffled)
    cut = random.randint(0, len(shuffled))
    states = [combine_states(lift_changes(parse_changes(frame(spark, part), SPEC), SPEC), SPEC)
              for part in (shuffled[:cut], shuffled[cut:])]
    both = combine_states(states[0].unionByName(states[1]), SPEC)
    assert as_rows(current_rows(finish_states(both, SPEC), SPEC)) == replay(records)


@FEW
@given(LOG, LOG, st.integers(0, 60))
def test_merge_of_overlapping_stream_equals_fold_of_everything(spark, first, second, overlap):
    before = build(first)
    after = build(second, start=len(before))
    image = image_of(spark, before)
    stream = parse_changes(frame(spark, before[len(before) - overlap:] + after), SPEC)
    expected = replay(before + after)
    assert as_rows(merge_snapshot(image, stream, SPEC)) == expected
    assert as_rows(merge_small_batch(image, stream, SPEC)) == expected
    assert as_rows(merge_small_batch(image, stream, SPEC, max_keys=1)) == expected


def test_delete_then_insert_resets_columns(spark):
    records = [record(1, "I", 0, A="a", B=1), record(1, "tombstone", 1), record(1, "I", 2, B=2)]
    assert as_rows(image_of(spark, records)) == {1: ({"A": None, "B": 2}, 0, 2)}
    image = image_of(spark, records[:1])
    stream = parse_changes(frame(spark, records[1:]), SPEC)
    assert as_rows(merge_snapshot(image, stream, SPEC)) == {1: ({"A": None, "B": 2}, 0, 2)}


def test_empty_batch_and_repeated_batch_change_nothing(spark):
    records = [record(i, "I", i, A="x") for i in range(4)]
    image = image_of(spark, records)
    empty = parse_changes(frame(spark, []), SPEC)
    assert as_rows(merge_snapshot(image, empty, SPEC)) == as_rows(image)
    again = parse_changes(frame(spark, records), SPEC)
    assert offset_gate(again, image).isEmpty()
    assert as_rows(merge_snapshot(image, again, SPEC, partitions=3)) == as_rows(image)


def test_gate_per_partition(spark):
    image = image_of(spark, [record(0, "I", 5, partition=0), record(1, "I", 9, partition=1)])
    assert [tuple(r) for r in max_offset_per_partition(image).collect()] == [(0, 5), (1, 9)]
    stream = parse_changes(frame(spark, [
        record(0, "U", 5, partition=0, A="old"), record(0, "U", 6, partition=0, A="new"),
        record(1, "U", 8, partition=1, A="old"), record(2, "I", 0, partition=2, A="first")]), SPEC)
    assert {(r.KFK_PTT, r.KFK_OFFSET) for r in offset_gate(stream, image).collect()} == {(0, 6), (2, 0)}


def test_gate_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr("tidelog.functions.skew.SMALL_ROWS", 1)
    from tidelog.functions import skew

    left = spark.createDataFrame([(i % 5, i) for i in range(100)], "k int, v int")
    right = spark.createDataFrame([(i, i * 10) for i in range(4)], "k int, w int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = sorted(map(tuple, left.join(right, "k", how).collect()), key=repr)
        spread = skew.join_unique(left, right, ["k"], how, by=["v"], max_rows=1)
        assert sorted(map(tuple, spread.collect()), key=repr) == plain


def test_fold_of_a_hot_key_is_reduced_before_the_shuffle(spark):
    hot = [record(1, "U", i, A=str(i)) for i in range(300)] + [record(2, "I", 300, A="x")]
    changes = parse_changes(frame(spark, hot).repartition(4), SPEC)
    folded = fold_changes(changes, SPEC)
    assert {r.ID: r.A.v for r in folded.collect()} == {1: "299", 2: "x"}
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_change_store_survives_repeats_and_partial_compaction(spark, tmp_path):
    first = [record(i, "I", i, A="a", B=i) for i in range(6)]
    second = [record(1, "tombstone", 10), record(2, "U", 11, A=None), record(3, "U", 12, B=99)]
    third = [record(1, "I", 20, A="back"), record(4, "tombstone", 21)]
    parse = lambda r: parse_changes(frame(spark, r), SPEC)
    store = ChangeStore(spark, str(tmp_path / "s"), SPEC, buckets=4)
    assert store.image().isEmpty()
    store.append(parse(first))
    store.append(parse(second))
    assert as_rows(store.image()) == replay(first + second)
    old = store.compact()
    assert as_rows(store.image()) == replay(first + second)
    store.append(parse(second))
    store.append(parse(third))
    store.append(parse(third))
    expected = replay(first + second + third)
    assert as_rows(store.image()) == expected
    assert as_rows(current_rows(finish_states(store.states(max_keys=1), SPEC), SPEC)) == expected
    keys = spark.createDataFrame([(1,), (4,), (5,), (77,)], "ID bigint")
    wanted = {k: v for k, v in expected.items() if k in (1, 4, 5)}
    assert as_rows(store.rows_of(keys)) == wanted
    assert as_rows(store.rows_of(keys, max_keys=2)) == wanted
    store.retire(old)
    assert as_rows(store.image()) == expected
    store.retire(store.compact())
    assert store._complete("manifest") == ["00000001"] and store._complete("delta") == []
    assert as_rows(store.image()) == expected


def test_interrupted_writes_are_not_read(spark, tmp_path):
    store = ChangeStore(spark, str(tmp_path / "s"), SPEC, buckets=2)
    records = [record(1, "I", 0, A="a")]
    store.append(parse_changes(frame(spark, records), SPEC))
    for folder in ("base/00000007/__bucket=0", "delta/half"):
        (tmp_path / "s" / folder).mkdir(parents=True)
    assert as_rows(store.image()) == replay(records)
    store.compact()
    assert as_rows(store.image()) == replay(records)


def test_change_store_from_a_seed(spark, tmp_path):
    seed = spark.createDataFrame([(1, "s", 1, -1, -1), (2, "s", 2, -1, -1)],
                                 "ID bigint, A string, B bigint, KFK_PTT int, KFK_OFFSET bigint")
    store = ChangeStore(spark, str(tmp_path / "s"), SPEC, buckets=2)
    store.seed(seed)
    store.append(parse_changes(frame(spark, [record(1, "U", 0, A=None), record(2, "tombstone", 1)]), SPEC))
    assert as_rows(store.image()) == {1: ({"A": None, "B": 1}, 0, 0)}
    assert as_rows(current_rows(finish_states(combine_states(lift_rows(seed, SPEC), SPEC), SPEC), SPEC)) == \
        as_rows(seed)


def test_selections(spark):
    records = [record(1, "I", 0, A="a"), record(1, "tombstone", 1), record(2, "U", 2, A="b"),
               record(2, "U", 3), record(3, "I", 4)]
    changes = parse_changes(frame(spark, records), SPEC)
    assert {(r.ID, r.KFK_OFFSET) for r in filters.latest_by_key(changes, ["ID"]).collect()} == {
        (1, 1), (2, 3), (3, 4)}
    assert [r.ID for r in filters.deleted_keys(changes, ["ID"]).collect()] == [1]
    assert {r.KFK_OFFSET for r in filters.effective_changes(changes, SPEC).collect()} == {0, 1, 2, 4}
    updates, others = filters.split_by_operation(changes)
    assert (updates.count(), others.count()) == (2, 3)
    assert {r[0]: r[1] for r in filters.operation_counts(changes).collect()} == {"I": 2, "U": 2, "D": 1}
    assert split_keys(changes, ["ID"]).isEmpty()
    moved = changes.withColumn("KFK_PTT", F.col("KFK_OFFSET").cast("int"))
    assert {r.ID for r in split_keys(moved, ["ID"]).collect()} == {1, 2}


@pytest.mark.parametrize("a,b,op,expected", [("01", "x", "U", True), ("01", None, "U", False),
                                             ("01", None, "I", True), ("02", "x", "I", False)])
def test_business_predicate(spark, a, b, op, expected):
    df = spark.createDataFrame([(a, b, None, op)], "a string, b string, c string, `__OP_TYPE` string")
    kept = df.filter(filters.business_predicate(F.col("a") == "01", [F.col("b"), F.col("c")]))
    assert (kept.count() == 1) is expected
