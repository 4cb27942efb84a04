import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tests.model import SPEC, as_rows, frame, record, replay
from tidelog.functions.keys import composite_field, decode_part, hash_key, key_part, split_field
from tidelog.operators import hash_store as hs
from tidelog.operators.fold import current_rows, fold_changes
from tidelog.operators.index_sync import index_mutations, sync_columns, touched_before_after
from tidelog.operators.parse import parse_changes
from tidelog.spec import TableSpec

PAIR = TableSpec.of("P", {"K1": StringType(), "K2": LongType()}, {"TAG": StringType(), "N": LongType()})


def entries(df):
    return {(r.rk, r.field): r.value for r in df.collect()}


def folded(spark, records):
    return fold_changes(parse_changes(frame(spark, records), SPEC), SPEC)


def test_keys_with_separators_do_not_collide(spark):
    df = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), ("50%", "it's"), (None, "x")], "a string, b string")
    row = df.select(hash_key("T", [F.col("a"), F.col("b")]).alias("rk"), "a", "b",
                    composite_field([F.col("a"), F.col("b")], F.lit("COL")).alias("field"))
    owner, column = split_field(F.col("field"))
    back = row.select("a", "b", "rk", key_part(F.col("rk"), "T:", 0).alias("a2"),
                      key_part(F.col("rk"), "T:", 1).alias("b2"), owner.alias("owner"), column.alias("column"),
                      decode_part(F.split(owner, ":")[1]).alias("b3")).collect()
    assert len({r.rk for r in back}) == 4
    assert all((r.a or "None", r.b) == (r.a2, r.b2) and r.b == r.b3 and r.column == "COL" for r in back)
    assert {r.rk for r in back if r.a is None} == {"T:None:x"}


def test_plain_keys_look_as_expected(spark):
    df = spark.createDataFrame([("aaaa", 7)], "p string, q bigint")
    row = df.select(hash_key("TBL", [F.col("p"), F.col("q")]), hash_key("TBL", [F.col("q")], ["q"]),
                    composite_field([F.col("p"), F.col("q")], F.lit("ETC"))).first()
    assert tuple(row) == ("TBL:aaaa:7", "TBL:q:7", "aaaa:7:ETC")


def test_row_mutations(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, 5)], "id bigint, a string, b bigint")
    assert entries(hs.hset_mutations(df, "T", ["id"], ["a", "b"])) == {
        ("T:1", "a"): "x", ("T:1", "b"): "None", ("T:2", "a"): "None", ("T:2", "b"): "5"}
    assert entries(hs.hset_mutations(df, "T", ["id"], ["a", "b"], ignore_null=True)) == {
        ("T:1", "a"): "x", ("T:2", "b"): "5"}
    assert entries(hs.hset_mutations(df, "T", ["id"], ["b"], prefix_columns=["a", "id"])) == {
        ("T:1", "x:1:b"): "None", ("T:2", "None:2:b"): "5"}
    assert {(r.rk, r.field, r.op) for r in hs.hdel_mutations(df, "T", ["id"], ["b"], ["a"]).collect()} == {
        ("T:1", "x:b", "hdel"), ("T:2", "None:b", "hdel")}
    assert {(r.rk, r.op) for r in hs.del_mutations(df, "T", ["id"]).collect()} == {("T:1", "del"), ("T:2", "del")}


def test_encoded_nulls_are_stored_as_none(spark):
    df = spark.createDataFrame([(1, "__UPDATE_NULL__", None), (2, "x", -999999999)], "id bigint, a string, b bigint")
    assert entries(hs.hset_mutations(df, "T", ["id"], ["a", "b"], ignore_null=True, decode_defaults=True)) == {
        ("T:1", "a"): "None", ("T:2", "a"): "x", ("T:2", "b"): "None"}


def test_change_without_known_columns_writes_nothing(spark):
    assert hs.folded_mutations(folded(spark, [record(1, "I", 0)]), SPEC).isEmpty()


def test_applied_mutations_follow_the_image(spark):
    random.seed(5)
    log = [record(random.randrange(9), random.choice(["I", "U", "tombstone"]), i,
                  A=random.choice([None, "x", "y"]), B=i) for i in range(120)]
    store = spark.createDataFrame([], "rk string, field string, value string")
    for start in range(0, 120, 40):
        store = hs.apply_mutations(store, hs.folded_mutations(folded(spark, log[start:start + 40]), SPEC))
        expected = {}
        for key, (values, partition, offset) in replay(log[:start + 40]).items():
            for name, value in {**values, "KFK_PTT": partition, "KFK_OFFSET": offset}.items():
                expected[(f"T:{key}", name)] = str(value)
        assert entries(store) == expected
        store = spark.createDataFrame(store.collect(), store.schema)
    schema = StructType([*SPEC.values.fields, StructField("KFK_PTT", LongType()), StructField("KFK_OFFSET", LongType())])
    assert as_rows(hs.decode_store(store, SPEC, schema)) == replay(log)


def brute_index(rows, pseudo):
    """Secondary hash of rows keyed (K1, K2) with values TAG, N."""
    out = {}
    for (k1, k2), values in rows.items():
        cells = {"K1": k1, "K2": k2, **values}
        rk = ":".join(["P", *pseudo, *[str(cells[c]) for c in pseudo]])
        owner = [str(cells[c]) for c in ("K1", "K2") if c not in pseudo]
        for column in ("TAG", "N"):
            out[(rk, ":".join([*owner, column]))] = str(values[column])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_index_mutations_keep_the_index_equal_to_its_recomputation(spark, seed):
    rng = random.Random(seed)
    pseudo_keys = [["TAG"], ["K1", "N"]]
    rows, store = {}, spark.createDataFrame([], "rk string, field string, value string")
    image = spark.createDataFrame([], StructType([*PAIR.key.fields, *PAIR.values.fields,
                                                  StructField("KFK_PTT", LongType()),
                                                  StructField("KFK_OFFSET", LongType())]))
    offset = 0
    for _ in range(3):
        records = []
        for _ in range(40):
            k = (rng.choice("ab"), rng.randrange(4))
            op = rng.choice(["I", "U", "U", "D"])
            fields = {c: rng.choice(v) for c, v in {"TAG": [None, "x", "y"], "N": [None, 1, 2]}.items()
                      if rng.random() < 0.6}
            key = f'{{"payload":{{"K1":"{k[0]}","K2":{k[1]}}}}}'
            import json
            records.append((key, json.dumps({"payload": {**fields, "__OP_TYPE": op}}), "t", 0, offset))
            offset += 1
            if op == "D":
                rows.pop(k, None)
            elif op == "I" or fields:
                rows[k] = {**rows.get(k, {"TAG": None, "N": None}), **fields}
        batch = fold_changes(parse_changes(frame(spark, records), PAIR), PAIR)
        touched = touched_before_after(image, batch, PAIR, max_keys=rng.choice([None, 100]))
        store = hs.apply_mutations(store, index_mutations(touched, PAIR, pseudo_keys, ["TAG", "N"]))
        store = spark.createDataFrame(store.collect(), store.schema)
        assert entries(store) == {**brute_index(rows, ["TAG"]), **brute_index(rows, ["K1", "N"])}
        image = spark.createDataFrame([(k[0], k[1], v["TAG"], v["N"], 0, offset) for k, v in rows.items()],
                                      image.schema)


def test_index_lookup_returns_every_row_of_a_shared_key(spark):
    rows = [(f"k:{i}", i, "hot" if i % 3 else "cold", i * 2, 0, i) for i in range(60)]
    image = spark.createDataFrame(rows, "K1 string, K2 bigint, TAG string, N bigint, KFK_PTT int, KFK_OFFSET bigint")
    index = hs.image_to_index(image, PAIR, ["TAG"], ["TAG", "N"])
    sensors = spark.createDataFrame([("hot",), ("hot",), ("none",)], "TAG string")
    got = hs.index_lookup(index, sensors, PAIR, ["TAG"], PAIR.values)
    assert got.columns == ["rk", "TAG", "K1", "K2", "N"]
    assert {(r.K1, r.K2, r.TAG, r.N) for r in got.collect()} == {r[:4] for r in rows if r[2] == "hot"}


def test_inspection(spark):
    store = spark.createDataFrame(
        [(f"T:{i}:z", f, str(i)) for i in range(25) for f in ("a", "b")] + [("T_:1", "c", "x")],
        "rk string, field string, value string")
    assert hs.count_keys(store, "T:").first()[0] == 25
    assert [r.field for r in hs.field_names(store, "T:").collect()] == ["a", "b"]
    shown = hs.first_keys(store, "T:", 3, key_width=2).collect()
    assert {(r.PK0, r.PK1) for r in shown} == {("0", "z"), ("10", "z"), ("11", "z")} and len(shown) == 6
    assert hs.without_prefix(store, "T:").count() == 1
    assert {r.rk for r in hs.matching(store, "T:1?:*").collect()} == {f"T:{i}:z" for i in range(10, 20)}
    assert hs.matching(store, "T_:*").count() == 1
    assert {r.rk for r in hs.matching(store, "T:[12]:z").collect()} == {"T:1:z", "T:2:z"}
    assert {r.rk for r in hs.matching(store, "T:[^0-9]*").collect()} == set()
    assert {r.rk for r in hs.entries_of(store, "T:3:z").collect()} == {"T:3:z"}
    odd = spark.createDataFrame([("a*b", "f", "v"), ("axb", "f", "v"), ("a.b+(", "f", "v")],
                                "rk string, field string, value string")
    assert [r.rk for r in hs.matching(odd, "a\\*b").collect()] == ["a*b"]
    assert [r.rk for r in hs.matching(odd, "a.b+(").collect()] == ["a.b+("]
    assert hs.matching(odd, "*b*").count() == 3


def test_sync_columns():
    assert sync_columns(PAIR, [["TAG"], ["K1", "N"]], ["N"]) == ["TAG", "N"]


def test_image_and_store_agree(spark):
    image = current_rows(folded(spark, [record(1, "I", 0, A="x", B=None)]), SPEC)
    assert entries(hs.image_to_store(image, SPEC)) == {
        ("T:1", "A"): "x", ("T:1", "B"): "None", ("T:1", "KFK_PTT"): "0", ("T:1", "KFK_OFFSET"): "0"}
