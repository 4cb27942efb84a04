"""The keyed hash layout: rows as ``(rk, field, value)`` and changes to them.

A mutation frame has ``rk, field, value, op``: ``del`` removes a key, ``hdel`` a
field, ``set`` writes a field. Within one frame deletes come before writes, and
a field is written at most once, so mutations may be applied in any task.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.functions.keys import (
    NULL_TEXT,
    composite_field,
    decode_part,
    hash_key,
    key_part,
    key_parts,
    split_field,
)
from tidelog.functions.sentinels import decode_value
from tidelog.functions.skew import SALTS, spread_join
from tidelog.functions.stored_text import from_stored_text, to_stored_text
from tidelog.operators.filters import any_not_null
from tidelog.operators.fold import ALIVE, RESET
from tidelog.sinks.tables import written_table
from tidelog.spec import OFFSET, PARTITION, TableSpec

SET, HDEL, DEL = "set", "hdel", "del"


def entry(op: str, rk: Column, field: Column | None, value: Column | None) -> Column:
    """One mutation as a struct."""
    none = F.lit(None).cast("string")
    return F.struct(rk.alias("rk"), (none if field is None else field).alias("field"),
                    (none if value is None else value).alias("value"), F.lit(op).alias("op"))


def emit(df: DataFrame, entries: list[Column]) -> DataFrame:
    """One output row per non-null mutation; their number follows the column list."""
    packed = df.select(F.explode(F.array_compact(F.array(*entries))).alias("m"))
    return packed.select("m.rk", "m.field", "m.value", "m.op")


def hset_mutations(df: DataFrame, table: str, key_columns: list[str], value_columns: list[str],
                   prefix_columns: list[str] | None = None, ignore_null: bool = False,
                   decode_defaults: bool = False) -> DataFrame:
    """Field writes for every row; a field may be prefixed with column *values*.

    Null is stored as ``None``, or skipped with ``ignore_null``. With
    ``decode_defaults`` a value equal to the default of its type is stored as
    ``None``: for frames whose explicit nulls were encoded as defaults.
    """
    rk = hash_key(table, [F.col(c) for c in key_columns])
    prefix = [F.col(c) for c in (prefix_columns or [])]
    entries = []
    for name in value_columns:
        dtype = df.schema[name].dataType
        value = decode_value(F.col(name), dtype) if decode_defaults else F.col(name)
        write = entry(SET, rk, composite_field(prefix, F.lit(name)), to_stored_text(value, dtype))
        entries.append(F.when(F.col(name).isNotNull(), write) if ignore_null else write)
    return emit(df, entries)


def hdel_mutations(df: DataFrame, table: str, key_columns: list[str], value_columns: list[str],
                   prefix_columns: list[str] | None = None) -> DataFrame:
    """Field deletes for every row."""
    rk = hash_key(table, [F.col(c) for c in key_columns])
    prefix = [F.col(c) for c in (prefix_columns or [])]
    return emit(df, [entry(HDEL, rk, composite_field(prefix, F.lit(c)), None)
                      for c in value_columns])


def del_mutations(df: DataFrame, table: str, key_columns: list[str]) -> DataFrame:
    """Key deletes for every row."""
    rk = hash_key(table, [F.col(c) for c in key_columns])
    return emit(df, [entry(DEL, rk, None, None)])


def folded_mutations(folded: DataFrame, spec: TableSpec, with_offsets: bool = True,
                     versioned_by: list[str] | None = None) -> DataFrame:
    """Mutations of the primary hash: absent columns are not written.

    A key that was deleted in the batch is removed first, also when it lives again.
    A live key none of whose columns is present writes nothing. Where the columns of
    ``spec`` are a part of the table's, ``versioned_by`` names all of them: partition and
    offset follow a change of any.
    """
    rk = hash_key(spec.name, [F.col(c) for c in spec.pk])
    alive = F.col(ALIVE)
    present = [F.col(c).isNotNull() for c in spec.columns]
    entries = [F.when(F.col(RESET), entry(DEL, rk, None, None))]
    for name, here in zip(spec.columns, present):
        value = to_stored_text(F.col(name)["v"], spec.type_of(name))
        entries.append(F.when(alive & here, entry(SET, rk, F.lit(name), value)))
    if with_offsets:
        anything = any_not_null(*[F.col(c) for c in versioned_by or spec.columns])
        for name in (PARTITION, OFFSET):
            entries.append(F.when(alive & anything, entry(
                SET, rk, F.lit(name), to_stored_text(F.col(name)))))
    return emit(folded, entries)


def apply_mutations(store: DataFrame, mutations: DataFrame) -> DataFrame:
    """Next content of the store.

    Removed keys are joined away; the rest is one aggregate per ``(rk, field)``, in
    which a mutation outranks the stored value. Only row hashes, of a few fields each,
    are removed as a whole, so the join needs no spreading.
    """
    gone = mutations.filter(F.col("op") == DEL).select("rk").distinct()
    kept = store.select("rk", "field", "value").join(gone, "rk", "left_anti")
    ranked = kept.select("rk", "field", F.struct(F.lit(0).alias("rank"), "value",
                                                 F.lit(SET).alias("op")).alias("m"))
    fresh = mutations.filter(F.col("op") != DEL).select(
        "rk", "field", F.struct(F.when(F.col("op") == SET, 2).otherwise(1).alias("rank"),
                                "value", "op").alias("m"))
    newest = ranked.unionByName(fresh).groupBy("rk", "field").agg(
        F.max_by("m", F.col("m")["rank"]).alias("m"))
    return newest.filter(F.col("m")["op"] == SET).select("rk", "field", F.col("m")["value"].alias("value"))


def image_to_store(image: DataFrame, spec: TableSpec, with_offsets: bool = True) -> DataFrame:
    """Primary hash content of a table image."""
    columns = spec.columns + ([PARTITION, OFFSET] if with_offsets else [])
    return hset_mutations(image, spec.name, spec.pk, columns).drop("op")


def image_to_index(image: DataFrame, spec: TableSpec, pseudo_key: list[str],
                   value_columns: list[str]) -> DataFrame:
    """Secondary hash content: all rows sharing a pseudo key under one hash."""
    rk = hash_key(spec.name, [F.col(c) for c in pseudo_key], pseudo_key)
    owner = [F.col(c) for c in spec.pk if c not in pseudo_key]
    return emit(image, [
        entry(SET, rk, composite_field(owner, F.lit(c)), to_stored_text(F.col(c), spec.type_of(c)))
        for c in value_columns]).drop("op")


def decode_store(store: DataFrame, spec: TableSpec, schema: StructType) -> DataFrame:
    """Typed rows of the primary hash: key columns, then the columns of ``schema``.

    The store may hold secondary hashes too: a row's hash has exactly the key's
    parts, and fields without an owner, of which one at least is in ``schema`` or a
    column of the table. Keys that do not fit the key's types are not rows.
    """
    prefix = f"{spec.name}:"
    names = [*dict.fromkeys([*schema.names, *spec.columns, PARTITION, OFFSET])]
    parts = key_parts(F.col("rk"), prefix)
    own = store.filter(F.col("rk").startswith(prefix) & (F.size(parts) == len(spec.pk)) & F.col("field").isin(names))
    wide = own.groupBy("rk").agg(
        *[F.max(F.when(F.col("field") == f.name, F.col("value"))).alias(f.name) for f in schema])
    text = [key_part(F.col("rk"), prefix, i) for i in range(len(spec.pk))]
    keys = [t.try_cast(f.dataType).alias(f.name) for t, f in zip(text, spec.key)]
    fits = [t.try_cast(f.dataType).isNotNull() | (t == NULL_TEXT) for t, f in zip(text, spec.key)]
    wide = wide.filter(reduce(Column.__and__, fits))
    return wide.select(*keys, *[from_stored_text(F.col(f.name), f.dataType).alias(f.name)
                                for f in schema])


def index_rows(index: DataFrame, spec: TableSpec, pseudo_key: list[str],
               schema: StructType) -> DataFrame:
    """Rows of a secondary hash: pseudo key, remaining key columns, ``schema`` columns.

    Composite fields are regrouped per original row, never per hash, so a pseudo
    key shared by most rows stays spread over the tasks. Only keys with exactly the
    pseudo key's parts and fields with exactly the owner's count: hashes of longer
    pseudo keys begin alike.
    """
    owner, column = split_field(F.col("field"))
    prefix = f"{spec.name}:{':'.join(pseudo_key)}:"
    owner_columns = [c for c in spec.pk if c not in pseudo_key]
    hashes = index.filter(F.col("rk").startswith(prefix) & (F.size(key_parts(F.col("rk"), prefix)) == len(pseudo_key)))
    owned = (owner != "") & (F.size(F.split(owner, ":")) == len(owner_columns)) if owner_columns else owner == ""
    wide = (hashes.filter(owned)
            .withColumns({"__owner": owner, "__column": column})
            .groupBy("rk", "__owner")
            .agg(*[F.max(F.when(F.col("__column") == f.name, F.col("value"))).alias(f"__f_{f.name}")
                   for f in schema]))
    pseudo = [from_stored_text(key_part(F.col("rk"), prefix, i), spec.type_of(c)).alias(c)
              for i, c in enumerate(pseudo_key)]
    owners = F.split(F.col("__owner"), ":")
    own = [from_stored_text(decode_part(F.get(owners, F.lit(i))), spec.type_of(c)).alias(c)
           for i, c in enumerate(owner_columns)]
    fields = [from_stored_text(F.col(f"__f_{f.name}"), f.dataType).alias(f.name)
              for f in schema if f.name not in pseudo_key]
    return wide.select("rk", *pseudo, *own, *fields)


def index_lookup(index: DataFrame, sensors: DataFrame, spec: TableSpec, pseudo_key: list[str],
                 schema: StructType, salts: int = SALTS) -> DataFrame:
    """Original rows stored under the pseudo keys of ``sensors``; one key, many rows."""
    wanted = sensors.select(
        hash_key(spec.name, [F.col(c) for c in pseudo_key], pseudo_key).alias("rk")).distinct()
    hit = spread_join(index, wanted, ["rk"], "left_semi", by=["field"], salts=salts)
    return index_rows(hit, spec, pseudo_key, schema)


def count_keys(store: DataFrame, prefix: str) -> DataFrame:
    """Number of hashes whose key starts with ``prefix``."""
    return (store.filter(F.col("rk").startswith(prefix)).select("rk").distinct()
            .agg(F.count(F.lit(1)).alias("keys")))


def field_names(store: DataFrame, prefix: str) -> DataFrame:
    """Distinct field names below ``prefix``, one per row, sorted."""
    return (store.filter(F.col("rk").startswith(prefix)).select("field").distinct()
            .orderBy("field"))


def entries_of(store: DataFrame, key: str) -> DataFrame:
    """All fields of one hash."""
    return store.filter(F.col("rk") == key)


def matching(store: DataFrame, pattern: str) -> DataFrame:
    """Entries whose key matches a glob: ``*``, ``?``, ``[abc]``, ``[^abc]``, ``\\`` escapes.

    The literal head of the pattern is also given as a prefix, which a scan can use.
    """
    parts = re.findall(r"\\.|\[\^?[^\]]*\]|.", pattern, re.DOTALL)
    wild = {"*": ".*", "?": "."}
    regex, head = "", ""
    for i, part in enumerate(parts):
        special = part in wild or (part.startswith("[") and part.endswith("]") and len(part) > 2)
        literal = part[1] if len(part) == 2 and part.startswith("\\") else part
        regex += (wild.get(part) or part) if special else re.escape(literal)
        if not special and len(head) == i:
            head += literal
    return store.filter(F.col("rk").startswith(head) & F.col("rk").rlike(f"(?s)^{regex}$"))


def first_keys(store: DataFrame, prefix: str, limit: int = 10, key_width: int = 1) -> DataFrame:
    """All entries of the first ``limit`` keys, with the key parts as PK0, PK1, ..."""
    below = store.filter(F.col("rk").startswith(prefix))
    chosen = below.select("rk").distinct().orderBy("rk").limit(limit)
    parts = [key_part(F.col("rk"), prefix, i).alias(f"PK{i}") for i in range(key_width)]
    hit = below.join(F.broadcast(chosen), "rk", "left_semi")  # at most ``limit`` keys
    return hit.select("rk", *parts, "field", "value")


def numbered_pages(store: DataFrame, prefix: str, page_keys: int) -> DataFrame:
    """All entries below ``prefix`` with ``page``, from 0: pages hold ``page_keys`` keys each, in the order of the keys.

    The keys are dealt out by ranges, numbered inside their range, and the counts of the
    ranges before (one row per range) are added, so no task sees all keys.
    """
    below = store.filter(F.col("rk").startswith(prefix))
    ranged = written_table(below.select("rk").distinct().repartitionByRange("rk").withColumn("__range", F.spark_partition_id()))
    inside = Window.partitionBy("__range").orderBy("rk")
    across = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__keys"))
    before = counts.select("__range", F.coalesce(F.sum("__keys").over(across), F.lit(0)).alias("__before"))
    placed = ranged.withColumn("__at", F.row_number().over(inside) - 1).join(F.broadcast(before), "__range")
    page = F.floor((F.col("__before") + F.col("__at")) / page_keys).cast("long")
    return below.join(placed.select("rk", page.alias("page")), "rk").select("rk", "field", "value", "page")


def page_after(store: DataFrame, prefix: str, page_keys: int, after: str | None = None) -> DataFrame:
    """Entries of the next ``page_keys`` keys below ``prefix`` after the key ``after`` (the first ones, if None).

    The cursor is the last key of the page before. It is a condition on the key, so that
    a store sorted by key, or one that takes conditions, reads nothing before it. An
    empty page ends the scan.
    """
    below = store.filter(F.col("rk").startswith(prefix))
    if after is not None:
        below = below.filter(F.col("rk") > after)
    chosen = below.select("rk").distinct().orderBy("rk").limit(page_keys)
    return below.join(F.broadcast(chosen), "rk", "left_semi").select("rk", "field", "value")  # at most ``page_keys`` keys


def without_prefix(store: DataFrame, prefix: str) -> DataFrame:
    """The store after deleting every key that starts with ``prefix``."""
    return store.filter(~F.col("rk").startswith(prefix))
