"""From raw key/value text to typed change rows that keep column presence.

Every value column becomes ``struct<v: T>``: a null struct means the change does
not mention the column, a struct holding null means an explicit null. Key and
value are parsed once per row into a variant, which keeps decimals exact and
tells a missing field from a null one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructType, TimestampNTZType, TimestampType

from tidelog.spec import DELETE, INSERT, OFFSET, OP, PARTITION, UPDATE, TableSpec


def typed_value(field: Column, dtype: DataType) -> Column:
    """Typed value of a variant field, null where it is none.

    Text is trimmed. Whole numbers in a timestamp column are epoch milliseconds,
    in a date column days since the epoch.
    """
    plain = F.try_variant_get(field, "$", dtype.simpleString())
    if isinstance(dtype, StringType):
        return F.trim(plain)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.coalesce(F.timestamp_millis(F.try_variant_get(field, "$", "bigint")).cast(dtype), plain)
    if isinstance(dtype, DateType):
        return F.coalesce(F.date_from_unix_date(F.try_variant_get(field, "$", "int")), plain)
    return plain


def _payload(text: str, fields: list[str]) -> Column:
    """The named payload fields of a JSON text as variants; a missing field is a null."""
    schema = ", ".join(f"`{f}`: variant" for f in fields)
    return F.try_variant_get(F.try_parse_json(F.col(text)), "$.payload", f"struct<{schema}>")


def tombstone_op(without_value: Column, op: Column) -> Column:
    """A record without value deletes its key."""
    return F.when(without_value, F.lit(DELETE)).otherwise(op)


def _evaluate_once(df: DataFrame, passed: list[str]) -> DataFrame:
    """The same rows, with every column but ``passed`` computed exactly once.

    The columns go through a one-element generator. A filter on a parsed column
    would otherwise be pushed through the projections below by repeating their
    expressions, parsing included; filters on ``passed`` still reach the scan.
    """
    computed = [c for c in df.columns if c not in passed]
    row = F.explode(F.array(F.struct(*computed))).alias("__row")
    return df.select(row, *passed).select(
        *[F.col(c) if c in passed else F.col("__row")[c].alias(c) for c in df.columns])


def _typed_records(raw: DataFrame, spec: TableSpec, whole: bool = False) -> DataFrame:
    """Typed columns of every record, and ``__fault``: what keeps it from being a change, null if nothing does.

    With ``whole`` the record as it came goes along as ``__record``.
    """
    record = [F.struct(*raw.columns).alias("__record")] if whole else []
    docs = raw.select(
        _payload("KEY", spec.pk).alias("__key"),
        _payload("VALUE", [*spec.pk, OP, *spec.columns]).alias("__doc"),
        F.col("VALUE").isNull().alias("__gone"),
        F.col("partition").alias(PARTITION), F.col("offset").alias(OFFSET), *record)
    key, doc = F.col("__key"), F.col("__doc")
    came = ["__record"] if whole else []
    keys = [F.coalesce(typed_value(key[f.name], f.dataType), typed_value(doc[f.name], f.dataType)).alias(f.name)
            for f in spec.key]
    op = tombstone_op(F.col("__gone"), typed_value(doc[OP], StringType()))
    cells = [F.when(doc[f.name].isNotNull(),
                    F.struct(typed_value(doc[f.name], f.dataType).alias("v"))).alias(f.name)
             for f in spec.values]
    given = [(doc[c].isNotNull() & ~F.is_variant_null(doc[c])).alias(f"__given_{i}") for i, c in enumerate(spec.columns)]
    parsed = docs.select(*keys, op.alias(OP), PARTITION, OFFSET, *cells, *given, *came)
    lacking = [F.when(F.col(name).isNull(), F.lit(f"key {name}")) for name in spec.pk]
    unknown = F.when(~F.coalesce(F.col(OP).isin(INSERT, UPDATE, DELETE), F.lit(False)), F.lit("operation"))
    unfit = [F.when(F.col(f"__given_{i}") & F.col(c)["v"].isNull(), F.lit(f"value {c}")) for i, c in enumerate(spec.columns)]
    fault = F.coalesce(*lacking, unknown, *unfit)
    return parsed.select(*spec.pk, OP, PARTITION, OFFSET, *spec.columns, fault.alias("__fault"), *came)


def parse_changes(raw: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """Typed changes: key columns, operation, partition, offset, presence structs.

    ``raw`` has KEY, VALUE, partition and offset. A record is malformed without a complete
    key or one of the operations I, U, D, and if a value does not fit its column's type (a value
    that is there but unfit is never taken for null). With ``strict`` such a record fails the job,
    naming its partition and offset; otherwise it stays, its operation null, so that
    nothing is done with it (``rejected_changes`` lists these records).
    """
    records, fault = _typed_records(raw, spec), F.col("__fault")
    if strict:
        where = F.concat_ws(" ", F.lit("malformed change, partition and offset:"), PARTITION, OFFSET, F.lit("in"), fault)
        op = F.when(fault.isNull(), F.col(OP)).otherwise(F.raise_error(where))
    else:
        op = F.when(fault.isNull(), F.col(OP))
    return _evaluate_once(records.withColumn(OP, op).drop("__fault"), [PARTITION, OFFSET])


def rejected_changes(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Malformed records as they came, with ``fault``: the first thing that is wrong with them.

    For a topic or table of rejected records, beside ``parse_changes(..., strict=False)``.
    """
    records = _evaluate_once(_typed_records(raw, spec, whole=True), [PARTITION, OFFSET])
    rejected = records.filter(F.col("__fault").isNotNull())
    return rejected.select("__record.*", F.col("__fault").alias("fault"))


def parse_operations(raw: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """Key, operation, partition and offset alone: no value column is looked at."""
    return parse_changes(raw, TableSpec(spec.name, spec.key, StructType()), strict)


def flatten(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Plain value columns; absent and explicit null both read as null."""
    return changes.withColumns({c: F.col(c)["v"] for c in spec.columns})


def presence_flags(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """One boolean per value column, true where the change mentions it."""
    return changes.withColumns({f"{c}_present": F.col(c).isNotNull() for c in spec.columns})
