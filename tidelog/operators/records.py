"""Output records: Connect key/value pairs, tombstones, plain JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.envelope import connect_json


def connect_records(df: DataFrame, topic: str, key_columns: list[str] | None = None,
                    value_columns: list[str] | None = None) -> DataFrame:
    """Upserts (key and value), tombstones (key and null), or value-only records."""
    if not key_columns and not value_columns:
        raise ValueError("a record needs key columns, value columns or both")
    columns = []
    if key_columns:
        columns.append(connect_json(df.schema, key_columns, f"{topic}.Key").alias("key"))
    if value_columns:
        columns.append(connect_json(df.schema, value_columns, f"{topic}.Value").alias("value"))
    else:
        columns.append(F.lit(None).cast("string").alias("value"))
    return df.select(*columns)


def json_records(df: DataFrame, value_columns: list[str], ignore_nulls: bool) -> DataFrame:
    """Plain JSON values, with or without null fields."""
    option = {"ignoreNullFields": str(ignore_nulls).lower()}
    return df.select(F.to_json(F.struct(*value_columns), option).alias("value"))
