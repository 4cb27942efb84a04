"""Enrichment of changed keys and detection of results that vanished."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.filters import latest_by_key


def enrich_latest(changes: DataFrame, view: DataFrame, keys: list[str]) -> DataFrame:
    """Newest change per key joined to a table view with the same key columns."""
    return latest_by_key(changes, keys).join(view, keys)


def with_load_time(df: DataFrame, at: datetime.datetime | str | None = None,
                   name: str = "LOADED_AT") -> DataFrame:
    """``df`` with the time of loading: the given one, or the query's current time."""
    return df.withColumn(name, F.current_timestamp() if at is None else F.lit(at).cast("timestamp"))


def compact_time(column: Column) -> Column:
    """Timestamp as ``yyyyMMddHHmmss`` text."""
    return F.date_format(column, "yyyyMMddHHmmss")


def category_code(column: Column, pattern: str, match: str, other: str) -> Column:
    """Two-way code by a LIKE pattern."""
    return F.when(column.like(pattern), match).otherwise(other)


def vanished_keys(touched: DataFrame, result: DataFrame, keys: list[str]) -> DataFrame:
    """Touched keys without a result row: the keys to delete downstream.

    Distinct first, so the anti join reuses the partitioning by key.
    """
    return touched.select(*keys).distinct().join(result.select(*keys), keys, "left_anti")
