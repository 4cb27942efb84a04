"""Row predicates and per-key selections over change rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.spec import DELETE, INSERT, OFFSET, OP, UPDATE, TableSpec


def any_not_null(*columns: Column) -> Column:
    return reduce(or_, [c.isNotNull() for c in columns])


def business_predicate(guard: Column, watched: list[Column]) -> Column:
    """Guarded rows that insert, or that carry at least one watched value."""
    return guard & (any_not_null(*watched) | (F.col(OP) == INSERT))


def touched_predicate(required: Column, flag: Column) -> Column:
    """Inserts with a required value and a set flag, and every update."""
    return (required.isNotNull() & flag & (F.col(OP) == INSERT)) | (F.col(OP) == UPDATE)


def split_by_operation(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Updates, and inserts with deletes."""
    return (changes.filter(F.col(OP) == UPDATE),
            changes.filter(F.col(OP).isin(INSERT, DELETE)))


def is_effective(spec: TableSpec) -> Column:
    """Inserts, deletes, and updates that mention a value column of the table."""
    mentions = any_not_null(*[F.col(c) for c in spec.columns]) if spec.columns else F.lit(False)
    return F.col(OP).isin(INSERT, DELETE) | ((F.col(OP) == UPDATE) & mentions)


def effective_changes(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Without updates that mention none of the table's value columns."""
    return changes.filter(is_effective(spec))


def latest_by_key(changes: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """The newest row per key; a null order value ranks below every other.

    An aggregate rather than a ranking window: every task first reduces its own
    rows to one per key, so a key holding most of the log costs no more than others.
    """
    rank = F.coalesce(F.col(OFFSET) if order is None else order, F.lit(-1))
    rest = [c for c in changes.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), rank).alias("__newest")
    return (changes.groupBy(*keys).agg(newest)
            .select(*keys, *[F.col("__newest")[c].alias(c) for c in rest])
            .select(*changes.columns))


def deleted_keys(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Newest row of the keys whose last operation is a delete."""
    return latest_by_key(changes, keys).filter(F.col(OP) == DELETE)


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def operation_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy(OP).agg(F.count(F.lit(1)).alias("changes"))
