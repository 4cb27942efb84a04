"""Lookup of changed keys in the hash store with a freshness check by offset.

The store is filled by another job and may lag behind the change stream. Instead
of waiting, every key gets a status; keys that are not ``ok`` go to a pending frame
that is tried again with the next micro-batch.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.functions.keys import hash_key
from tidelog.functions.stored_text import from_stored_text
from tidelog.operators.filters import distinct_keys, latest_by_key
from tidelog.spec import DELETE, OFFSET, OP, UPDATE

OK, MISSING, UNVERSIONED, STALE = "ok", "missing", "unversioned", "stale"


def _hashes(store: DataFrame, wanted: DataFrame, schema: StructType) -> DataFrame:
    """One row per wanted hash that exists, with its typed columns and stored offset."""
    # a row's hash has a few fields: one shuffle by rk serves the join, the decoding and the join after it
    hit = store.join(wanted.select("rk"), "rk", "left_semi")
    stored = lambda name: F.max(F.when(F.col("field") == name, F.col("value")))
    return hit.groupBy("rk").agg(
        F.lit(True).alias("__found"),
        stored(OFFSET).try_cast("bigint").alias("__stored_offset"),
        *[from_stored_text(stored(f.name), f.dataType).alias(f"__s_{f.name}") for f in schema])


def lookup_keys(changes: DataFrame, store: DataFrame, table: str, keys: list[str],
                schema: StructType) -> DataFrame:
    """Distinct keys found in the store, whatever their offset."""
    wanted = distinct_keys(changes, keys).withColumn("rk", hash_key(table, [F.col(k) for k in keys]))
    found = _hashes(store, wanted, schema)
    return wanted.join(found, "rk").select(
        *keys, *[F.col(f"__s_{f.name}").alias(f.name) for f in schema if f.name not in keys])


def versioned_lookup(changes: DataFrame, store: DataFrame, table: str, keys: list[str],
                     schema: StructType) -> DataFrame:
    """Newest change per key with its status and the stored columns of ``ok`` keys.

    Inserts accept any stored row; updates need a stored offset not below theirs.
    Keys whose newest change is a delete are not looked up.
    """
    latest = (latest_by_key(changes.select(*keys, OP, OFFSET), keys)
              .filter(F.col(OP) != DELETE)
              .withColumn("rk", hash_key(table, [F.col(k) for k in keys])))
    found = _hashes(store, latest, schema)
    joined = latest.join(found, "rk", "left")
    update = F.col(OP) == UPDATE
    status = (F.when(F.col("__found").isNull(), MISSING)
              .when(update & F.col("__stored_offset").isNull(), UNVERSIONED)
              .when(update & (F.col("__stored_offset") < F.col(OFFSET)), STALE)
              .otherwise(OK))
    ready = F.col("status") == OK
    return joined.withColumn("status", status).select(
        *keys, OP, OFFSET, "status",
        *[F.when(ready, F.col(f"__s_{f.name}")).alias(f.name) for f in schema if f.name not in keys])


def ready_rows(looked_up: DataFrame, keys: list[str], schema: StructType) -> DataFrame:
    """Rows that may continue."""
    columns = [f.name for f in schema if f.name not in keys]
    return looked_up.filter(F.col("status") == OK).select(*keys, *columns)


def waiting_rows(looked_up: DataFrame, keys: list[str], previous: DataFrame | None, now: datetime) -> DataFrame:
    """Keys that are not ready, with ``attempts`` and the time of the first one, ``since``.

    A change newer than the one that waited before starts anew.
    """
    waiting = looked_up.filter(F.col("status") != OK).select(*keys, OP, OFFSET, "status")
    start = F.lit(now).cast("timestamp")
    if previous is None:
        return waiting.withColumn("attempts", F.lit(1)).withColumn("since", start)
    before = previous.select(*keys, OFFSET, F.col("attempts").alias("__before"), F.col("since").alias("__since"))
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, OFFSET)]
    return waiting.alias("w").join(before.alias("b"), same, "left").select(
        "w.*", (F.coalesce("__before", F.lit(0)) + 1).cast("int").alias("attempts"),
        F.coalesce("__since", start).alias("since"))


def expired(now: datetime, max_wait: float) -> Column:
    """Whether a waiting key has waited ``max_wait`` seconds."""
    return F.lit(now).cast("timestamp").cast("double") - F.col("since").cast("double") >= max_wait


def pending_rows(waiting: DataFrame, keys: list[str], now: datetime, max_wait: float) -> DataFrame:
    """Waiting keys to try again.

    A missing key that has expired is taken as deleted and left out (see
    ``expired_rows``); a stale or unversioned one fails the job.
    """
    over = expired(now, max_wait)
    failed = F.raise_error(F.concat_ws(" ", F.lit("hash store still"), "status", F.lit("for key"),
                                       *[F.col(k).cast("string") for k in keys]))
    return (waiting.filter(~(over & (F.col("status") == MISSING)))
            .withColumn("attempts", F.when(over, failed.cast("int")).otherwise(F.col("attempts"))))


def expired_rows(waiting: DataFrame, now: datetime, max_wait: float) -> DataFrame:
    """Keys given up: missing for ``max_wait`` seconds, so deleted."""
    return waiting.filter(expired(now, max_wait) & (F.col("status") == MISSING))
