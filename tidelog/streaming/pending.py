"""Freshness-checked lookups across micro-batches: what is not ready is tried again."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from tidelog.operators.versioned_lookup import (
    expired_rows,
    pending_rows,
    ready_rows,
    versioned_lookup,
    waiting_rows,
)
from tidelog.spec import OFFSET, OP

# Fixed value: seconds after which a missing key counts as deleted and a stale one fails.
MAX_WAIT = 600.0
KEPT_BATCHES = 2


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


class PendingLookups:
    """Keeps the waiting keys of batch ``n`` in ``root/n=<n>``; a repeated batch rewrites its own.

    Keys given up are written to ``root-expired/n=<n>``. Batches may be left out;
    folders of batches older than the last two are deleted, except expired keys.
    """

    def __init__(self, spark: SparkSession, root: str, table: str, keys: list[str],
                 schema: StructType, max_wait: float = MAX_WAIT,
                 clock: Callable[[], datetime] = _utc_now):
        self.spark, self.root, self.table = spark, root.rstrip("/"), table
        self.keys, self.schema, self.max_wait, self.clock = keys, schema, max_wait, clock

    def _batches(self, root: str) -> list[int]:
        """Numbers of the completely written batches below ``root``."""
        pattern = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/n=*/_SUCCESS")
        files = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = files.globStatus(pattern) or []
        return sorted(int(s.getPath().getParent().getName().removeprefix("n=")) for s in found)

    def _clean(self, root: str, batch_id: int) -> None:
        for n in self._batches(root):
            if n <= batch_id - KEPT_BATCHES:
                path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/n={n}")
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _schema(self, like: DataFrame) -> StructType:
        fields = [like.schema[c] for c in (*self.keys, OP, OFFSET)]
        fields += [StructField("status", StringType()), StructField("attempts", IntegerType()),
                   StructField("since", TimestampType())]
        return StructType([StructField(f.name, f.dataType) for f in fields])

    def waiting(self, batch_id: int, like: DataFrame) -> DataFrame:
        """Keys that the last batch up to ``batch_id`` left waiting."""
        before = [n for n in self._batches(self.root) if n <= batch_id]
        if not before:
            return self.spark.createDataFrame([], self._schema(like))
        return self.spark.read.schema(self._schema(like)).parquet(f"{self.root}/n={before[-1]}")

    def given_up(self, like: DataFrame) -> DataFrame:
        """All keys that stayed missing for ``max_wait`` seconds, with their batch ``n``."""
        schema = self._schema(like).add("n", IntegerType())
        if not self._batches(f"{self.root}-expired"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}-expired")

    def resolve(self, batch_id: int, changes: DataFrame, store: DataFrame) -> DataFrame:
        """Ready rows of this batch's changes and of the keys waiting so far; call it for empty batches too."""
        now = self.clock()
        previous = self.waiting(batch_id - 1, changes)
        due = changes.select(*self.keys, OP, OFFSET).unionByName(
            previous.select(*self.keys, OP, OFFSET))
        found = versioned_lookup(due, store, self.table, self.keys, self.schema).persist()
        waiting = waiting_rows(found, self.keys, previous, now).persist()
        try:
            save = lambda df, root: df.write.mode("overwrite").parquet(f"{root}/n={batch_id}")
            save(expired_rows(waiting, now, self.max_wait), f"{self.root}-expired")
            ready = ready_rows(found, self.keys, self.schema)
            save(ready, f"{self.root}-ready")
            save(pending_rows(waiting, self.keys, now, self.max_wait), self.root)
        finally:
            waiting.unpersist()
            found.unpersist()
        self._clean(self.root, batch_id)
        self._clean(f"{self.root}-ready", batch_id)
        return self.spark.read.schema(ready.schema).parquet(f"{self.root}-ready/n={batch_id}")
