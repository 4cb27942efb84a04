"""Freshness-checked lookups whose waiting keys are woken by the store's own changes.

Changes and updates of the store meet in one keyed state: the stored row with its offset,
and the change that waits for it. A batch costs what arrives in it; the store itself is read
once, as the seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tidelog.functions.reduce_batches import key_codes, newest_rows
from tidelog.operators.versioned_lookup import MISSING, OK, STALE, UNVERSIONED
from tidelog.spec import DELETE, INSERT, OFFSET, OP
from tidelog.streaming.pending import MAX_WAIT

LATE, EXPIRED = "late", "expired"
NEVER = -(1 << 63)
GONE = "__gone"
# Spark hands a group's rows over as named tuples, so names may not begin with an underscore
UPDATE_OF_STORE, REMOVED, OPERATION = "x_stored", "x_gone", "x_op"


def _events(changes: DataFrame, updates: DataFrame, keys: list[str], schema: StructType) -> DataFrame:
    """Both inputs in one layout: changes with their operation, store updates with their columns as text."""
    offset = F.coalesce(F.col(OFFSET).cast("bigint"), F.lit(NEVER)).alias(OFFSET)
    columns = [f.name for f in schema]
    asked = changes.select(*keys, F.lit(False).alias(UPDATE_OF_STORE), offset, F.col(OP).alias(OPERATION), F.lit(False).alias(REMOVED),
                           *[F.lit(None).cast("string").alias(f"x_v_{i}") for i in range(len(columns))])
    stored = updates.select(*keys, F.lit(True).alias(UPDATE_OF_STORE), offset, F.lit(None).cast("string").alias(OPERATION),
                            F.col(GONE).alias(REMOVED), *[F.col(c).cast("string").alias(f"x_v_{i}") for i, c in enumerate(columns)])
    return asked.unionByName(stored)


def _newest(events: DataFrame, keys: list[str]) -> DataFrame:
    """The newest change and the newest store update per key and Arrow batch."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                kept = newest_rows(key_codes(batch, [*keys, UPDATE_OF_STORE]), batch.column(OFFSET).to_numpy())
                yield batch.take(pa.array(kept))

    return events.mapInArrow(reduce, events.schema)


class Wakeup(StatefulProcessor):
    """States of a key: the stored row (offset and texts), and the change that waits (operation, offset)."""

    def __init__(self, key: StructType, schema: StructType, max_wait: float):
        self.width, self.max_wait = len(schema), max_wait
        texts = [StructField(f"x_v_{i}", StringType()) for i in range(self.width)]
        self.row = StructType([StructField(OFFSET, LongType()), *texts])
        self.asked = StructType([StructField(OP, StringType()), StructField(OFFSET, LongType())])
        self.output = StructType([*key.fields, StructField(OP, StringType()), StructField(OFFSET, LongType()),
                                  StructField("outcome", StringType()), StructField("found", BooleanType()), *texts])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stored = handle.getValueState("stored", self.row)
        self.waiting = handle.getValueState("waiting", self.asked)

    def _take(self, frame: pd.DataFrame) -> tuple[str, int] | None:
        """Keep the newest store update of a frame; give back its newest change."""
        updates = frame[frame[UPDATE_OF_STORE].astype(bool)]
        if len(updates):
            at = int(updates[OFFSET].to_numpy().argmax())
            offset = int(updates[OFFSET].iat[at])
            # an update without offset is taken as it comes
            if not self.stored.exists() or offset == NEVER or offset >= self.stored.get()[0]:
                if updates[REMOVED].iat[at]:
                    self.stored.clear()
                else:
                    texts = [updates[f"x_v_{i}"].iat[at] for i in range(self.width)]
                    self.stored.update((offset, *[t if isinstance(t, str) else None for t in texts]))
        changes = frame[~frame[UPDATE_OF_STORE].astype(bool)]
        if not len(changes):
            return None
        at = int(changes[OFFSET].to_numpy().argmax())
        return changes[OPERATION].iat[at], int(changes[OFFSET].iat[at])

    def _judge(self, op: str, offset: int) -> str:
        """The status of a change by what is stored."""
        if not self.stored.exists():
            return MISSING
        stored = self.stored.get()[0]
        if op == INSERT:
            return OK
        return UNVERSIONED if stored == NEVER else STALE if stored < offset else OK

    def _stop_timers(self) -> None:
        for due in list(self.handle.listTimers()):
            self.handle.deleteTimer(due)

    def _emit(self, key, op: str, offset: int, outcome: str) -> pd.DataFrame:
        ready = outcome in (OK, LATE)
        texts = self.stored.get()[1:] if ready else [None] * self.width
        row = [*key, op, offset, outcome, ready, *texts]
        return pd.DataFrame({name: pd.Series([value], dtype=object) for name, value in zip(self.output.fieldNames(), row)})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = self.waiting.get() if self.waiting.exists() else None
        waited = newest
        for frame in rows:
            change = self._take(frame)
            if change and (newest is None or change[1] > newest[1]):
                newest = change
        if newest is None:
            return
        op, offset = newest
        status = None if op == DELETE else self._judge(op, offset)
        if status in (None, OK):
            self._stop_timers()
            self.waiting.clear()
            if status:
                yield self._emit(key, op, offset, LATE if newest == waited else OK)
        elif newest != waited:
            self._stop_timers()
            self.waiting.update((op, offset))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + max(1, round(1000 * self.max_wait)))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._take(initialState)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.waiting.exists():
            op, offset = self.waiting.get()
            self.waiting.clear()
            status = self._judge(op, offset)
            yield self._emit(key, op, offset, EXPIRED if status == MISSING else status)

    def close(self) -> None:
        pass


def lookup_wakeups(changes: DataFrame, updates: DataFrame, keys: list[str], schema: StructType,
                   seed: DataFrame | None = None, max_wait: float = MAX_WAIT) -> DataFrame:
    """Outcome of the newest change of every key, once it is known; streaming.

    ``changes`` has the keys, the operation and the offset. ``updates`` is the stream of the
    store's own rows: keys, ``KFK_OFFSET`` (null: written without), ``__gone`` (true: the row was
    deleted) and the columns of ``schema``; ``seed`` has the same columns and holds what was
    stored before, one row per key.

    Outcomes: ``ok`` with the stored columns, ``late`` likewise for a key that waited and was
    woken by an update; after ``max_wait`` seconds ``expired`` for a key that stayed missing, and
    ``stale`` or ``unversioned`` for one whose row stayed behind (an error to the caller, see
    ``fail_on_stale``). A newer change of a waiting key starts anew; a delete ends the waiting
    without an outcome, and so does an older change. Updates that come with a change in
    one batch count before it. Needs the RocksDB state store provider.
    """
    key = StructType([changes.schema[k] for k in keys])
    processor = Wakeup(key, schema, max_wait)
    seeded = None
    if seed is not None:
        none = changes.sparkSession.createDataFrame([], StructType([*key.fields, StructField(OP, StringType()), StructField(OFFSET, LongType())]))
        seeded = _events(none, seed, keys, schema).groupBy(*keys)
    found = _newest(_events(changes, updates, keys, schema), keys).groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.output, outputMode="Update", timeMode="ProcessingTime",
        initialState=seeded)
    columns = [F.col(f"x_v_{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(schema) if f.name not in keys]
    return found.select(*keys, OP, OFFSET, "outcome", *columns)


def fail_on_stale(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """The outcomes; evaluating them fails if the store stayed behind a key for too long."""
    message = F.concat_ws(" ", F.lit("hash store still"), "outcome", F.lit("for key"), *[F.col(k).cast("string") for k in keys])
    late = F.col("outcome").isin(STALE, UNVERSIONED)
    return outcomes.withColumn("outcome", F.when(late, F.raise_error(message).cast("string")).otherwise(F.col("outcome")))
