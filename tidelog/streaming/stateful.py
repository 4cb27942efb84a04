"""Keyed sync with Spark's state store: emits the new row of every changed key.

The state per key is the one of ``tidelog.operators.fold``: changes are taken in any order,
and nothing but the state is held. Every task first reduces its own changes to one row per
key and Arrow batch, so a hot key reaches the state as a few rows. Keys are dealt into ``BUCKETS``
groups by a hash and the state of a group is a map by key: what a group costs (a call, a frame in and one out,
an Arrow batch while the state is seeded) is paid once for all of its keys, and a batch still reads and writes
only the keys it touches. Offsets travel as whole numbers with a stand-in for null, keys and values as text, so that
nothing passes through floating point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, BooleanType, DataType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from tidelog.functions.reduce_batches import key_codes, newest_rows
from tidelog.operators.filters import effective_changes
from tidelog.operators.fold import ALIVE, DELETED_AT, LIVE_AT, lift_changes, lift_rows
from tidelog.spec import OFFSET, PARTITION, TableSpec

NEVER = -(1 << 63)
STATE = "row"
# keys deleted and the time (ms) at which they are forgotten
DOOMED = "doomed"
# a checkpoint is bound to this number
BUCKETS = 4096
# Spark hands a group's rows over as named tuples, so names may not begin with an underscore
BUCKET, DELETED, LIVE = "x_bucket", "x_deleted_at", "x_live_at"


def _text(value: Column, dtype: DataType) -> Column:
    if isinstance(dtype, TimestampType):  # as text two instants may look alike, where clocks are set back
        return F.unix_micros(value).cast("string")
    return F.base64(value) if isinstance(dtype, BinaryType) else value.cast("string")


def _typed(text: Column, dtype: DataType) -> Column:
    if isinstance(dtype, TimestampType):
        return F.timestamp_micros(text.cast("bigint"))
    return F.unbase64(text) if isinstance(dtype, BinaryType) else text.cast(dtype)


def _key(i: int) -> str:
    return f"x_k_{i}"


def _at(i: int) -> str:
    return f"x_at_{i}"


def _cell(i: int) -> str:
    return f"x_v_{i}"


def _key_names(spec: TableSpec) -> list[str]:
    return [_key(i) for i in range(len(spec.pk))]


def _key_schema(spec: TableSpec) -> StructType:
    return StructType([StructField(n, StringType()) for n in _key_names(spec)])


def _state_schema(spec: TableSpec) -> StructType:
    """Partition, newest offset, newest delete, newest live change, and each column's offset and text."""
    marks = [StructField(PARTITION, IntegerType()), *[StructField(n, LongType()) for n in (OFFSET, DELETED, LIVE)]]
    cells = [f for i in range(len(spec.columns)) for f in (StructField(_at(i), LongType()), StructField(_cell(i), StringType()))]
    return StructType([*marks, *cells])


def _output_schema(spec: TableSpec) -> StructType:
    return StructType([*_key_schema(spec).fields, StructField(ALIVE, BooleanType()),
                       *[StructField(_cell(i), StringType()) for i in range(len(spec.columns))],
                       StructField(PARTITION, IntegerType()), StructField(OFFSET, LongType())])


def _flat(states: DataFrame, spec: TableSpec) -> DataFrame:
    """States with plain columns, no null among the offsets, and the bucket of their key."""
    keys = [_text(F.col(f.name), f.dataType) for f in spec.key.fields]
    at = lambda c: F.coalesce(c.cast("bigint"), F.lit(NEVER))
    cells = [c for i, f in enumerate(spec.values)
             for c in (at(F.col(f.name)["at"]).alias(_at(i)), _text(F.col(f.name)["v"], f.dataType).alias(_cell(i)))]
    return states.select(F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias(BUCKET),
                         *[k.alias(n) for k, n in zip(keys, _key_names(spec))], F.coalesce(F.col(PARTITION).cast("int"), F.lit(-1)).alias(PARTITION),
                         at(F.col(OFFSET)).alias(OFFSET), at(F.col(DELETED_AT)).alias(DELETED), at(F.col(LIVE_AT)).alias(LIVE), *cells)


def _reduced(flat: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key and Arrow batch, holding the newer of every part."""
    pk, width = _key_names(spec), len(spec.columns)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = key_codes(batch, pk)
            newest = lambda name: newest_rows(codes, batch.column(name).to_numpy())
            first = newest(OFFSET)
            places = {name: first for name in (BUCKET, *pk, PARTITION, OFFSET)}
            places |= {name: newest(name) for name in (DELETED, LIVE)}
            for i in range(width):
                places[_at(i)] = places[_cell(i)] = newest(_at(i))
            yield pa.RecordBatch.from_arrays([batch.column(n).take(pa.array(places[n])) for n in batch.schema.names],
                                             schema=batch.schema)

    return flat.mapInArrow(reduce, flat.schema)


class KeyedSync(StatefulProcessor):
    """Combines states of the keys of a bucket; with ``keep_deleted`` seconds a key deleted so long ago is forgotten."""

    def __init__(self, spec: TableSpec, keep_deleted: float | None = None):
        self.pk, self.width = _key_names(spec), len(spec.columns)
        self.key_schema, self.schema, self.keep_deleted = _key_schema(spec), _state_schema(spec), keep_deleted
        self.output = _output_schema(spec).fieldNames()
        # (place of the offset in the state, places of what goes with it)
        self.parts = [(1, OFFSET, (0, PARTITION)), (2, DELETED, None), (3, LIVE, None)]
        self.parts += [(4 + 2 * i, _at(i), (5 + 2 * i, _cell(i))) for i in range(self.width)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getMapState(STATE, self.key_schema, self.schema)
        if self.keep_deleted is not None:
            self.doomed = handle.getMapState(DOOMED, self.key_schema, "due bigint")

    def _newest(self, frames: Iterator[pd.DataFrame]) -> dict[tuple, list]:
        """One state for each key among the rows, holding the newer of every part."""
        found: dict[tuple, list] = {}
        for frame in frames:
            if frame.empty:
                continue
            texts = [[v if isinstance(v, str) else None for v in frame[name]] for name in self.pk]
            numbers: dict[tuple, int] = {}
            codes = np.array([numbers.setdefault(key, len(numbers)) for key in zip(*texts)])
            states = [found.setdefault(key, [-1, NEVER, NEVER, NEVER, *[NEVER, None] * self.width]) for key in numbers]
            for place, name, beside in self.parts:
                at = frame[name].to_numpy()
                rows = newest_rows(codes, at)
                values = frame[beside[1]].to_numpy()[rows] if beside else rows
                for state, offset, value in zip(states, at[rows].tolist(), values.tolist()):
                    if offset > state[place]:
                        state[place] = offset
                        if beside:
                            state[beside[0]] = value if beside[1] == PARTITION or isinstance(value, str) else None
        return found

    def _combine(self, known: list, more: list) -> bool:
        """Take the newer parts of ``more`` over; whether there were any."""
        moved = False
        for place, _, beside in self.parts:
            if more[place] > known[place]:
                known[place], moved = more[place], True
                if beside:
                    known[beside[0]] = more[beside[0]]
        return moved

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found, shown = self._newest(rows), []
        seen_before, due = self.state.exists(), None
        for one, new in found.items():
            held = self.state.getValue(one) if seen_before else None
            known, was_dead = new, False
            if held is not None:
                known = list(held)
                was_dead = known[3] <= known[2]
                if not self._combine(known, new):
                    continue
            self.state.updateValue(one, tuple(known))
            partition, seen, deleted, live = known[:4]
            alive = live > deleted
            if self.keep_deleted is not None and not alive:
                due = timerValues.getCurrentProcessingTimeInMs() + round(1000 * self.keep_deleted)
                self.doomed.updateValue(one, (due,))
            elif self.keep_deleted is not None and was_dead:
                self.doomed.removeKey(one)
            cells = [value if at > deleted else None for at, value in zip(known[4::2], known[5::2])]
            shown.append((*one, alive, *cells, partition, seen))
        if due is not None and not any(at <= due for at in self.handle.listTimers()):
            self.handle.registerTimer(due)
        if shown:
            yield pd.DataFrame({name: pd.Series(values, dtype=object) for name, values in zip(self.output, zip(*shown))})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        # a bucket may come in several frames
        found, seen_before = self._newest(iter([initialState])), self.state.exists()
        for one, new in found.items():
            if seen_before and (held := self.state.getValue(one)) is not None:
                self._combine(new, list(held))
            self.state.updateValue(one, tuple(new))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Forgets what is due in the bucket; a timer for the next of what is left."""
        now = max(timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs())
        marks = [(one, due) for one, (due,) in self.doomed.iterator()]
        for one, due in marks:
            if due <= now:
                self.state.removeKey(one)
                self.doomed.removeKey(one)
        if later := [due for _, due in marks if due > now]:
            self.handle.registerTimer(min(later))
        return iter(())

    def close(self) -> None:
        pass


def stateful_sync(changes: DataFrame, spec: TableSpec, image: DataFrame | None = None,
                  keep_deleted: float | None = None) -> DataFrame:
    """Row-level changes of a streaming change frame: newest row per touched key and batch.

    ``image`` seeds the state in the first batch (one row per key). With ``keep_deleted`` a
    key is forgotten that many seconds after its delete, by a timer; it must exceed the time
    by which a change may come late, or an old change brings the key back.

    Needs the RocksDB state store provider. A key whose changes were all seen
    before emits nothing. Of two rows of one key the later batch's is current; a
    change delivered late alters the row but not its offset.
    """
    partition_type = changes.schema[PARTITION].dataType
    lifted = lift_changes(effective_changes(changes, spec), spec)
    seed = None if image is None else _flat(lift_rows(image, spec), spec).groupBy(BUCKET)
    emitted = _reduced(_flat(lifted, spec), spec).groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=KeyedSync(spec, keep_deleted), outputStructType=_output_schema(spec), outputMode="Update",
        timeMode="None" if keep_deleted is None else "ProcessingTime", initialState=seed)
    keys = [_typed(F.col(_key(i)), f.dataType).alias(f.name) for i, f in enumerate(spec.key.fields)]
    cells = [_typed(F.col(_cell(i)), f.dataType).alias(f.name) for i, f in enumerate(spec.values)]
    return emitted.select(*keys, ALIVE, *cells, F.col(PARTITION).cast(partition_type).alias(PARTITION), OFFSET)


def state_rows(spark: SparkSession, checkpoint: str, spec: TableSpec) -> DataFrame:
    """What the state of a ``stateful_sync`` holds, read from its checkpoint: key, ``ALIVE``, columns, offset."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", STATE).load()
    key, value = F.col("user_map_key"), F.col("user_map_value")
    keys = [_typed(key[_key(i)], f.dataType).alias(f.name) for i, f in enumerate(spec.key.fields)]
    shown = [_typed(F.when(value[_at(i)] > value[DELETED], value[_cell(i)]), f.dataType).alias(f.name)
             for i, f in enumerate(spec.values)]
    return state.select(*keys, (value[LIVE] > value[DELETED]).alias(ALIVE),
                        *shown, value[PARTITION].alias(PARTITION), value[OFFSET].alias(OFFSET))
