"""The keyed hash store as a data source: ``spark.read.format("tidelog_kv")``.

Rows are ``rk, field, value``; a write takes ``rk, field, value, op`` as in a mutation frame. Options: ``store``
names a factory as ``module:function``, called with all options wherever the store is needed, on the
driver and in every task. A read is dealt out by ranges of keys; conditions on ``rk``
(equality, membership, prefix, order) are given to the store. A write stages its rows per
task and publishes all of them at once; what a failed task has staged is never seen.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)

FORMAT = "tidelog_kv"
BATCH_ROWS = 4096
KEYS_PER_TASK = 1000
AFTER_ALL = None


class KeyedStore(Protocol):
    """What a store offers; keys are ordered by code point, a range is ``low <= key < high`` (null: no end)."""

    def split_points(self, parts: int) -> list[str]: ...
    def scan(self, low: str, high: str | None) -> Iterator[tuple[str, dict[str, str]]]: ...
    def get(self, keys: list[str]) -> Iterator[tuple[str, dict[str, str]]]: ...
    def stage(self, attempt: str, batches: Iterable[pa.RecordBatch]) -> list[str] | None: ...
    def publish(self, staged: dict[str, list[str]]) -> None: ...
    def discard(self, attempts: list[str]) -> None: ...


def _store(options) -> KeyedStore:
    module, _, name = options["store"].partition(":")
    return getattr(importlib.import_module(module), name)(dict(options))


def after_prefix(prefix: str) -> str | None:
    """The least text above all that begin with ``prefix``; null if there is none."""
    for end in range(len(prefix), 0, -1):
        code = ord(prefix[end - 1])
        if code < 0x10FFFF:
            following = 0xE000 if code == 0xD7FF else code + 1
            return prefix[:end - 1] + chr(following)
    return AFTER_ALL


@dataclass
class KeyRange(InputPartition):
    """A range of keys, or the keys themselves."""

    low: str = ""
    high: str | None = AFTER_ALL
    keys: list[str] | None = None


class KeyedReader(DataSourceReader):
    def __init__(self, options):
        self.options, self.parts = options, int(options.get("partitions", "8"))
        self.low, self.high, self.keys = "", AFTER_ALL, None

    def pushFilters(self, filters):
        """Takes conditions on the key and gives back the others."""
        for condition in filters:
            if getattr(condition, "attribute", None) != ("rk",) or not self._narrow(condition):
                yield condition

    def _narrow(self, condition) -> bool:
        if isinstance(condition, IsNotNull):
            return True  # a key is never null
        value = getattr(condition, "value", None)
        if isinstance(condition, (EqualTo, In)):
            asked = {v for v in (value if isinstance(condition, In) else (value,)) if v is not None}
            self.keys = sorted(asked if self.keys is None else asked & set(self.keys))
        elif isinstance(condition, StringStartsWith):
            self._between(value, after_prefix(value))
        elif isinstance(condition, GreaterThanOrEqual):
            self._between(value, AFTER_ALL)
        elif isinstance(condition, GreaterThan):
            self._between(value + "\x00", AFTER_ALL)
        elif isinstance(condition, LessThan):
            self._between("", value)
        elif isinstance(condition, LessThanOrEqual):
            self._between("", value + "\x00")
        else:
            return False
        return True

    def _between(self, low: str, high: str | None) -> None:
        self.low = max(self.low, low)
        if high is not AFTER_ALL:
            self.high = high if self.high is AFTER_ALL else min(self.high, high)

    def partitions(self) -> list[KeyRange]:
        inside = lambda k: self.low <= k and (self.high is AFTER_ALL or k < self.high)
        if self.keys is not None:
            keys = [k for k in self.keys if inside(k)]
            return [KeyRange(keys=keys[i:i + KEYS_PER_TASK]) for i in range(0, len(keys), KEYS_PER_TASK)] or [KeyRange(keys=[])]
        points = [p for p in _store(self.options).split_points(self.parts) if inside(p) and p != self.low]
        bounds = [self.low, *points, self.high]
        return [KeyRange(low, high) for low, high in zip(bounds[:-1], bounds[1:])]

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        store = _store(self.options)
        found = store.scan(partition.low, partition.high) if partition.keys is None else store.get(partition.keys)
        rows: list[tuple] = []
        for key, fields in found:
            for name, value in fields.items():
                rows.append((key, name, value))
                if len(rows) == BATCH_ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["rk", "field", "value"])


@dataclass
class Staged(WriterCommitMessage):
    """A task's rows and a few of their keys, null if it had none."""

    attempt: str
    marks: list[str] | None


class KeyedWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.options = options

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        attempt = uuid.uuid4().hex
        return Staged(attempt, _store(self.options).stage(attempt, iterator))

    def commit(self, messages) -> None:
        _store(self.options).publish({m.attempt: m.marks for m in messages if m is not None and m.marks is not None})

    def abort(self, messages) -> None:
        _store(self.options).discard([m.attempt for m in messages if m is not None])


class KeyedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "rk string, field string, value string"

    def reader(self, schema) -> KeyedReader:
        return KeyedReader(self.options)

    def writer(self, schema, overwrite: bool) -> KeyedWriter:
        if overwrite:
            raise ValueError("a keyed store is written to by mutations; use mode append")
        return KeyedWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with conditions on keys passed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(KeyedSource)


class FileKeyedStore:
    """A keyed store in files that all tasks can reach: sorted mutation files, made to count by numbered commits.

    ``root`` may be any address that ``pyarrow.fs`` opens. A commit lists its files and a sample of
    their keys. A read of a range takes the rows of that range from all files and lets later commits win.
    """

    MARKS = 32   # keys that a task's rows contribute to the split points

    def __init__(self, options: dict[str, str]):
        root = options["root"]
        self.fs, self.root = fs.FileSystem.from_uri(root if "://" in root else f"file://{root.removeprefix('file:')}")

    def _commits(self) -> list[dict]:
        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/commits", allow_not_found=True))
        names = sorted(f.path for f in found if f.base_name.endswith(".json"))
        return [json.loads(self.fs.open_input_stream(name).read()) for name in names]

    def _file(self, attempt: str) -> str:
        return f"{self.root}/staged/{attempt}.parquet"

    def _fold(self, condition) -> Iterator[tuple[str, dict[str, str]]]:
        held: dict[str, dict[str, str]] = {}
        for commit in self._commits():
            files = [self._file(a) for a in commit["attempts"]]
            rows = ds.dataset(files, filesystem=self.fs, format="parquet").to_table(filter=condition)
            # within a frame of mutations key deletes come first, and a field is written once
            for first in (True, False):
                for key, name, value, op in zip(*(rows[c].to_pylist() for c in ("rk", "field", "value", "op"))):
                    if (op == "del") is first:
                        if op == "del":
                            held.pop(key, None)
                        elif op == "hdel":
                            held.get(key, {}).pop(name, None)
                        else:
                            held.setdefault(key, {})[name] = value
        return ((key, fields) for key, fields in sorted(held.items()) if fields)

    def split_points(self, parts: int) -> list[str]:
        marks = sorted({mark for commit in self._commits() for mark in commit["marks"]})
        return sorted({marks[len(marks) * i // parts] for i in range(1, parts)}) if marks else []

    def scan(self, low: str, high: str | None) -> Iterator[tuple[str, dict[str, str]]]:
        condition = pc.field("rk") >= low
        return self._fold(condition if high is None else condition & (pc.field("rk") < high))

    def get(self, keys: list[str]) -> Iterator[tuple[str, dict[str, str]]]:
        return self._fold(pc.field("rk").isin(keys)) if keys else iter(())

    def hgetall_many(self, keys: list[str]) -> list[dict[str, str]]:
        """The hashes of the given keys, empty where there is none."""
        found = dict(self.get(keys))
        return [found.get(key, {}) for key in keys]

    def hgetall(self, key: str) -> dict[str, str]:
        return self.hgetall_many([key])[0]

    def stage(self, attempt: str, batches: Iterable[pa.RecordBatch]) -> list[str] | None:
        schema = pa.schema([(n, pa.string()) for n in ("rk", "field", "value", "op")])
        tables = [pa.Table.from_batches([batch]).select(schema.names).cast(schema) for batch in batches if batch.num_rows]
        if not tables:
            return None
        rows = pa.concat_tables(tables).sort_by("rk")
        self.fs.create_dir(f"{self.root}/staged", recursive=True)
        with self.fs.open_output_stream(self._file(attempt)) as out:
            pq.write_table(rows, out, row_group_size=BATCH_ROWS)
        step = max(1, rows.num_rows // self.MARKS)
        return rows["rk"].to_pylist()[step // 2::step]

    def publish(self, staged: dict[str, list[str]]) -> None:
        if not staged:
            return
        number = len(self._commits())
        self.fs.create_dir(f"{self.root}/commits", recursive=True)
        draft = f"{self.root}/commits/{number:08d}.draft"
        with self.fs.open_output_stream(draft) as out:
            out.write(json.dumps({"attempts": list(staged), "marks": sorted({m for own in staged.values() for m in own})}).encode())
        self.fs.move(draft, f"{self.root}/commits/{number:08d}.json")

    def discard(self, attempts: list[str]) -> None:
        for attempt in attempts:
            if self.fs.get_file_info(self._file(attempt)).type != fs.FileType.NotFound:
                self.fs.delete_file(self._file(attempt))


def file_store(options: dict[str, str]) -> FileKeyedStore:
    return FileKeyedStore(options)
