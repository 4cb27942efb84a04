"""Writing mutation frames to an external hash store, and reading hashes from it, on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.hash_store import DEL, HDEL


class HashClient(Protocol):
    """Operations of a hash store client."""

    def hset(self, key: str, mapping: dict[str, str]) -> object: ...
    def hdel(self, key: str, *fields: str) -> object: ...
    def delete(self, *keys: str) -> object: ...
    def hgetall(self, key: str) -> dict[str, str]: ...


def write_mutations(mutations: DataFrame, connect: Callable[[], HashClient], chunk: int = 1000) -> None:
    """Apply a mutation frame: key deletes first, then field deletes and writes.

    ``connect`` is called once per task. In the second step every field occurs
    once, so entries are written wherever they are; a hash holding most fields is
    written by many tasks. Repeating a batch leaves the store as it is.
    """
    def delete_keys(rows: Iterable) -> None:
        client = connect()
        for part in _chunks(rows, chunk):
            client.delete(*[row.rk for row in part])

    def write_fields(rows: Iterable) -> None:
        client = connect()
        for part in _chunks(rows, chunk):
            writes: dict[str, dict[str, str]] = {}
            deletes: dict[str, list[str]] = {}
            for row in part:
                if row.op == HDEL:
                    deletes.setdefault(row.rk, []).append(row.field)
                else:
                    writes.setdefault(row.rk, {})[row.field] = row.value
            for key, fields in deletes.items():
                client.hdel(key, *fields)
            for key, mapping in writes.items():
                client.hset(key, mapping=mapping)

    is_key_delete = F.col("op") == DEL
    kept = mutations.persist()  # two steps over one derivation
    try:
        kept.filter(is_key_delete).select("rk").distinct().foreachPartition(delete_keys)
        kept.filter(~is_key_delete).foreachPartition(write_fields)
    finally:
        kept.unpersist()


def fetch_hashes(wanted: DataFrame, connect: Callable[[], HashClient], keys_per_call: int = 500,
                 batch_rows: int = 10_000) -> DataFrame:
    """``rk``, ``field``, ``value`` of the hashes named by ``wanted.rk`` that exist in an external store.

    Keys are asked for once each, by as many tasks as there are partitions of distinct
    keys, with one client per task: ``keys_per_call`` keys in one round trip where the client has
    ``hgetall_many``, else one by one. Batches of at most ``batch_rows`` fields are passed on as they
    fill, also within a large hash. The result serves as the store of
    ``decode_store``, ``index_rows`` and ``versioned_lookup``. Null keys are left out.
    """
    def hashes(client: HashClient, keys: list[str]) -> Iterable[tuple[str, dict[str, str]]]:
        many = getattr(client, "hgetall_many", None)
        for part in _chunks(keys, keys_per_call):
            yield from zip(part, many(part) if many else map(client.hgetall, part))

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        client = connect()
        entries = ((key, field, value) for batch in batches for key, fields in hashes(client, batch["rk"].to_pylist())
                   for field, value in fields.items())
        for rows in _chunks(entries, batch_rows):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["rk", "field", "value"])

    keys = wanted.select("rk").filter("rk IS NOT NULL").distinct()
    return keys.mapInArrow(fetch, "rk string, field string, value string")


def _chunks(rows: Iterable, size: int):
    part = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part
