"""Micro-batch jobs over a change stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.fold import fold_changes
from tidelog.operators.hash_store import folded_mutations
from tidelog.operators.index_sync import index_mutations, sync_columns, touched_before_after
from tidelog.operators.merge import offset_gate
from tidelog.operators.parse import parse_changes
from tidelog.sinks.change_store import ChangeStore
from tidelog.spec import TableSpec

COMPACT_EVERY = 200

BatchFunction = Callable[[DataFrame, int], None]


def run_micro_batches(stream: DataFrame, on_batch: BatchFunction, checkpoint: str,
                      continuous: bool = False, interval: str = "10 seconds", name: str | None = None) -> StreamingQuery:
    """Start a query, ``name`` if given, that hands every micro-batch to ``on_batch``.

    Offsets are recorded in ``checkpoint`` after the function returns, so a failed
    batch is repeated. Unless ``continuous``, the query ends with the available data.
    """
    trigger = {"processingTime": interval} if continuous else {"availableNow": True}
    writer = stream.writeStream.foreachBatch(on_batch).trigger(**trigger).option("checkpointLocation", checkpoint)
    return (writer.queryName(name) if name else writer).start()


def sync_store(stream: DataFrame, spec: TableSpec, store: ChangeStore, checkpoint: str,
               continuous: bool = False, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Keep a change store in step with a raw change stream.

    Every ``compact_every`` batches the deltas are merged; what a compaction replaced
    is deleted at the next one, so that readers have that long to finish.
    """
    compact = _compaction(store, compact_every)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        store.append(parse_changes(batch, spec))
        compact(batch_id)

    return run_micro_batches(stream, on_batch, checkpoint, continuous)


def _compaction(store: ChangeStore, every: int) -> Callable[[int], None]:
    """Merge the deltas every so many batches; delete what the merge before has replaced.

    What is replaced stands in the manifest, so a restart in between leaves nothing behind.
    """
    def step(batch_id: int) -> None:
        if (batch_id + 1) % every == 0:
            replaced = store.replaced()
            store.compact()
            store.retire(replaced)

    return step


def sync_hashes(stream: DataFrame, spec: TableSpec, store: ChangeStore, checkpoint: str,
                write: Callable[[DataFrame], None], pseudo_keys: list[list[str]] | None = None,
                value_columns: list[str] | None = None, continuous: bool = False,
                compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Mirror a change stream into a hash store, with optional secondary hashes.

    ``store`` keeps the table state and gives the old rows of the touched keys.
    ``write`` receives a mutation frame, for instance
    ``tidelog.sinks.hash_writer.write_mutations``. The first batch after a start is
    gated by the store's zone maps of offsets: it may have been applied before. Mutations
    are written before the store moves on, so an interrupted batch is derived anew.
    The changes of a key must come in the order of their offsets, as a topic gives them.
    The store keeps all columns of ``spec``; ``value_columns`` only narrows what is
    written. Partition and offset are written for every effective change of the table, whatever
    columns it has, so that a lookup does not take the hash for stale. Deltas are merged every
    ``compact_every`` batches.
    """
    first = True
    pseudo_keys = pseudo_keys or []
    value_columns = value_columns or spec.columns
    kept = sync_columns(spec, pseudo_keys, value_columns)
    compact = _compaction(store, compact_every)
    narrow = TableSpec(spec.name, spec.key, type(spec.values)([spec.values[c] for c in kept]))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        nonlocal first
        parsed = parse_changes(batch, spec)
        changes = (offset_gate(parsed, store.applied_offsets()) if first else parsed).persist()
        folded = fold_changes(changes, spec).persist()
        try:
            if pseudo_keys:
                before = store.rows_of(folded)
                touched = touched_before_after(before, folded, narrow)
                write(index_mutations(touched, narrow, pseudo_keys, value_columns))
            write(folded_mutations(folded, narrow, versioned_by=spec.columns))
            store.append(changes)
            first = False
            compact(batch_id)
        finally:
            folded.unpersist()
            changes.unpersist()

    return run_micro_batches(stream, on_batch, checkpoint, continuous)
