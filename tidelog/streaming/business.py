"""The business job: changes to enriched upserts and tombstones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidelog.operators.enrich import vanished_keys
from tidelog.operators.parse import parse_changes
from tidelog.operators.records import connect_records
from tidelog.spec import TableSpec
from tidelog.streaming.stats import BatchStats

Step = Callable[[DataFrame], DataFrame]
BatchStep = Callable[[DataFrame, int], DataFrame]
Emit = Callable[[DataFrame], None]


def enriched_batch(spec: TableSpec, topic: str, select: Step, touched: BatchStep, result: BatchStep,
                   key_columns: list[str], value_columns: list[str], emit: Emit,
                   stats: BatchStats | None = None,
                   waiting: Callable[[int], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """Batch function for ``run_micro_batches``.

    ``select`` filters the parsed changes, ``touched`` gives the output keys they
    may affect, ``result`` the rows to send; both get the batch's number. Touched keys
    without a result become tombstones, which are emitted before the upserts, except
    keys that a lookup still waits for (``waiting``, asked after ``result``). With
    ``waiting``, empty batches are worked on too, so that waiting keys are tried again.
    A failure in between repeats the batch, so delivery is at least once.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        changes = select(parse_changes(batch, spec)).persist()
        rows = None
        try:
            if waiting is None and changes.isEmpty():
                return
            counted = stats.observe(batch_id, "changes", changes) if stats else changes
            rows = result(counted, batch_id).persist()
            gone = vanished_keys(touched(changes, batch_id), rows, key_columns)
            if waiting is not None:
                gone = gone.join(waiting(batch_id).select(*key_columns), key_columns, "left_anti")
            emit(connect_records(gone, topic, key_columns))
            outgoing = stats.observe(batch_id, "rows sent", rows) if stats else rows
            emit(connect_records(outgoing, topic, key_columns, value_columns))
        finally:
            if rows is not None:
                rows.unpersist()
            changes.unpersist()

    return on_batch
