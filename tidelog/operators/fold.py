"""Replay of a change log to one row per key, as a mergeable aggregate.

A change is lifted to a *state*: the newest offset seen, the newest delete, the
newest live change, and for every column the newest value with its offset. Two
states of one key combine by keeping the newer of each part. Combining is
associative, commutative and idempotent, so a log may be folded in pieces, in any
order and with repetitions: every task first combines its own rows, a hot key
reaches the shuffle as one row per task, and replayed batches change nothing.
A column value older than the newest delete does not survive it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.filters import is_effective
from tidelog.spec import DELETE, INSERT, OFFSET, OP, PARTITION, UPDATE, TableSpec

DELETED_AT = "__deleted_at"
LIVE_AT = "__live_at"
ALIVE = "__alive"
RESET = "__reset"


def lift_changes(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """One state per change; the state of a change without effect is empty.

    Such changes are blanked here and not filtered: a filter would be pushed into
    the parsing and evaluate part of it twice.
    """
    offset = F.when(is_effective(spec), F.col(OFFSET))
    live = F.col(OP).isin(INSERT, UPDATE)
    return changes.select(
        *spec.pk, PARTITION, offset.alias(OFFSET),
        F.when(F.col(OP) == DELETE, offset).alias(DELETED_AT),
        F.when(live, offset).alias(LIVE_AT),
        *[F.when(live & F.col(c).isNotNull(),
                 F.struct(offset.alias("at"), F.col(c)["v"].alias("v"))).alias(c)
          for c in spec.columns],
    )


def lift_rows(image: DataFrame, spec: TableSpec) -> DataFrame:
    """States of the rows of a table image, every column known at the row's offset."""
    offset = F.coalesce(F.col(OFFSET), F.lit(-1)).cast("bigint")
    return image.select(
        *spec.pk, PARTITION, offset.alias(OFFSET),
        F.lit(None).cast("bigint").alias(DELETED_AT), offset.alias(LIVE_AT),
        *[F.struct(offset.alias("at"), F.col(c).alias("v")).alias(c) for c in spec.columns],
    )


def combine_states(states: DataFrame, spec: TableSpec) -> DataFrame:
    """One state per key that has any."""
    combined = states.groupBy(*spec.pk).agg(
        F.max_by(PARTITION, OFFSET).alias(PARTITION),
        F.max(OFFSET).alias(OFFSET),
        F.max(DELETED_AT).alias(DELETED_AT),
        F.max(LIVE_AT).alias(LIVE_AT),
        *[F.max_by(c, F.col(c)["at"]).alias(c) for c in spec.columns],
    )
    return combined.filter(F.col(OFFSET).isNotNull())


def finish_states(states: DataFrame, spec: TableSpec) -> DataFrame:
    """Folded changes: alive and reset flags, presence structs after the last delete."""
    deleted = F.col(DELETED_AT)
    survives = lambda at: at.isNotNull() & (deleted.isNull() | (at > deleted))
    return states.select(
        *spec.pk, PARTITION, OFFSET,
        survives(F.col(LIVE_AT)).alias(ALIVE),
        deleted.isNotNull().alias(RESET),
        *[F.when(survives(F.col(c)["at"]), F.struct(F.col(c)["v"].alias("v"))).alias(c)
          for c in spec.columns],
    )


def fold_changes(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Net effect of a change log per key."""
    return finish_states(combine_states(lift_changes(changes, spec), spec), spec)


def current_rows(folded: DataFrame, spec: TableSpec) -> DataFrame:
    """Table image of the keys that are alive."""
    return folded.filter(F.col(ALIVE)).select(
        *spec.pk, *[F.col(c)["v"].alias(c) for c in spec.columns], PARTITION, OFFSET)
