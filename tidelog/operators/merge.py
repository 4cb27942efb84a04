"""Merging a change batch into a table image."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.skew import SMALL_ROWS, join_unique, pin_small
from tidelog.operators.filters import effective_changes
from tidelog.operators.fold import ALIVE, RESET, fold_changes
from tidelog.spec import OFFSET, PARTITION, TableSpec


def max_offset_per_partition(image: DataFrame) -> DataFrame:
    """Last offset the image holds of every partition, sorted by partition."""
    return (image.filter(F.col(PARTITION).isNotNull())
            .groupBy(PARTITION).agg(F.max(OFFSET).alias("MAX_KFK_OFFSET"))
            .orderBy(PARTITION))


def offset_gate(changes: DataFrame, image: DataFrame) -> DataFrame:
    """Changes newer than what the image holds of their partition.

    Evaluates the per-partition maxima (one row per partition) to prove that they
    may be broadcast; a partition unknown to the image admits everything.
    """
    applied = image.filter(F.col(PARTITION).isNotNull()).groupBy(PARTITION).agg(
        F.max(OFFSET).alias("MAX_KFK_OFFSET"))
    marked = join_unique(changes, applied, [PARTITION], "left", by=[OFFSET])
    newer = F.col(OFFSET) > F.coalesce(F.col("MAX_KFK_OFFSET"), F.lit(-1))
    return marked.filter(newer).select(*changes.columns)


def overlay(image: DataFrame, folded: DataFrame, spec: TableSpec, how: str = "full_outer") -> DataFrame:
    """Image rows updated, inserted and deleted by folded changes."""
    new = folded.select(*spec.pk, *[F.col(c).alias(f"__n_{c}") for c in folded.columns if c not in spec.pk])
    joined = image.join(new, spec.pk, how)
    touched = F.col(f"__n_{ALIVE}").isNotNull()
    kept = joined.filter(~touched | F.col(f"__n_{ALIVE}"))

    def merged(name: str):
        cell = F.col(f"__n_{name}")
        return (F.when(cell.isNotNull(), cell["v"])
                .when(F.coalesce(F.col(f"__n_{RESET}"), F.lit(False)), F.lit(None))
                .otherwise(F.col(name)).alias(name))

    meta = [F.coalesce(F.col(f"__n_{m}"), F.col(m)).alias(m) for m in (PARTITION, OFFSET)]
    return kept.select(*spec.pk, *[merged(c) for c in spec.columns], *meta)


def merge_snapshot(image: DataFrame, changes: DataFrame, spec: TableSpec,
                   partitions: int | None = None, applied: DataFrame | None = None) -> DataFrame:
    """Next image: gate, fold, overlay, and optionally repartition by key.

    ``applied`` holds the largest offset per partition where it is known (``ChangeStore.applied_offsets``);
    without it the image is read for it.
    """
    folded = fold_changes(offset_gate(effective_changes(changes, spec), image if applied is None else applied), spec)
    merged = overlay(image, folded, spec)
    return merged.repartition(partitions, *spec.pk) if partitions else merged


def merge_small_batch(image: DataFrame, changes: DataFrame, spec: TableSpec,
                      max_keys: int = SMALL_ROWS, applied: DataFrame | None = None) -> DataFrame:
    """``merge_snapshot`` for a micro-batch against a large image.

    When the changes mention at most ``max_keys`` keys (checked before they are
    folded) the image is filtered by the broadcast keys and never shuffled;
    otherwise this is the plain merge. Only keys pass through the driver. ``applied`` is that of
    ``merge_snapshot`` and spares a scan of the image.
    """
    effective = effective_changes(changes, spec)
    folded = fold_changes(offset_gate(effective, image if applied is None else applied), spec)
    keys, small = pin_small(effective.select(*spec.pk).distinct(), max_keys)
    if not small:
        return overlay(image, folded, spec)
    touched = keys.withColumn("__touched", F.lit(True))
    marked = image.join(F.broadcast(touched), spec.pk, "left")
    untouched = marked.filter("__touched IS NULL").drop("__touched")
    before = marked.filter("__touched").drop("__touched")
    return untouched.select(*spec.pk, *spec.columns, PARTITION, OFFSET).unionByName(
        overlay(before, folded, spec))
