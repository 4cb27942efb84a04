"""Bounded samples of labelled rows, and the parts of a table that are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 1 << 40


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def class_sample(rows: DataFrame, label: str, per_class: int, key: str = "doc_id") -> DataFrame:
    """About ``per_class`` rows of each value of ``label`` (all, where there are fewer), chosen by a hash of ``key``.

    No more than twice that many are returned in all, whatever the keys. One row per
    value of ``label`` reaches the driver.
    """
    counts = {r[label]: r["n"] for r in rows.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return rows.limit(0)
    limits = F.create_map(*[F.lit(x) for value, n in sorted(counts.items()) for x in (value, int(STEPS * min(1.0, per_class / n)))])
    hashed = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(label)), F.lit(STEPS))
    return rows.filter(hashed < F.element_at(limits, F.col(label))).limit(2 * per_class * len(counts))
