"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16
SMALL_ROWS = 10_000


def spread_join(big: DataFrame, unique: DataFrame, on: list[str], how: str,
                by: list[str], salts: int = SALTS) -> DataFrame:
    """Join ``big`` (left) to a side with at most one row per key.

    The rows of one key are spread over ``salts`` tasks by a hash of the columns
    ``by``; the unique side is repeated once per salt. ``how`` is any join kind
    that keeps left rows: inner, left, left_semi or left_anti.
    """
    salted = big.withColumn("__salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    repeated = unique.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "__salt"], how).drop("__salt")


def spread_small_input(df: DataFrame, by: str) -> DataFrame:
    """Give an input of fewer splits than cores to all cores, for costly row work.

    Large inputs have more splits than cores and stay as they are, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, by) if df.rdd.getNumPartitions() < cores else df


def pin_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> tuple[DataFrame, bool]:
    """Evaluate ``df`` if it has at most ``max_rows`` rows, so it may be broadcast.

    Returns the frame to use and whether its size is proven. At most
    ``max_rows + 1`` rows are fetched; a larger frame is returned as it was.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows:
        return df, False
    return df.sparkSession.createDataFrame(head, df.schema), True


def join_unique(big: DataFrame, unique: DataFrame, on: list[str], how: str,
                by: list[str], max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast ``unique`` when its size is checked, else join spread over salts."""
    pinned, small = pin_small(unique, max_rows)
    if small:
        return big.join(F.broadcast(pinned), on, how)
    return spread_join(big, unique, on, how, by)
