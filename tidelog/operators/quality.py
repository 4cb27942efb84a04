"""Checks of the assumptions the offset rules rest on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.spec import PARTITION


def split_keys(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose changes arrived in more than one partition (should be none)."""
    return (changes.groupBy(*keys)
            .agg(F.min(PARTITION).alias("first_partition"), F.max(PARTITION).alias("last_partition"))
            .filter(F.col("first_partition") != F.col("last_partition")))
