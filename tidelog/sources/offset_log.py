"""Offset logs of streaming applications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.lag import log_number, newest_log, offset_log_entries


def read_offset_log(spark: SparkSession, root: str) -> DataFrame:
    """Newest offsets below ``<root>/<app>/offsets/<n>`` for every application.

    The newest file of each application is chosen by its name; only these files (one
    path per application reaches the driver) are opened.
    """
    listed = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/offsets/*").select("path")
    paths = [r.path for r in newest_log(log_number(listed)).select("path").collect()]
    if not paths:
        return offset_log_entries(spark.createDataFrame([], "path string, value string"))
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    return offset_log_entries(lines)
