"""Written tables that cut the lineage of a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.session import work_dir


def written_table(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to a shared folder and read it back.

    The result no longer depends on the tasks that made it, so losing executors
    costs nothing already computed.
    """
    target = path or work_dir(df.sparkSession, "table")
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete the folder of a written table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def replace_slice_files(df: DataFrame, path: str, code_column: str) -> None:
    """Replace the partitions of a Parquet table whose code occurs in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(code_column).parquet(path))
