"""Writing output records to Kafka or files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_kafka(records: DataFrame, servers: str, topic: str, compression: str | None = None) -> None:
    """Append ``key``/``value`` (or ``value``) records to a topic."""
    writer = (records.write.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("topic", topic))
    if compression:
        writer = writer.option("kafka.compression.type", compression)
    writer.save()


def write_record_files(records: DataFrame, path: str, mode: str = "append") -> None:
    """Keep records as Parquet files, for replays and tests."""
    records.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a folder of headerless CSV files."""
    df.write.mode("overwrite").option("header", False).csv(path)
