"""Change streams from Kafka or files, with the same five columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_SCHEMA = "KEY string, VALUE string, topic string, partition int, offset bigint"
MAX_OFFSETS_PER_TRIGGER = 10_000


def project_raw(records: DataFrame) -> DataFrame:
    """Binary key and value as text, with topic, partition and offset."""
    return records.selectExpr("CAST(key AS STRING) AS KEY", "CAST(value AS STRING) AS VALUE",
                              "topic", "partition", "offset")


def kafka_options(servers: str, topics: str, starting: str = "latest",
                  max_offsets: int = MAX_OFFSETS_PER_TRIGGER,
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    """Reader options; with ``fail_on_data_loss=False`` offsets the topic has lost are passed over."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(max_offsets),
    }


def kafka_stream(spark: SparkSession, servers: str, topics: str, starting: str = "latest",
                 max_offsets: int = MAX_OFFSETS_PER_TRIGGER, fail_on_data_loss: bool = True) -> DataFrame:
    """Kafka change stream (needs the Kafka connector on the class path); see ``kafka_options``."""
    options = kafka_options(servers, topics, starting, max_offsets, fail_on_data_loss)
    return project_raw(spark.readStream.format("kafka").options(**options).load())


def file_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Change stream from Parquet files with the columns of ``RAW_SCHEMA``."""
    reader = spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def empty_changes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_SCHEMA)
