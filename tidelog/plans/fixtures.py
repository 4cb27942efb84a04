"""Change log, images and store contents derived from the given tables.

Every event is one change of the table EVT keyed by user: the event type gives the
operation and the columns the change mentions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType

from tidelog.functions.skew import spread_small_input
from tidelog.operators.fold import current_rows, fold_changes
from tidelog.operators.parse import parse_changes, parse_operations
from tidelog.sinks.tables import written_table
from tidelog.spec import OFFSET, PARTITION, TableSpec

EVT = TableSpec.of("EVT", key={"user_id": LongType()},
                   values={"AMT": DecimalType(12, 2), "TAG": StringType(), "PROPS": StringType()})
PARTITIONS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _payload(**fields: Column) -> Column:
    row = F.struct(*[c.alias(n) for n, c in fields.items()])
    return F.to_json(F.struct(row.alias("payload")), {"ignoreNullFields": "false"})


def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a topic would deliver it: JSON key and value with partition and offset."""
    columns = ["event_id", "user_id", "event_type", "value", "props"]
    events = spread_small_input(table(spark, sf_dir, "events").select(*columns), "event_id")
    key, kind = F.col("user_id"), F.col("event_type")
    amount = F.col("value").cast("decimal(12,2)")
    update = {"user_id": key, "__OP_TYPE": F.lit("U")}
    value = (
        F.when(kind == "signup", _payload(user_id=key, AMT=amount, TAG=F.lit("signup"),
                                          PROPS=F.col("props"), __OP_TYPE=F.lit("I")))
        .when(kind == "click", _payload(AMT=amount, **update))
        .when(kind == "purchase", _payload(AMT=amount, PROPS=F.col("props"), **update))
        .when((kind == "view") & (F.col("event_id") % 2 == 0),
              _payload(AMT=F.lit(None).cast("decimal(12,2)"), TAG=F.lit("view"), **update))
        .when(kind == "view", _payload(**update)))
    return events.select(
        _payload(user_id=key).alias("KEY"), value.alias("VALUE"), F.lit("events").alias("topic"),
        (key % PARTITIONS).cast("int").alias("partition"), F.col("event_id").alias("offset"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_changes(raw_changes(spark, sf_dir), EVT)


def change_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, operation and offset of every change; no value column is parsed."""
    return parse_operations(raw_changes(spark, sf_dir), EVT)


def log_position(spark: SparkSession, sf_dir: str, tenths: int) -> int:
    """First offset after the given tenths of the log."""
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    return 0 if last is None else -(-(last + 1) * tenths // 10)


def image(log: DataFrame) -> DataFrame:
    return current_rows(fold_changes(log, EVT), EVT)


def early_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image of the first 60 % of the log by offset, as a stored table."""
    return written_table(
        image(changes(spark, sf_dir).filter(F.col(OFFSET) < log_position(spark, sf_dir, 6))))


def late_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 60 % of the log: it overlaps the image by 20 %."""
    return changes(spark, sf_dir).filter(F.col(OFFSET) >= log_position(spark, sf_dir, 4))


def lagging_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a sync job would have stored that is behind on the upper half of the partitions."""
    applied = (F.col(PARTITION) < PARTITIONS // 2) | (F.col(OFFSET) < log_position(spark, sf_dir, 6))
    return image(changes(spark, sf_dir).filter(applied))


def lag_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumer status samples: one per event, the user standing for the consumer."""
    event, kind = F.col("event_id"), F.col("event_type")
    status = (F.when(event % 50 == 0, "STALL")
              .when(kind.isin("error", "click", "view"), "ERR")
              .when(kind == "signup", "WARN")
              .when(kind == "purchase", "OK"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("consumer"), event.alias("sample_no"), status.alias("status"),
        F.concat(F.lit("t"), event % 3).alias("topic"), (event % 100).alias("current_lag"))


def dirty_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with unfit values: text and overflows in the amount, text in the key, records cut off."""
    offset, payload = F.col("offset"), F.col("VALUE")
    amount = lambda text: F.regexp_replace(payload, r'"AMT":[-0-9.E]+', f'"AMT":{text}')
    value = (F.when(offset % 7 == 0, amount('"abc"')).when(offset % 7 == 1, amount("99999999999.99"))
             .when(offset % 7 == 2, F.substring(payload, 1, 12)).otherwise(payload))
    key = F.when(offset % 11 == 0, F.lit('{"payload":{"user_id":"x"}}')).otherwise(F.col("KEY"))
    without_key = F.regexp_replace(value, r'"user_id":[0-9]+,', "")
    return raw_changes(spark, sf_dir).withColumns({"VALUE": F.when(offset % 11 == 0, without_key).otherwise(value), "KEY": key})


def offset_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset files 0, 9 and 10 of one application per event type: after a third, two thirds and all of the log."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    last = [log_position(spark, sf_dir, 10) * part // 3 for part in (1, 2, 3)]
    number = F.explode(F.array(*[F.when(F.col("event_id") < end, n) for n, end in zip((0, 9, 10), last)])).alias("n")
    reached = (events.select("*", number).filter("n IS NOT NULL")
               .groupBy(F.col("event_type").alias("app"), "n", F.concat(F.lit("t"), F.col("event_id") % 3).alias("topic"),
                        (F.col("user_id") % PARTITIONS).cast("string").alias("p"))
               .agg(F.max("event_id").alias("o")))
    topics = reached.groupBy("app", "n", "topic").agg(
        F.map_from_entries(F.collect_list(F.struct("p", "o"))).alias("partitions"))
    files = topics.groupBy("app", "n").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("topic", "partitions")))).alias("offsets"))
    lines = F.array(F.lit("v1"), F.lit('{"batchWatermarkMs":0,"conf":{}}'), F.col("offsets"))
    return files.select("app", "n", F.posexplode(lines).alias("line", "value"))


def offset_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the offset logs of one application per event type, 500 events a batch.

    Each file has a version line, a metadata line and the highest offset reached in
    the batch per topic and partition.
    """
    reached = (table(spark, sf_dir, "events")
               .groupBy(F.col("event_type").alias("app"), F.floor(F.col("event_id") / 500).alias("n"),
                        F.concat(F.lit("t"), F.col("event_id") % 3).alias("topic"),
                        (F.col("user_id") % PARTITIONS).cast("string").alias("p"))
               .agg(F.max("event_id").alias("o")))
    topics = reached.groupBy("app", "n", "topic").agg(
        F.map_from_entries(F.collect_list(F.struct("p", "o"))).alias("partitions"))
    files = topics.groupBy("app", "n").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("topic", "partitions")))).alias("offsets"))
    lines = F.array(F.lit("v1"), F.lit('{"batchWatermarkMs":0,"conf":{}}'), F.col("offsets"))
    return files.select(
        F.concat(F.lit("/checkpoints/"), "app", F.lit("/offsets/"), F.col("n").cast("string")).alias("path"),
        F.explode(lines).alias("value"))
