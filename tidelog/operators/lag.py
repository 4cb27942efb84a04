"""Consumer lag: committed against end offsets, roll-ups and alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

# Abnormal statuses and the number of samples between repeated alarms.
ABNORMAL = ["WARN", "ERR", "STOP", "STALL"]
REPEAT_PERIOD = 5
BLOCK_SAMPLES = 100_000


def log_number(lines: DataFrame) -> DataFrame:
    """Add ``app`` and the number ``batch`` of the log file in ``path``; other files go."""
    number = F.regexp_extract("path", r"/offsets/([0-9]+)(?:/|$)", 1)
    return lines.filter(number != "").withColumns({
        "app": F.regexp_extract("path", r"([^/]+)/offsets/", 1), "batch": number.cast("bigint")})


def newest_log(numbered: DataFrame) -> DataFrame:
    """Rows of the newest log file of every application."""
    newest = numbered.groupBy("app").agg(F.max("batch").alias("batch"))
    return numbered.join(newest, ["app", "batch"])


def offset_log_entries(lines: DataFrame) -> DataFrame:
    """Offsets of the newest log file of every application.

    ``lines`` has ``path`` (``.../<app>/offsets/<n>``, file or folder) and ``value``.
    Files hold a version line and metadata besides the offsets, so lines are
    chosen by content: a JSON map of topics to maps of partitions to offsets.
    """
    numbered = log_number(lines).select("app", "batch", "value")
    offsets = F.from_json("value", "map<string,map<string,bigint>>")
    topics = (newest_log(numbered)
              .filter(F.col("value").startswith("{"))
              .select("app", "batch", F.explode(offsets).alias("topic", "partitions")))
    return (topics.filter(F.col("partitions").isNotNull())
            .select("app", "batch", "topic", F.explode("partitions").alias("partition", "committed"))
            .select("app", "batch", "topic", F.col("partition").try_cast("int").alias("partition"),
                    "committed")
            .filter(F.col("partition").isNotNull() & F.col("committed").isNotNull()))


def consumer_lag(committed: DataFrame, ends: DataFrame) -> DataFrame:
    """Lag per application, topic and partition; zero when the commit is ahead.

    An application is shown for every partition with an end offset of the topics it
    has committed to; where it has committed nothing, ``committed`` is null and the lag
    counts from 0. A commit without an end offset, and a topic nobody commits to
    (``app`` null), are shown with what is known.
    """
    # per topic the partitions are few; both sides are read once and meet in one join on the topic
    commits = committed.groupBy("topic", "app").agg(F.collect_list(F.struct("partition", "committed")).alias("commits"))
    reached = ends.groupBy("topic").agg(F.collect_list(F.struct("partition", "end_offset")).alias("ends"))
    none = F.lit(None).cast("bigint")
    known = F.concat(
        F.coalesce(F.transform("commits", lambda c: F.struct(c["partition"].alias("p"), c["committed"].cast("bigint").alias("c"), none.alias("e"))), F.array()),
        F.coalesce(F.transform("ends", lambda e: F.struct(e["partition"].alias("p"), none.alias("c"), e["end_offset"].cast("bigint").alias("e"))), F.array()))
    joined = (commits.join(reached, "topic", "full_outer").select("app", "topic", F.explode(known).alias("k"))
              .groupBy("app", "topic", F.col("k.p").alias("partition"))
              .agg(F.max("k.c").alias("committed"), F.max("k.e").alias("end_offset")))
    lag = F.when(F.col("end_offset").isNotNull(),
                 F.greatest(F.col("end_offset") - F.coalesce("committed", F.lit(0)), F.lit(0)))
    return joined.withColumn("lag", lag)


def lag_by_topic(samples: DataFrame) -> DataFrame:
    """Lag per consumer and topic, with the consumer's total on a row without topic."""
    consumer, topic = F.col("consumer"), F.col("topic")
    return (samples.groupingSets([[consumer, topic], [consumer]], consumer, topic)
            .agg(F.sum("current_lag").alias("lag"), F.grouping_id().alias("__level"))
            .select("consumer", "topic", (F.col("__level") > 0).alias("is_total"), "lag"))


def status_text(status: Column) -> Column:
    """Meaning of a status."""
    return (F.when(status == "ERR", "committed offset does not advance")
            .when(status == "WARN", "committed offset advances but lag keeps growing")
            .otherwise("status needs a check"))


def elapsed_text(count: Column) -> Column:
    """Age of a run of one-minute samples."""
    hours, minutes = F.floor(count / 60), F.pmod(count, F.lit(60))
    return (F.when(count == 1, "first occurrence")
            .when(hours == 0, F.format_string("%dm elapsed", minutes))
            .otherwise(F.format_string("%dh %dm elapsed", hours, minutes)))


def status_runs(samples: DataFrame, max_gap: int | None = None,
                block: int = BLOCK_SAMPLES) -> DataFrame:
    """Samples with ``run``, the number of consecutive samples in the same status.

    ``samples`` has one row per consumer and ``sample_no`` with its ``status``; rows
    without either belong to no run. A sample number more than ``max_gap`` after the previous one starts a new run.

    A consumer with very many samples is cut into blocks of sample numbers: runs
    are found inside each block in parallel, one summary row per block carries
    the previous status and the start of the open run across blocks.
    """
    # stated up front so that the rows and their block summaries share one shuffle
    blocked = (samples.withColumn("__block", F.expr(f"sample_no div {int(block)}"))
               .filter(F.col("consumer").isNotNull() & F.col("sample_no").isNotNull()
                       & F.col("__block").isNotNull()))
    inside = Window.partitionBy("consumer", "__block").orderBy("sample_no")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def differs(status, no, last_status, last_no):
        other = ~status.eqNullSafe(last_status)
        return other if max_gap is None else other | ((no - last_no) > max_gap)

    status, no = F.col("status"), F.col("sample_no")
    rows = (blocked.withColumn("__n", F.row_number().over(inside))
            .withColumn("__change", (F.col("__n") > 1) & differs(
                status, no, F.lag("status").over(inside), F.lag("sample_no").over(inside)))
            .withColumn("__start", F.max(F.when(F.col("__change"), F.col("__n"))).over(upto)))

    blocks = rows.groupBy("consumer", "__block").agg(
        F.count(F.lit(1)).alias("__rows"),
        F.max("__start").alias("__last_start"),
        F.min_by("status", "sample_no").alias("__first_status"), F.min("sample_no").alias("__first_no"),
        F.max_by("status", "sample_no").alias("__end_status"), F.max("sample_no").alias("__end_no"))
    order = Window.partitionBy("consumer").orderBy("__block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    carried = (blocks
               .withColumn("__base", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
               .withColumn("__opens", F.lag("__rows").over(order).isNull() | differs(
                   F.col("__first_status"), F.col("__first_no"),
                   F.lag("__end_status").over(order), F.lag("__end_no").over(order)))
               .withColumn("__open_start", F.when(F.col("__opens"), F.col("__base") + 1))
               .withColumn("__newest", F.coalesce(F.col("__base") + F.col("__last_start"), "__open_start"))
               .withColumn("__carry", F.max("__newest").over(earlier))
               .select("consumer", "__block", "__base",
                       F.coalesce("__open_start", "__carry").alias("__inherited")))
    start = F.coalesce(F.col("__base") + F.col("__start"), "__inherited")
    run = (F.col("__base") + F.col("__n") - start + 1).cast("bigint")
    return rows.join(carried, ["consumer", "__block"]).select(*samples.columns, run.alias("run"))


def lag_alerts(samples: DataFrame, max_gap: int | None = None, period: int = REPEAT_PERIOD,
               block: int = BLOCK_SAMPLES) -> DataFrame:
    """Alarms: the first sample of an abnormal run and every ``period``-th after it."""
    runs = status_runs(samples, max_gap, block)
    due = (F.col("run") == 1) | (F.col("run") % period == 0)
    return (runs.filter(F.col("status").isin(ABNORMAL) & due)
            .withColumns({"status_text": status_text(F.col("status")),
                          "elapsed": elapsed_text(F.col("run"))}))
