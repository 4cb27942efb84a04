"""Connected components and running sums over distributed frames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import work_dir
from tidelog.sinks.tables import drop_table, written_table


TASK_LINKS = 1 << 20   # links that one task may hold, 16 MB


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node``, ``root`` of links that fit into a task, by hooking and pointer jumping."""
    parts = [np.stack([b.column("a").to_numpy(), b.column("b").to_numpy()]) for b in batches if b.num_rows]
    if not parts:
        return
    nodes, ends = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
    ends, root = ends.reshape(2, -1), np.arange(len(nodes))
    while True:
        high, low = np.maximum(*root[ends]), np.minimum(*root[ends])
        open_ = high != low
        if not open_.any():
            break
        np.minimum.at(root, high[open_], low[open_])
        while (root[root] != root).any():
            root = root[root]
    for start in range(0, len(nodes), 1 << 16):
        part = slice(start, start + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(nodes[root[part]])], ["node", "root"])


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = links.select(F.col("b").alias("u"), F.col("a").alias("v")).unionByName(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return links.join(least, F.col("b") == F.col("u")).select("a", F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    hooked = links.join(least, F.col("a") == F.col("u")).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return hooked.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` of every node in ``links`` (columns ``a``, ``b``: long).

    ``root`` is the least node reachable. Rounds of large and small stars bring all nodes of a
    component to its least one; their number follows the logarithm of the number of nodes, also for
    chains. As soon as no more than ``TASK_LINKS`` links are left (counted), one task ends the
    work. Every round is a written table, the table before it is deleted; nothing is gathered at the
    driver. Null ends and loops are ignored; no links give no rows.
    """
    spark = links.sparkSession
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")

    def step(df: DataFrame, before: str | None) -> tuple[DataFrame, str]:
        path = work_dir(spark, "links")
        table = written_table(df, path)
        if before:
            drop_table(spark, before)
        return table, path

    known = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    links, path = step(known.select(high, low).distinct(), None)
    while links.count() > TASK_LINKS:
        links, path = step(_large_star(links), path)
        links, path = step(_small_star(links), path)
        if links.select("a").join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            # stars: every node but the centres is linked to its centre
            roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    return links.repartition(1).mapInArrow(_solved, "node long, root long")


def running_start(df: DataFrame, group: list[str], order: list[Column], size: str, start: str) -> DataFrame:
    """Add ``start``: the sum of ``size`` over the rows before, within ``group``, in ``order``.

    Rows are dealt out by range of group and order, so that one group may hold most
    rows; each range is summed on its own and the totals of the ranges (one row per
    range and group) are added up. ``order`` should be unique; ties fall either way.
    The result is read from a written table.
    """
    keys = [F.col(c) for c in group]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *keys, *order).withColumn("__range", F.spark_partition_id())
    ranged = written_table(ranged)
    inside = Window.partitionBy("__range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__range", *keys).agg(F.sum(size).alias("__total"))
    totals = totals.withColumn("__base", F.coalesce(F.sum("__total").over(across), F.lit(0))).drop("__total")
    same = [F.col("l.__range") == F.col("r.__range"), *(F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in group)]
    summed = ranged.withColumn(start, F.coalesce(F.sum(size).over(inside), F.lit(0)))
    joined = summed.alias("l").join(totals.alias("r"), same)
    return joined.select("l.*", F.col("r.__base")).withColumn(
        start, (F.col(start) + F.col("__base")).cast("long")).drop("__range", "__base")
