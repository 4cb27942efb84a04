"""Sharding by fixed virtual slots with a versioned slot-to-shard map."""

from __future__ import annotations

import heapq
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.graph import running_start
from tidelog.session import work_dir
from tidelog.sinks.tables import written_table

SLOTS = 4096      # virtual slots; the map never holds more rows than SLOTS + (HOT_PER_SHARD + 1) * shards * PARTS
PARTS = 64        # sub-slots of a slot too heavy to place whole, and of a text heavier than a shard
HOT_PER_SHARD = 16  # a slot above 1 / 16 of a shard's fair share is divided
MAP_SCHEMA = "array<struct<slot:long,shard:int,base:long,bytes:long,records:long>>"


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``text_hash`` and ``slot`` of every document, as a written table.

    The slot is the remainder of the text's hash, so equal texts share one.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return written_table(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"), F.pmod(F.xxhash64(text), F.lit(slots)).cast("long").alias("slot")))


def placed(weights: list[tuple[int, int, int]], shards: int, old: dict[int, int] | None = None) -> list[dict]:
    """Rows of a map for ``weights`` (slot, bytes, records).

    Without an ``old`` map the heaviest slot goes to the lightest shard, and so on.
    With one, slots stay where they are; new slots go to the lightest shard, and slots
    move from the heaviest to the lightest shard until the two differ by a hundredth of
    a shard or no move narrows the gap.
    """
    load = [0] * shards
    where = {s: old[s] for s, _, _ in weights if old and old.get(s, shards) < shards}
    for slot, size, _ in weights:
        if slot in where:
            load[where[slot]] += size
    heap = [(size, shard) for shard, size in enumerate(load)]
    heapq.heapify(heap)
    for slot, size, _ in sorted(weights, key=lambda w: (-w[1], w[0])):
        if slot not in where:
            light, shard = heapq.heappop(heap)
            where[slot] = shard
            heapq.heappush(heap, (light + size, shard))
    if old:
        _level(weights, where, shards)
    rows, base = [], [0] * shards
    for slot, size, count in sorted(weights):
        shard = where[slot]
        rows.append({"slot": slot, "shard": shard, "base": base[shard], "bytes": size, "records": count})
        base[shard] += count
    return rows


def _level(weights: list[tuple[int, int, int]], where: dict[int, int], shards: int) -> None:
    sizes = {slot: size for slot, size, _ in weights}
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    for slot, shard in where.items():
        held[shard][slot] = sizes[slot]
    load = [sum(h.values()) for h in held]
    while True:
        full, light = load.index(max(load)), load.index(min(load))
        gap = load[full] - load[light]
        fits = [(size, slot) for slot, size in held[full].items() if 0 < size < gap]
        if not fits or gap * shards * 100 <= sum(load):  # within a hundredth of a shard
            return
        size, slot = min(fits, key=lambda f: (abs(2 * f[0] - gap), f[1]))
        where[slot] = light
        held[light][slot] = held[full].pop(slot)
        load[full] -= size
        load[light] += size


def store_map(spark: SparkSession, rows: list[dict], folder: str, version: int) -> DataFrame:
    """Write a map as ``version`` of the maps in ``folder`` and read it back."""
    table = spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), MAP_SCHEMA)))
    return written_table(table, f"{folder.rstrip('/')}/version={version}")


def slot_weights(records: DataFrame, shards: int, slots: int = SLOTS) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """Records with heavy slots divided, and bytes and records per slot.

    A slot above 1 / 16 of a fair shard is divided by more of its texts' hash, so that equal texts
    stay together; only a text whose copies outweigh a fair shard is divided by ``doc_id``. At
    most ``slots`` rows, those of at most 16 divided slots per shard, and a text per shard reach the driver.
    """
    def sums(df: DataFrame) -> list[tuple[int, int, int]]:
        rows = df.groupBy("slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records")).collect()
        return [(r.slot, r.bytes, r.records) for r in rows]

    weights = sums(records)
    fair = sum(size for _, size, _ in weights) / shards
    hot = [slot for slot, size, count in weights if size > fair / HOT_PER_SHARD and count > 1]
    if not hot:
        return records, weights
    texts = records.filter(F.col("slot").isin(hot)).groupBy("text_hash").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    large = [r.text_hash for r in texts.filter((F.col("bytes") > fair) & (F.col("n") > 1)).collect()]
    by_text = F.pmod(F.shiftright("text_hash", 32), F.lit(PARTS)) + 1
    by_id = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(PARTS)) + 1
    slot = F.col("slot") + F.when(F.col("slot").isin(hot), by_text).otherwise(0) * slots
    if large:
        slot = slot + F.when(F.col("text_hash").isin(large), by_id).otherwise(0) * (slots * (PARTS + 1))
    divided = records.withColumn("slot", slot.cast("long"))
    return divided, [w for w in weights if w[0] not in set(hot)] + sums(divided.filter(F.col("slot") >= slots))


def shard_documents(docs: DataFrame, shards: int = 8, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """Per document ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Documents are hashed by text into ``slots`` virtual slots, bytes are added up per
    slot, and a map that gives every slot a shard of nearly equal bytes is stored as
    version 0 in ``folder`` (default: a new shared one). Equal texts stay together,
    except a text whose copies outweigh a fair shard: its rows are divided by
    ``doc_id``. ``slot`` is the place in the shard: the slot's base (records of the
    shard's slots before) plus the rank in the slot by ``doc_id``, counted over ranges of rows, so
    that a slot of very many small rows is spread over tasks. The law is ``bytes``;
    ``grown_shard`` is null.

    A null text has size 1, as the empty one. Null and repeated ids are rows like others.
    An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    records, weights = slot_weights(slotted(docs, slots), shards, slots)
    table = store_map(spark, placed(weights, shards), folder or work_dir(spark, "slot-map"), 0)
    one = records.select("doc_id", "size", "text_crc32", "slot", F.lit(1).alias("one"))
    ranked = running_start(one, ["slot"], [F.col("doc_id"), F.col("text_crc32")], "one", "rank")
    ranked = ranked.join(F.broadcast(table.select("slot", "shard", "base")), "slot")
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("rank")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def rebalance(records: DataFrame, current: DataFrame, shards: int, folder: str, version: int, slots: int = SLOTS) -> DataFrame:
    """Edit a stored map for the slot bytes of ``records`` and a number of shards; store it as ``version``.

    ``records`` come from ``slotted``; ``current`` is the map of the version before
    (bounded as in ``slot_weights``). Only slots that even out the shards move.
    """
    _, weights = slot_weights(records, shards, slots)
    old = {r.slot: r.shard for r in current.select("slot", "shard").collect()}
    return store_map(records.sparkSession, placed(weights, shards, old), folder, version)
