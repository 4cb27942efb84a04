"""Mixing of sources to target weights by fixed-length blocks of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.graph import running_start
from tidelog.llm.names import free_name
from tidelog.sinks.tables import written_table

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 256          # words in a block
MIN_BLOCKS = 64      # a small source gets shorter blocks, so that it has about as many
SHARD_SLOTS = 1024   # blocks in an output shard
CELLS = 4096         # cells of the slot line, for finding a slot's source
WALKS = 63           # steps of a walk back into the range; each has a chance of a half at least


def _permuted(x: Column, n: Column, *seed: Column) -> Column:
    """Pseudorandom permutation of 0 to n - 1, n below 2 ** 50.

    A number's two halves are mixed with hashes of each other, four times, which permutes the
    numbers of as many bits; what comes to lie beyond the range is mixed again until it is inside.
    """
    bits = F.greatest(F.length(F.bin(n - 1)), F.lit(2))
    low = F.pow(F.lit(2.0), F.floor(bits / 2)).cast("long")
    high = F.pow(F.lit(2.0), bits - F.floor(bits / 2)).cast("long")

    def mixed(v: Column) -> Column:
        mask = lambda turn, half, size: F.pmod(F.xxhash64(half, F.lit(turn), *seed), size)
        left, right = F.floor(v / low).cast("long"), F.pmod(v, low)
        for turn in range(2):
            left = left.bitwiseXOR(mask(2 * turn, right, high))
            right = right.bitwiseXOR(mask(2 * turn + 1, left, low))
        return left * low + right

    walk = F.sequence(F.lit(1), F.lit(WALKS))
    return F.aggregate(walk, mixed(x.cast("long")), lambda v, _: F.when(v < n, v).otherwise(mixed(v)))


def source_targets(records: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per source: ``source``, ``rank``, ``source_size``, ``weight``, ``target``.

    Sources by code point, null last, take ``weights`` in turn and share ``share`` of
    all words by them; no target exceeds ``most`` times its source's size. The shares
    are the same multiple (level) of the weight for all sources below that limit; the
    level is found on the sources sorted by the level at which each is full.
    """
    sizes = records.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), F.col("rank") % len(weights)))
    ranked = ranked.withColumn("__limit", most * F.col("source_size")).withColumn("__full", F.col("__limit") / F.col("weight"))
    by_full = Window.orderBy("__full", "rank")
    spent = F.coalesce(F.sum("__limit").over(by_full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_full.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    ranked = ranked.withColumn("__level", (F.lit(share) * F.sum("source_size").over(everything) - spent) / left)
    level = F.min(F.when(F.col("__level") <= F.col("__full") * (1 + 1e-12), F.struct("__full", "rank", "__level"))).over(everything)["__level"]
    target = F.least(F.col("__limit").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return ranked.select("source", "rank", "source_size", "weight", target.alias("target"))


def _plan(docs: DataFrame, weights: tuple[int, ...], share: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Pieces of documents by source and block, and the blocks drawn for the slots of the output shards."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    records = written_table(docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"))
                            .withColumn("row", F.monotonically_increasing_id()))
    sources = source_targets(records, weights, share)
    length = F.greatest(F.lit(1), F.least(F.lit(block), F.ceil(F.col("source_size") / MIN_BLOCKS))).cast("long")
    sources = sources.withColumn("length", length).withColumn("blocks", F.ceil(F.col("source_size") / F.col("length")).cast("long"))
    draws = F.coalesce(F.round(F.col("target") / F.col("source_size") * F.col("blocks")), F.lit(0)).cast("long")
    sources = sources.withColumn("draws", draws)
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    sources = written_table(sources.withColumn("low", F.coalesce(F.sum("draws").over(before), F.lit(0))))
    total = sources.agg(F.coalesce(F.sum("draws"), F.lit(0)).alias("n")).first().n
    # pieces: every document's words on its source's line, cut at the blocks
    placed = running_start(records, ["source"], [F.col("doc_id"), F.col("row")], "size", "start")
    named = placed.join(sources.select(F.col("source").alias("__source"), "rank", "source_size", "target", "length"),
                        placed["source"].eqNullSafe(F.col("__source"))).drop("__source")
    end = F.col("start") + F.col("size")
    hits = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / F.col("length")), F.floor((end - 1) / F.col("length"))))
    pieces = named.withColumn("block", F.explode_outer(hits))
    head = F.greatest(F.col("start"), F.col("block") * F.col("length"))
    pieces = pieces.select(
        "row", "doc_id", "source", "size", "source_size", "target", "rank", "block", (head - F.col("start")).alias("from_word"),
        (F.least(end, (F.col("block") + 1) * F.col("length")) - head).alias("words"))
    # slots: a permutation deals the sources' draws to the slots; another one per source gives the block
    cell = max(1, -(-total // CELLS))
    spans = sources.filter("draws > 0").withColumn("__cell", F.explode(F.sequence(
        F.floor(F.col("low") / cell), F.floor((F.col("low") + F.col("draws") - 1) / cell))))
    slots = docs.sparkSession.range(0, total, 1).withColumnRenamed("id", "slot")
    drawn_at = _permuted(F.col("slot"), F.lit(total), F.lit(total)) if total else F.col("slot")
    slots = slots.withColumn("__at", drawn_at).withColumn("__cell", F.floor(F.col("__at") / cell))
    spans = spans.select("__cell", "rank", "low", "draws", "blocks")
    drawn = slots.join(spans, "__cell").filter("__at >= low AND __at < low + draws")
    turn = F.floor((F.col("__at") - F.col("low")) / F.col("blocks"))
    drawn = drawn.select(
        F.floor(F.col("slot") / SHARD_SLOTS).alias("shard"), "slot", "rank",
        _permuted((F.col("__at") - F.col("low")) % F.col("blocks"), F.col("blocks"), F.col("rank"), turn).alias("block"))
    return pieces, drawn


def mixed_blocks(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, block: int = BLOCK) -> DataFrame:
    """The mix: ``shard``, ``slot``, ``doc_id``, ``source``, ``from_word``, ``words``, a row per piece of a document.

    A source's documents, by ``doc_id``, are one line of words, cut into blocks of
    ``block`` words (shorter ones in small sources). Source counts are drawn per output shard: its slots
    are drawn, without putting back, from all sources' slots by a pseudorandom permutation, so
    that the counts are multinomial on condition that every source gets its target over all
    shards (their variance is that of a multinomial less the shard's share of the mix). A source's
    n-th slot takes the block given by the source's own permutation, another one in every
    turn; so a block is taken once more only after all others, and at most twice.

    Null texts and texts without words have no pieces. A null source is a source of its
    own. Repeated ids are separate documents. An empty table gives no rows. The same
    input rows give the same mix, except that equal rows of one id may swap places.
    """
    pieces, drawn = _plan(docs, weights, share, block)
    return pieces.join(drawn, ["rank", "block"]).select("shard", "slot", "doc_id", "source", "from_word", "words")


def taken_words(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, block: int = BLOCK) -> DataFrame:
    """Per document ``doc_id``, ``size``, ``source_size``, ``target`` (its source's) and ``taken``: its words in ``mixed_blocks``, repeats counted."""
    pieces, drawn = _plan(docs, weights, share, block)
    times = drawn.groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    joined = pieces.join(times, ["rank", "block"], "left")
    taken = F.coalesce(F.sum(F.col("words") * F.col("times")), F.lit(0)).cast("long")
    sums = joined.groupBy("row", "doc_id", "size", "source_size", "target").agg(taken.alias("taken"))
    return sums.select("doc_id", "size", "source_size", "target", "taken")


def repeated_documents(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mix takes them.

    A document is repeated its taken words by its size, rounded up with the probability
    of the rest by a hash of ``doc_id``, so the sources still come near their targets.
    Documents without words stay once. Rows of one id are counted together.
    """
    doc, many, turn = (free_name(docs.columns, name) for name in ("__doc", "__times", "__turn"))
    taken = taken_words(docs, weights, share, block).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 20)) / (1 << 20)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + chance)).otherwise(1)
    times = taken.select(F.col("doc_id").alias(doc), times.cast("int").alias(many)).filter(F.col(many) > 0).hint("shuffle_hash")
    joined = docs.join(times, docs["doc_id"].eqNullSafe(times[doc]))
    return joined.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(many)))).select(*[docs[c] for c in docs.columns])
