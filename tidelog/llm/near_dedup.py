"""Near-duplicate groups by MinHash with tensored banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.graph import components
from tidelog.llm.names import free_name
from tidelog.llm.linking import GROUP_ITEMS, verified_links
from tidelog.llm.textnum import BY_SPACE_FOLDED, constants, groups_of, lean, minhash, mix, permutations, shingles, utf8, word_hashes
from tidelog.session import work_dir
from tidelog.sinks.tables import written_table

ROWS = 3    # minhashes in one half key
HALVES = 16  # half keys of either side: 2 * 16 * 3 = 96 minhashes serve 16 * 16 = 256 tables of 6 rows


def _sets_of(batch: pa.RecordBatch, words: int) -> Iterator[np.ndarray]:
    data, offsets = utf8(batch["text"])
    for first, last in groups_of(offsets):
        part = offsets[first:last + 1]
        hashes, _, upto = word_hashes(data[part[0]:part[-1]], part - part[0], BY_SPACE_FOLDED)
        for row in range(last - first):
            yield shingles(hashes[upto[row]:upto[row + 1]], words)


def _digest(items: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    lanes = np.array([len(items)], np.uint64)
    sums = [mix(lanes + mix(items ^ c).sum(dtype=np.uint64))[0] for c in constants(2, 31)]
    return tuple(np.array(sums, np.uint64).view(np.int64).tolist())


def _signer(words: int):
    functions, places = permutations(2 * HALVES * ROWS, 32), constants(ROWS, 34)
    salt = constants(2 * HALVES, 35)

    @lean
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, halves = [], [], [], []
            for items in _sets_of(batch, words):
                sizes.append(len(items))
                a, b = _digest(items)
                first.append(a), second.append(b)
                least = minhash(items, functions).astype(np.uint64).reshape(2 * HALVES, ROWS)
                halves.append(mix((least * places).sum(axis=1, dtype=np.uint64) ^ salt))
            flat = np.concatenate(halves).view(np.int64) if halves else np.zeros(0, np.int64)
            ends = np.arange(len(sizes) + 1, dtype=np.int32) * 2 * HALVES
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["row", "doc_id", "n_shingles", "k1", "k2", "halves"])
    return sign


def _set_writer(words: int):
    @lean
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in _sets_of(batch, words)]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(sets, pa.binary())], ["node", "items"])
    return write


def candidate_keys(signed: DataFrame) -> DataFrame:
    """``node``, ``key``: table keys, each a pair of one left and one right half key.

    Half keys that only one node has are dropped first, so that pairs are formed only
    for nodes that share a half key on either side.
    """
    half = signed.select("node", F.posexplode("halves").alias("at", "half"))
    common = half.groupBy("half").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1").select("half")
    half = half.join(common, "half")
    left, right = F.col("at") < HALVES, F.col("at") >= HALVES
    sides = half.groupBy("node").agg(F.collect_list(F.when(left, F.col("half"))).alias("left"),
                                     F.collect_list(F.when(right, F.col("half"))).alias("right"))
    pairs = sides.select("node", F.explode("left").alias("left"), "right")
    return pairs.select("node", "left", F.explode("right").alias("right")).select("node", F.xxhash64("left", "right").alias("key"))


def _numbered(rows: DataFrame) -> tuple[DataFrame, str]:
    """``rows`` with a number each, as a written table, and the number's column: every reading gives a row the same one."""
    folder, name = work_dir(rows.sparkSession, "rows"), free_name(rows.columns, "__row")
    rows.withColumn(name, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.parquet(folder), name


def _grouped(numbered: DataFrame, number: str, words: int, percent: int, group_items: int, by_id: bool) -> DataFrame:
    """``row``, ``doc_id``, ``n_shingles``, and of the row's group ``least_id`` and ``least_row``, the row that stands for it.

    Rows are grouped by links of their texts; with ``by_id`` also by a common ``doc_id``.
    The row that stands for a group has its least ``doc_id``; null comes last.
    """
    texts = numbered.select(F.col(number).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written_table(texts.mapInArrow(
        _signer(words), "row long, doc_id long, n_shingles long, k1 long, k2 long, halves array<long>"))
    classes = written_table(signed.filter("n_shingles > 0").groupBy("k1", "k2").agg(
        F.min(F.struct("row", "halves")).alias("least")).select("k1", "k2", F.col("least.row").alias("node"), "least.halves"))
    keys = written_table(candidate_keys(classes))
    wanted = keys.select("node").distinct().hint("shuffle_hash")
    sets = texts.join(wanted, texts["row"] == wanted["node"], "left_semi").mapInArrow(
        _set_writer(words), "node long, items binary").filter("octet_length(items) > 0")
    links = verified_links(sets, keys, percent, group_items)
    # rows of equal sets belong together
    equal = signed.filter("n_shingles > 0").join(classes.select("k1", "k2", "node"), ["k1", "k2"])
    links = links.unionByName(equal.select(F.col("row").alias("a"), F.col("node").alias("b")))
    if by_id:
        repeated = signed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
            F.min("row").alias("b"), F.max("row").alias("most")).filter("b < most")
        links = links.unionByName(signed.select("doc_id", F.col("row").alias("a")).join(repeated, "doc_id").select("a", "b"))
    roots = components(links)
    found = signed.select("row", "doc_id", "n_shingles").join(roots, F.col("row") == F.col("node"), "left")
    found = written_table(found.select("row", "doc_id", "n_shingles", F.coalesce("root", "row").alias("root")))
    least = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("least"))
    return found.join(least, "root").select(
        "row", "doc_id", "n_shingles", F.col("least.doc_id").alias("least_id"), F.col("least.row").alias("least_row"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    A document's set holds its distinct runs of ``words`` lower-cased (A to Z) words;
    a shorter text counts as one run. Documents are linked if the Jaccard likeness of
    their sets is ``percent`` / 100 or more. ``component_id`` is the least ``doc_id``
    reachable by links, ``kept`` marks the document that has it.

    Tensored banding: 16 left and 16 right half keys of three minhashes give 256 tables
    whose keys pair one of each. Sets of likeness 0.8 share none with probability
    2 * (1 - 0.8 ** 3) ** 16, 2e-5; all that share one are compared on the full sets.

    Null and empty texts, and texts without words, have an empty set and are linked
    with nothing. Equal sets are handled once. Rows with the same ``doc_id`` count as
    one document. Each row with a null ``doc_id`` is a document of its own; it never names
    a group. A group of null ids alone has a null ``component_id``, and one of its rows
    is kept. Other columns are ignored; an empty table gives no rows.
    """
    found = _grouped(*_numbered(docs.select("doc_id", "text")), words, percent, group_items, True)
    kept = F.coalesce(F.col("doc_id") == F.col("least_id"), F.col("least_id").isNull() & (F.col("row") == F.col("least_row")))
    return found.select("doc_id", "n_shingles", F.col("least_id").alias("component_id"), kept.alias("kept"))


def one_per_group(docs: DataFrame, words: int = 5, percent: int = 80, group_items: int = GROUP_ITEMS) -> DataFrame:
    """One row of ``docs``, all columns, of each group of near duplicates: one with the least ``doc_id``.

    Groups are those of ``near_duplicates``, except that every row is a document of its
    own, also where ids are repeated: equal rows stay once, different texts of one id
    all stay. Texts without words are linked with nothing and stay.
    """
    numbered, number = _numbered(docs)
    kept = _grouped(numbered, number, words, percent, group_items, False).filter("row = least_row").select("row").hint("shuffle_hash")
    return numbered.join(kept, numbered[number] == kept["row"], "left_semi").select(*[numbered[c] for c in docs.columns])
