"""MinHash fingerprints of documents, their likeness, and documents linked by signature bands."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.graph import components
from tidelog.llm.linking import verified_links
from tidelog.llm.textnum import BY_SPACE_FOLDED, constants, groups_of, minhash, mix, permutations, shingles, utf8, word_hashes
from tidelog.session import work_dir
from tidelog.sinks.tables import written_table

HASHES = 128    # universal hash permutations in a fingerprint
WORDS = 5       # words in a shingle
BANDS, BAND_ROWS = 32, 4
_FUNCTIONS = permutations(HASHES, 71)


def _shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = utf8(texts)
    for first, last in groups_of(offsets):
        part = offsets[first:last + 1] - offsets[first]
        hashes, _, upto = word_hashes(data[offsets[first]:offsets[last]], part, BY_SPACE_FOLDED)
        for row in range(last - first):
            yield shingles(hashes[upto[row]:upto[row + 1]], WORDS)


def signatures(texts: pa.Array) -> np.ndarray:
    """Per text the lower 16 bits of 128 minhashes over its runs of five words; all bits set for a text without words."""
    rows = [minhash(s, _FUNCTIONS) for s in _shingle_sets(texts)]
    return (np.array(rows, np.uint32).reshape(-1, HASHES) & np.uint32(0xFFFF)).astype(">u2")


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Share of equal places of two signatures."""
    return float((left == right).mean())


def edited(text: str, following: str) -> str:
    """The text with its second half (rounded down) replaced by the first as many code points of the next one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_COLUMNS = ("doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
            "near_edited double, near_next double")
_SEAM = "seam string, text string"


def _compared(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """Result rows of documents and the ones after them."""
    changed = [edited(a, b) for a, b in zip(texts, following)]
    own, new, after = (signatures(pa.array(t, pa.large_string())) for t in (texts, changed, following))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
         pa.array([hashlib.sha256(t.encode()).digest() for t in changed], pa.binary()),
         pa.array([s.tobytes() for s in own], pa.binary()), pa.array([s.tobytes() for s in new], pa.binary()),
         pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()),
         pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64())],
        [c.split()[0] for c in _COLUMNS.split(", ")])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all documents of a sorted partition but the last; the first and the last as seams."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()),
                        ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                        ("seam", pa.string()), ("text", pa.string())])

    def seam(kind: str, doc: int | None, text: str) -> pa.RecordBatch:
        row = {name: None for name in schema.names} | {"doc_id": doc, "seam": kind, "text": text}
        return pa.RecordBatch.from_pylist([row], schema)

    held: tuple[int | None, str] | None = None
    for batch in batches:
        _, offsets = utf8(batch["text"])
        for first, last in groups_of(offsets):
            part = batch.slice(first, last - first)
            ids, texts = part["doc_id"].to_pylist(), part["text"].to_pylist()
            if held is None:
                yield seam("first", ids[0], texts[0])
            else:
                ids, texts = [held[0], *ids], [held[1], *texts]
            held = ids[-1], texts[-1]
            if len(ids) > 1:
                rows = _compared(ids[:-1], texts[:-1], texts[1:])
                nulls = [pa.nulls(len(rows), pa.string())] * 2
                yield pa.RecordBatch.from_arrays([*rows.columns, *nulls], schema=schema)
    if held is not None:
        yield seam("last", *held)


def _compare_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _compared(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), batch["following"].to_pylist())


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, and the likeness to that and to the next document's.

    Returns ``doc_id``, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint`` and
    ``edited_fingerprint`` (128 minhashes of 16 bits in hexadecimal), ``near_edited`` and
    ``near_next`` (share of equal minhashes). The next document is the next by
    ``doc_id``, after the last one the first; the edit replaces the last half of the
    text (rounded down) by the first as many code points of the next document.

    Words are compared with A to Z in lower case; a text of fewer than five words is one
    shingle; texts without words all have the same fingerprint. A null text counts as
    empty. Null ids come first; rows with the same id follow each other in the order of
    their texts, each with a row of its own. A single document is its own next. An empty
    table gives no rows. Other columns are ignored.

    Texts are dealt out once, by ranges of ``doc_id``; the first and last document of
    each range are matched in a second step over two rows per range.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    rows = ordered.mapInArrow(_neighbours, f"{_COLUMNS}, {_SEAM}").withColumn("__range", F.spark_partition_id())
    folder = work_dir(docs.sparkSession, "fingerprints")
    rows.write.option("compression", "zstd").parquet(folder)
    rows = docs.sparkSession.read.parquet(folder)
    seams = rows.filter("seam IS NOT NULL")
    # a range's last document precedes the first of the next range that has any
    order = Window.orderBy("__range")
    lasts, firsts = seams.filter("seam = 'last'"), seams.filter("seam = 'first'")
    ranges = firsts.select("__range").withColumn("__next", F.lead("__range").over(order))
    ranges = ranges.withColumn("__next", F.coalesce("__next", F.min("__range").over(Window.partitionBy())))
    pairs = (lasts.select("__range", "doc_id", "text").join(ranges, "__range")
             .join(firsts.select(F.col("__range").alias("__next"), F.col("text").alias("following")), "__next"))
    joined = pairs.select("doc_id", "text", "following").mapInArrow(_compare_pairs, _COLUMNS)
    result = rows.filter("seam IS NULL").drop("seam", "text", "__range").unionByName(joined)
    text = {c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return result.withColumns(text)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, salt = constants(BAND_ROWS, 72), constants(BANDS, 73)
    for batch in batches:
        sets = list(_shingle_sets(batch["text"]))
        rows = np.array([minhash(s, _FUNCTIONS) for s in sets], np.uint64).reshape(-1, BANDS, BAND_ROWS)
        keys = mix((rows * places).sum(axis=2, dtype=np.uint64) ^ salt).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))],
            ["node", "items", "keys"])


def linked_documents(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id`` and ``group_id``: the least id that links lead to.

    Documents with a common band of their signatures (32 bands of four minhashes) are
    candidates; those whose five-word shingles have a Jaccard likeness of ``percent`` /
    100 or more are linked. Sets of likeness 0.8 share no band with probability
    (1 - 0.8 ** 4) ** 32, 5e-8. Null ids are left out; texts without words are linked
    with nothing.
    """
    texts = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # equal sets have equal keys; one of them stands for all
    banded = written_table(texts.mapInArrow(_banded, "node long, items binary, keys array<long>").withColumn(
        "same", F.sha2("items", 256)))
    full = banded.filter("octet_length(items) > 0")
    least = full.groupBy("same").agg(F.min("node").alias("least"))
    single = written_table(full.join(least, "same").filter("node = least").dropDuplicates(["same"]).select("node", "items", "keys"))
    keys = single.select("node", F.explode("keys").alias("key"))
    links = verified_links(single.select("node", "items"), keys, percent)
    equal = full.select("same", "node").join(least, "same").select(F.col("node").alias("a"), F.col("least").alias("b"))
    roots = components(links.unionByName(equal))
    return (banded.select(F.col("node").alias("doc_id")).join(roots, F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", F.coalesce("root", "doc_id").alias("group_id")))
