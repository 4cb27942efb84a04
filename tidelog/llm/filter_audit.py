"""Audit of filters that act on one another: what each removes at each place of each order."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.sinks.tables import written_table

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)
GROUPS = 3                      # all documents, those of good quality, toxic ones
FIELD_BITS = 64                 # a count of documents always fits
SALTS = 32
PART_LIMIT = 1024               # parts a task holds before it passes their sums on

UPPER = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"
CONTINUED = bytes(range(0x80, 0xC0))   # bytes that begin no code point
FEATURES = "doc_id long, part string, mask int, digest binary"
SUMS = "part string, packed binary"
AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    upper = len(text) - len(text.translate(None, UPPER))
    chars = len(text) - len(text.translate(None, CONTINUED)) if not text.isascii() else 0
    failed = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 3 * (len(text) - chars),
              len(text.translate(None, MARKS)) < len(text))
    return sum(1 << bit for bit, fails in enumerate(failed) if fails)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks, digests = [], []
        for text in batch.column("text"):
            data = text.as_buffer() if text.is_valid else None
            data = b"" if data is None else data.to_pybytes()
            masks.append(text_mask(data))
            digests.append(hashlib.sha256(data).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
            ["doc_id", "part", "mask", "digest"])


def _outcomes() -> list[int]:
    """Per mask one integer: field ``5 * order + place`` is 1 where that step removes the document."""
    found = []
    for mask in range(1 << len(FILTERS)):
        packed = 0
        for number, order in enumerate(ORDERS):
            for place, letter in enumerate(order):
                if mask >> FILTERS.index(letter) & 1:
                    packed |= 1 << FIELD_BITS * (len(FILTERS) * number + place)
                    break
        found.append(packed)
    return found


# behind the outcomes: how many documents there are, fail each filter, and fail that one only
TOTAL, FAILS, ALONE = STEPS, STEPS + 1, STEPS + 1 + len(FILTERS)
FIELDS = STEPS + 1 + 2 * len(FILTERS)


def packed_masks() -> list[int]:
    """The integer of every mask and pair of labels, at ``mask + 32 * good + 64 * toxic``."""
    found = []
    for mask, outcome in enumerate(_outcomes()):
        for bit in range(len(FILTERS)):
            if mask >> bit & 1:
                outcome |= 1 << FIELD_BITS * (FAILS + bit)
            if mask == 1 << bit:
                outcome |= 1 << FIELD_BITS * (ALONE + bit)
        found.append(outcome | 1 << FIELD_BITS * TOTAL)
    group = FIELD_BITS * FIELDS
    return [one | (one << group) * good | (one << 2 * group) * toxic
            for toxic in (0, 1) for good in (0, 1) for one in found]


def _bytes(sums: dict[str, int]) -> pa.RecordBatch:
    size = GROUPS * FIELDS * FIELD_BITS // 8
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()), pa.array([n.to_bytes(size, "little") for n in sums.values()], pa.binary())],
        ["part", "packed"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the documents' integers per part, passed on once per task or ``PART_LIMIT`` parts."""
    integers, sums = packed_masks(), {}
    for batch in batches:
        coded = batch.column("part").dictionary_encode()
        parts = coded.dictionary.to_pylist()
        place = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.bincount(place * len(integers) + batch.column("code").to_numpy(), minlength=len(parts) * len(integers))
        for at in np.flatnonzero(counts):
            part, code = divmod(int(at), len(integers))
            sums[parts[part]] = sums.get(parts[part], 0) + int(counts[at]) * integers[code]
        if len(sums) > PART_LIMIT:
            yield _bytes(sums)
            sums = {}
    if sums:
        yield _bytes(sums)


def _sum_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
    """Sum per part of rows that come sorted by part; one sum is held at a time."""
    part, total = None, 0
    for batch in batches:
        for name, packed in zip(batch.column("part").to_pylist(), batch.column("packed").to_pylist()):
            if part is not None and name != part:
                yield part, total
                total = 0
            part, total = name, total + int.from_bytes(packed, "little")
    if part is not None:
        yield part, total


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, total in _sum_sorted(batches):
        yield _bytes({part: total})


def audit_table(part: str, total: int) -> pa.RecordBatch:
    """The 600 rows of a part, read from the fields of its sum."""
    fields = np.frombuffer(total.to_bytes(GROUPS * FIELDS * FIELD_BITS // 8, "little"), np.uint64).astype(np.int64)
    everything, good, toxic = fields.reshape(GROUPS, FIELDS)
    removed = everything[:STEPS].reshape(len(ORDERS), len(FILTERS))
    letters = np.array([[FILTERS.index(x) for x in order] for order in ORDERS])
    shapley = np.zeros(len(FILTERS), np.int64)
    np.add.at(shapley, letters, removed)
    columns = {
        "part": [part] * STEPS,
        "filter_order": np.repeat(ORDERS, len(FILTERS)),
        "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS)),
        "kept": everything[TOTAL] - removed.cumsum(axis=1),
        "removed": removed,
        "redundant": everything[FAILS:ALONE][letters] - removed,
        "unique_fails": everything[ALONE:][letters],
        "good_lost": good[:STEPS],
        "toxic_lost": toxic[:STEPS],
        "shapley": shapley[letters],
    }
    return pa.RecordBatch.from_pydict({name: np.ravel(values) for name, values in columns.items()})


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, total in _sum_sorted(batches):
        yield audit_table(part, total)


def _labelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    """``part`` and ``code`` (mask with E, good, toxic) of every document."""
    ones = lambda c: F.max((F.col(c) == 1).cast("int")).alias(f"__{c}")
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("__id")).agg(ones("quality"), ones("toxic"))
    # rows of one text are reduced before the shuffle; the documents that hold its least id are its only ones that pass E
    first = (features.filter(F.col("doc_id").isNotNull()).groupBy(F.col("digest").alias("__digest"))
             .agg(F.min("doc_id").alias("__first")))
    docs = features.filter(F.col("doc_id").isNotNull())
    docs = docs.join(first, (docs["doc_id"] == first["__first"]) & (docs["digest"] == first["__digest"]), "left")
    docs = docs.join(known, docs["doc_id"] == known["__id"], "left")

    def code(repeated: Column, good: Column, toxic: Column) -> Column:
        bit = lambda flag, value: F.when(F.coalesce(flag, F.lit(False)), value).otherwise(0)
        return (F.col("mask") + bit(repeated, 16) + bit(good, 32) + bit(toxic, 64)).cast("long").alias("code")

    no = F.lit(False)
    without_id = features.filter(F.col("doc_id").isNull()).select("part", code(no, no, no))
    return docs.select("part", code(F.col("__first").isNull(), F.col("__quality") == 1, F.col("__toxic") == 1)).unionByName(without_id)


def audit_filters(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """What the filters A to E remove, per part of the documents, order of the filters and step.

    Every mask of failed filters stands for one integer with a field of ``FIELD_BITS`` bits
    per outcome of the 600 steps; the integers of the documents are summed per part (for
    all, good and toxic documents side by side) and their fields read at the end. Tasks
    pass on one sum per part, which are added up in two rounds, so that one part may
    hold all documents.

    A null text is empty, a null ``lang`` is the part of the empty one. Of repeated rows
    of the least id of a text none fails E; a document without id neither fails E nor
    makes another fail, and has no labels. A document counts as good or toxic if any
    of its labels says so. No documents give no rows; other columns are ignored.
    """
    spark = documents.sparkSession
    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                             F.coalesce(F.col("lang"), F.lit("")).alias("part"), "text")
    features = written_table(given.mapInArrow(_features, FEATURES))
    packed = _labelled(features, labels).mapInArrow(_pack, SUMS)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = packed.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    halved = salted.repartition(parts, "part", "salt").sortWithinPartitions("part").select("part", "packed").mapInArrow(_add, SUMS)
    return halved.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_unpack, AUDIT)
