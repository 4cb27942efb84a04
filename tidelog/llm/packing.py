"""Packing of neighbouring documents along a space-filling curve."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.graph import running_start
from tidelog.llm.textnum import constants, lean
from tidelog.llm.tokens import token_ids
from tidelog.session import work_dir

LENGTH = 1024
END_ID = 0
BUCKETS, DIMENSIONS, BITS = 256, 3, 10


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``points``: integers below 2 ** bits in a few dimensions.

    The coordinates are turned into the transposed form of the place, one bit plane
    after the other, from the highest: a coordinate with the bit set inverts the lower
    bits of the first one, one without it swaps them with the first one's.
    """
    x = points.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for row in x:
            turned = (row >> bit & 1).astype(bool)
            swapped = np.where(turned, 0, (x[0] ^ row) & low)
            x[0] ^= np.where(turned, low, swapped)
            row ^= swapped
    for i in range(1, len(x)):  # Gray code over the dimensions
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= flip
    keys = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for row in x:
            keys = keys << 1 | (row >> bit & 1)
    return keys


class Projection:
    """Hashed token counts of a document, projected to a few dimensions."""

    def __init__(self):
        self.hash = constants(2, 41)
        self.axes = np.random.default_rng(42).standard_normal((BUCKETS, DIMENSIONS))

    def vector(self, ids: np.ndarray) -> np.ndarray:
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * self.hash[0]
        counts = np.bincount((mixed >> np.uint64(56)).astype(np.int64), 1.0 - 2.0 * (mixed >> np.uint64(55) & np.uint64(1)), BUCKETS)
        length = np.linalg.norm(counts)
        return counts / length if length else counts

    def keys(self, vectors: list[np.ndarray]) -> np.ndarray:
        """Curve places; a coordinate, about normally distributed, is spread evenly over its range."""
        if not vectors:
            return np.zeros(0, np.int64)
        spread = 1 / (1 + np.exp(-1.702 * (np.array(vectors) @ self.axes)))
        return hilbert_keys(np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def tokenised(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``row``, ``doc_id``, ``curve``, ``doc_tokens``, ``ids`` of each document, as a written table.

    ``ids`` holds the token ids and a closing id 0 as little-endian unsigned 32-bit
    numbers, or 16-bit ones where the vocabulary allows.
    """
    @lean
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection = Projection()
        for batch in batches:
            vectors, counts, packed = [], [], []
            for ids in token_ids(batch["text"], vocabulary):
                vectors.append(projection.vector(ids))
                counts.append(len(ids) + 1)
                ids = np.append(ids, np.uint32(END_ID))
                packed.append(ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(projection.keys(vectors)), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())],
                ["doc_id", "curve", "doc_tokens", "ids"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(encode, "doc_id long, curve long, doc_tokens long, ids binary")
    folder = work_dir(docs.sparkSession, "tokens")
    rows.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def _cutter(length: int):
    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("doc_id", "doc_tokens", "position")]
            out: list[list] = [[] for _ in range(7)]
            for doc, total, position, stored in zip(*columns, batch["ids"]):
                raw = stored.as_buffer()
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * total else "<u4").astype("<u4")
                start = 0
                while start < total:
                    sequence, offset = divmod(position + start, length)
                    size = min(length - offset, total - start)
                    for column, value in zip(out, (doc, start, size, ids[start:start + size].tobytes(), total, sequence, offset)):
                        column.append(value)
                    start += size
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
    return cut


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens.

    Returns ``doc_id``, ``start`` and ``length`` of the piece in its document, its
    ``ids`` (little-endian unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id`` and
    ``offset`` in the sequence. Every document is tokenised whole and closed by id 0; its
    hashed token counts, projected to three dimensions, give its place on a Hilbert
    curve. Documents stand in the order of the curve, then of ``doc_id``; their tokens
    are one line, cut every ``length`` tokens, so all sequences are full but the last.

    A null or empty text is the closing id alone. Repeated and null ids are documents of
    their own. An empty table gives no rows. Other columns are ignored.
    """
    rows = tokenised(docs, vocabulary)
    order = [F.col("curve"), F.col("doc_id"), F.col("row")]
    placed = running_start(rows.select("row", "curve", "doc_id", "doc_tokens"), [], order, "doc_tokens", "position")
    joined = rows.join(placed.select("row", "position").hint("shuffle_hash"), "row")
    return joined.select("doc_id", "doc_tokens", "position", "ids").mapInArrow(
        _cutter(length), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
