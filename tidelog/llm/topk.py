"""Exact top-k inner products by term-at-a-time accumulation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.sinks.tables import written_table

BLOCK_ROWS = 2048   # rows of a candidate block, and of a query block
SAFE = float(1 << 62)  # sums of products surely below this are exact in 64 bits
LEAST, MOST = -(1 << 63), (1 << 63) - 1
NO_ID = (1 << 63) - 1


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``row``, ``vec_id``, ``terms``: floor(scale * x) of each component, as a written table.

    Vectors that are null or hold a null or non-finite component are left out. Components
    beyond 64 bits stay at the last number that fits.
    """
    parts = F.transform("embedding", lambda x: x.cast("double"))
    fit = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    kept = vectors.filter(F.coalesce(fit, F.lit(False)))
    return written_table(kept.select("vec_id", F.transform(parts, lambda x: F.floor(x * scale).cast("long")).alias("terms"))
                         .withColumn("row", F.monotonically_increasing_id()))


def _matrix(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of every component other than 0."""
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lists)), counts)
    terms = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    weights = lists.flatten().to_numpy(zero_copy_only=False)
    full = weights != 0
    return rows[full], terms[full], weights[full]


def _settle(scores: np.ndarray, own: tuple, others: tuple) -> None:
    """Put right the scores that may have left 64 bits: exact where they fit, else the last number that does.

    ``own`` and ``others`` are rows, terms and weights of the queries and the candidates. 64-bit
    sums wrap around, so a sum that ends inside the range is right as it is.
    """
    def floats(rows, terms, weights, count):
        most = int(max(own[1].max(initial=-1), others[1].max(initial=-1))) + 1
        out = np.zeros((count, most))
        out[rows, terms] = weights
        return out

    queries, candidates = floats(*own, scores.shape[0]), floats(*others, scores.shape[1])
    if np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * queries.shape[1] < SAFE:
        return
    for q, c in np.argwhere(np.abs(queries) @ np.abs(candidates).T >= SAFE).tolist():
        mine = dict(zip(own[1][own[0] == q].tolist(), own[2][own[0] == q].tolist()))
        there = others[0] == c
        total = sum(mine.get(t, 0) * w for t, w in zip(others[1][there].tolist(), others[2][there].tolist()))
        scores[q, c] = min(max(total, LEAST), MOST)


def _search(k: int):
    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        found = {"query_row": [none], "query_id": [none], "rank_id": [none], "score": [none]}
        if len(queries) and len(candidates):
            # null ids come last among equal scores
            ids = candidates["other_id"].combine_chunks().fill_null(NO_ID).to_numpy()
            candidates = candidates.take(pa.array(np.lexsort((candidates["other_row"].to_numpy(), ids))))
            ids = np.sort(ids)
            rows = candidates["other_row"].to_numpy()
            doc, doc_term, weight = _matrix(candidates["other_terms"].combine_chunks())
            order = np.argsort(doc_term, kind="stable")
            doc, doc_term, weight = doc[order], doc_term[order], weight[order]
            ends = np.searchsorted(doc_term, np.arange(int(doc_term.max(initial=-1)) + 2))
            query, query_term, factor = _matrix(queries["terms"].combine_chunks())
            own, own_ids = queries["row"].to_numpy(), queries["vec_id"].to_numpy()
            # postings of one term after the other are scattered into the score arrays of the queries that have it
            scores = np.zeros((len(queries), len(candidates)), np.int64)
            by_term = np.argsort(query_term, kind="stable")
            query, query_term, factor = query[by_term], query_term[by_term], factor[by_term]
            heads = np.searchsorted(query_term, np.arange(len(ends)))
            for term in range(len(ends) - 1):
                posting, values = doc[ends[term]:ends[term + 1]], weight[ends[term]:ends[term + 1]]
                dense = len(posting) == len(candidates)
                for at in range(heads[term], heads[term + 1]):
                    if dense:
                        scores[query[at]] += factor[at] * values
                    else:
                        scores[query[at], posting] += factor[at] * values
            _settle(scores, (query, query_term, factor), (doc, doc_term, weight))
            place = np.arange(len(candidates))
            for q in range(len(queries)):
                line, others = scores[q], rows != own[q]
                line, at = line[others], place[others]
                if len(line) > k:
                    limit = np.partition(line, len(line) - k)[len(line) - k]
                    above, level = np.flatnonzero(line > limit), np.flatnonzero(line == limit)
                    chosen = np.concatenate([above, level[:k - len(above)]])  # ids rise with the place
                    line, at = line[chosen], at[chosen]
                found["query_row"].append(np.full(len(at), own[q]))
                found["query_id"].append(np.full(len(at), own_ids[q]))
                found["rank_id"].append(ids[at])
                found["score"].append(line)
        return pa.table({name: np.concatenate(parts).astype(np.int64) for name, parts in found.items()})
    return search


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per query its ``k`` highest scores: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Queries are the rows whose ``vec_id`` is divisible by ``every``, candidates all
    rows but the query's own. The score is the inner product of the quantised vectors
    (see ``quantised``; in vectors of unequal length missing components count as 0).
    Equal scores are ranked by ``vec_id``, null last. Rows are dealt into blocks of
    about ``block_rows``, every block of queries meets every block of candidates in a
    task of its own, and the block winners are merged.

    A score beyond 64 bits is the last number that fits. Repeated ids are separate rows. A
    query with fewer candidates gets them all; an empty table gives no rows. Other columns are ignored.
    """
    rows = quantised(vectors, scale)
    queries = rows.filter(F.col("vec_id") % every == 0)
    blocks = max(1, -(-rows.count() // block_rows))
    groups = max(1, -(-queries.count() // block_rows))
    # rows are numbered within their files, so the remainder deals them out evenly whatever the ids
    dealt = rows.select(F.col("vec_id").alias("other_id"), F.col("terms").alias("other_terms"), F.col("row").alias("other_row"),
                        F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
    asked = queries.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    dealt = dealt.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    best = asked.groupBy("block", "group").cogroup(dealt.groupBy("block", "group")).applyInArrow(
        _search(k), "query_row long, query_id long, rank_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "rank_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.nullif("rank_id", F.lit(NO_ID)).alias("vec_id"), "score")
