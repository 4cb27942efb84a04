"""Approximate nearest neighbours by multiprobe p-stable hashing with exact reranking."""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.sinks.tables import written_table

TABLES, PROJECTIONS = 12, 16
PROBES = 800               # perturbed buckets that a table may offer to a query
TARGET = 0.97              # estimated chance to meet a neighbour, at which a query stops probing
WIDTH = 3.0                # width of a hash cell, in multiples of the radius
BLOCK_FLOATS = 1 << 21     # numbers in a block of candidates; at most BLOCK_ROWS rows
BLOCK_ROWS = 32_768
QUERY_ROWS = 8192
SAMPLE_ROWS, SAMPLE_FLOATS, SAMPLE_QUERIES = 4096, 1 << 21, 256
NO_ID = (1 << 63) - 1
FAR_CELL = float(1 << 40)
SEED = 20240511

_erf = np.vectorize(math.erf, otypes=[np.float64])


@dataclass(frozen=True)
class Plan:
    """What all tasks share: vector length and the distance neighbours are expected within."""

    dim: int
    radius: float
    k: int


def vectors_of(vectors: DataFrame) -> DataFrame:
    """``row``, ``vec_id``, ``embedding`` (doubles) of the vectors that take part, as a written table."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    fit = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fit = fit & F.exists(numbers, lambda x: x != 0)
    kept = vectors.filter(F.coalesce(fit, F.lit(False)))
    return written_table(kept.select("vec_id", numbers.alias("embedding")).withColumn("row", F.monotonically_increasing_id()))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``node``, ``embedding``, ``holders`` of each different vector, as a written table.

    ``holders`` are its first ``k`` + 1 rows by id, which is all that a list of ``k``
    neighbours can hold of it beside the query's own row.
    """
    first = Window.partitionBy("embedding").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    held = rows.withColumn("__place", F.row_number().over(first)).filter(F.col("__place") <= k + 1)
    holder = F.struct(F.coalesce("vec_id", F.lit(NO_ID)).alias("id"), F.col("row"))
    return written_table(held.groupBy("embedding").agg(F.min("row").alias("node"), F.collect_list(holder).alias("holders")))


def _matrix(lists: pa.ChunkedArray, dim: int) -> np.ndarray:
    """One line of ``dim`` numbers per list; missing places are 0."""
    lists = lists.combine_chunks()
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), dim))
    out[np.arange(dim) < counts[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _distances(vector: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances from differences, scaled where squares would overflow."""
    gaps = np.abs(others - vector)
    with np.errstate(over="ignore"):
        found = np.sqrt((gaps * gaps).sum(axis=1))
    if not np.isfinite(found).all():
        most = gaps.max(axis=1, keepdims=True, initial=0.0)
        most[most == 0] = 1.0
        found = most[:, 0] * np.sqrt(((gaps / most) ** 2).sum(axis=1))
    return found


def fit_plan(index: DataFrame, k: int) -> Plan:
    """Vector length over all rows, and the radius from a sample.

    The radius is the upper decile of the distance to the ``k``-th neighbour, of
    ``SAMPLE_QUERIES`` vectors within a sample of ``SAMPLE_ROWS`` (fewer, if they hold
    more than ``SAMPLE_FLOATS`` numbers), chosen by a hash.
    """
    dim = index.agg(F.max(F.size("embedding"))).first()[0] or 1
    rows = max(2, min(SAMPLE_ROWS, SAMPLE_FLOATS // dim))
    sample = _matrix(index.orderBy(F.xxhash64("node"), "node").limit(rows).select("embedding").toArrow()["embedding"], dim)
    reach = [np.partition(line, min(k, len(sample) - 1))[min(k, len(sample) - 1)]
             for line in (_distances(v, sample) for v in sample[:SAMPLE_QUERIES])]
    radius = float(np.quantile(reach, 0.9)) if reach else 1.0
    return Plan(dim, radius if 0 < radius < math.inf else 1.0, k)


def _perturbations(projections: int, count: int) -> np.ndarray:
    """Sets of ranks in the order of their expected cost, as rows of flags.

    The 2 * ``projections`` ways to step over a border of a cell are ranked by their
    cost; the expected cost of every rank is known beforehand, so that one order of
    the sets of ranks serves all queries. Sets come off a heap: the least one is
    followed by itself with its last rank raised by one, and with the next rank added.
    """
    m, ranks = projections, np.arange(1, 2 * projections + 1, dtype=np.float64)
    rest = 2 * m + 1 - ranks
    cost = np.where(ranks <= m, ranks * (ranks + 1) / (4 * (m + 1) * (m + 2)),
                    1 - rest / (m + 1) + rest * (rest + 1) / (4 * (m + 1) * (m + 2)))
    sets, heap = [()], [(cost[0], (0,))]
    while heap and len(sets) < count:
        total, chosen = heapq.heappop(heap)
        sets.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    flags = np.zeros((len(sets), 2 * m))
    for at, chosen in enumerate(sets):
        flags[at, list(chosen)] = 1
    return flags


class _Hashes:
    """The hash tables' functions; the same in every task."""

    def __init__(self, plan: Plan):
        random = np.random.default_rng(SEED)
        self.plan, self.width = plan, WIDTH * plan.radius
        self.lines = random.standard_normal((plan.dim, TABLES * PROJECTIONS))
        self.shift = random.uniform(0, 1, TABLES * PROJECTIONS)
        self.mix = random.integers(1, 1 << 62, (TABLES, PROJECTIONS)) | 1
        self.sets = _perturbations(PROJECTIONS, PROBES)

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell numbers and the places within the cells, in widths."""
        with np.errstate(over="ignore", invalid="ignore"):
            at = np.nan_to_num(vectors @ self.lines / self.width + self.shift, nan=0.0)
        at = np.clip(at, -FAR_CELL, FAR_CELL).reshape(-1, TABLES, PROJECTIONS)
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """One key per vector and table."""
        return (cells * self.mix).sum(axis=2)

    def chances(self, place: np.ndarray) -> np.ndarray:
        """Logarithms of the chance that a neighbour lies a cell below, in the same cell, and a cell above."""
        reach = 1 / WIDTH
        edges = np.stack([-place - 1, -place, 1 - place, 2 - place]) / (reach * math.sqrt(2))
        return np.log(np.maximum(np.diff(0.5 * _erf(edges), axis=0), 1e-30))

    def probes(self, key: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tables and keys of the buckets one query visits, most promising first, up to the target.

        ``key`` has one key per table, ``chance`` the three logarithms per projection.
        """
        tables, keys, hopes = [], [], []
        for t in range(TABLES):
            below, same, above = chance[:, t]
            cost = np.concatenate([same - below, same - above])
            order = np.argsort(cost)
            step = np.concatenate([-self.mix[t], self.mix[t]])[order]
            # of a projection's two borders only one can be stepped over
            partner = np.empty_like(order)
            partner[order] = np.arange(2 * PROJECTIONS)
            sides = partner.reshape(2, PROJECTIONS)
            fit = ~(self.sets[:, sides[0]] * self.sets[:, sides[1]]).any(axis=1)
            chosen = self.sets[fit]
            keys.append(key[t] + chosen.astype(np.int64) @ step)
            hopes.append(np.exp(same.sum() - chosen @ cost[order]))
            tables.append(np.full(len(chosen), t))
        tables, keys, hopes = map(np.concatenate, (tables, keys, hopes))
        order = np.argsort(-hopes, kind="stable")
        tables, keys, hopes = tables[order], keys[order], hopes[order]
        missed = np.ones(len(order))
        for t in range(TABLES):
            missed *= 1 - np.minimum(np.cumsum(np.where(tables == t, hopes, 0)), 1)
        stop = int(np.searchsorted(1 - missed, TARGET)) + 1
        return tables[:stop], keys[:stop]


def _nearest(query: np.ndarray, rows: np.ndarray, squares: np.ndarray, at: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows ``at`` the ``count`` nearest and all as near as the last of them, with their distances."""
    if len(at) > count:
        own = float(query @ query)
        with np.errstate(over="ignore", invalid="ignore"):
            rough = squares[at] - 2 * (rows[at] @ query) + own
            slack = 1e-9 * (squares[at] + own)
        if np.isfinite(rough).all():
            # the rough values decide only where they are surely apart
            at = at[rough - slack <= np.partition(rough + slack, count - 1)[count - 1]]
    found = _distances(query, rows[at])
    if len(at) > count:
        near = found <= np.partition(found, count - 1)[count - 1]
        at, found = at[near], found[near]
    return at, found


def _search(plan: Plan):
    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        out = {"query_row": [none], "query_id": [none], "rank_id": [none], "other_row": [none], "score": [np.zeros(0)]}
        if len(queries) and len(candidates):
            hashes, k = _Hashes(plan), plan.k
            rows = _matrix(candidates["embedding"], plan.dim)
            with np.errstate(over="ignore"):
                squares = (rows * rows).sum(axis=1)
            holders = candidates["holders"].combine_chunks()
            ends = holders.offsets.to_numpy()
            held = holders.values
            ids, places = held.field("id").to_numpy(), held.field("row").to_numpy()
            keys = hashes.keys(hashes.cells(rows)[0])
            tables = [(order := np.argsort(keys[:, t], kind="stable"), keys[order, t]) for t in range(TABLES)]
            asked = _matrix(queries["embedding"], plan.dim)
            cells, place = hashes.cells(asked)
            own_keys, everyone = hashes.keys(cells), np.arange(len(rows))
            for q, (row, vec_id) in enumerate(zip(queries["row"].to_pylist(), queries["vec_id"].to_pylist())):
                which, wanted = hashes.probes(own_keys[q], hashes.chances(place[q]))
                seen = np.zeros(len(rows), bool)
                for t, (order, sorted_keys) in enumerate(tables):
                    mine = wanted[which == t]
                    low, high = np.searchsorted(sorted_keys, mine, "left"), np.searchsorted(sorted_keys, mine, "right")
                    for a, b in zip(low[high > low], high[high > low]):
                        seen[order[a:b]] = True
                at, found = _nearest(asked[q], rows, squares, np.flatnonzero(seen), k + 1)
                if len(at) <= k or found.max() > plan.radius:
                    # too few, or farther than the probes were planned for: the whole block
                    at, found = _nearest(asked[q], rows, squares, everyone, k + 1)
                take = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in at])
                score = np.repeat(found, ends[at + 1] - ends[at])
                take, score = take[places[take] != row], score[places[take] != row]
                best = np.lexsort((places[take], ids[take], score))[:k]
                take = take[best]
                out["query_row"].append(np.full(len(take), row))
                out["query_id"].append(np.full(len(take), vec_id))
                out["rank_id"].append(ids[take])
                out["other_row"].append(places[take])
                out["score"].append(score[best])
        return pa.table({name: np.concatenate(parts) for name, parts in out.items()})
    return search


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Per query its ``k`` nearest found: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Queries are the rows whose ``vec_id`` is divisible by ``every``, candidates all
    rows but the query's own; ``score`` is the Euclidean distance in double precision.

    ``TABLES`` hash tables of ``PROJECTIONS`` Gaussian projections each are built over every
    different vector. A query visits its own buckets and perturbed ones in the order of
    the estimated chance that a neighbour within the radius lies there, until the tables
    together reach ``TARGET``; the merged candidates are compared exactly. Where fewer
    than ``k`` + 1 are met, or the last of them is beyond the radius, the whole block of
    candidates is compared: nothing is capped. Candidates are dealt into blocks, every
    block of queries meets every block of candidates once, the block winners are merged.

    Vectors that are null, zero, or hold a null or non-finite component take no part;
    shorter vectors count as filled up with 0. Equal distances are ranked by ``vec_id``,
    null last. Repeated ids are separate rows, equal vectors are compared once. A query
    with fewer candidates gets them all; an empty table gives no rows. Other columns are ignored.
    """
    rows = vectors_of(vectors)
    index = distinct_vectors(rows, k)
    plan = fit_plan(index, k)
    queries = rows.filter(F.col("vec_id") % every == 0)
    size = max(256, min(BLOCK_ROWS, BLOCK_FLOATS // plan.dim))
    blocks = max(1, -(-index.count() // size))
    groups = max(1, -(-queries.count() // min(QUERY_ROWS, size)))
    counted = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = index.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks))).withColumn("group", counted(groups))
    asked = queries.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups))).withColumn("block", counted(blocks))
    best = asked.groupBy("block", "group").cogroup(dealt.groupBy("block", "group")).applyInArrow(
        _search(plan), "query_row long, query_id long, rank_id long, other_row long, score double")
    order = Window.partitionBy("query_row").orderBy("score", "rank_id", "other_row")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.nullif("rank_id", F.lit(NO_ID)).alias("vec_id"), "score")
