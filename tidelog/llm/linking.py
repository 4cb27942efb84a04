"""Links between similar sets among candidates, without listing all pairs of a group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.graph import components
from tidelog.llm.textnum import give_back
from tidelog.sinks.tables import written_table

GROUP_ITEMS = 4_000_000  # set members of a cluster solved in one task (8 bytes each); larger ones are split
LARGE = 1 << 20          # bytes of a cluster after which a worker gives its memory back
FEW = 24                 # holders of one member that are compared pair by pair


def is_link(shared, left, right, percent: int):
    """Whether sets of sizes ``left`` and ``right`` reach a Jaccard likeness of ``percent`` / 100."""
    return 100 * shared >= percent * (left + right - shared)


def prefix_length(size, percent: int):
    """Of sets in one common order, linked ones share a member among so many first ones."""
    return size - (percent * size + 99) // 100 + 1


def spanning_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (positions) that connect the non-empty sets just as all links would.

    A member is rare if at most ``FEW`` sets hold it. Linked sets that share a rare
    member share one within the prefixes (rarest first) of both: the holders of such a
    member are compared in pairs unless already connected. Linked sets that share only
    common members consist of these to ``percent`` or more: the sets that do so, the
    core, are compared with all of the core, one after the other. Only sets of the part
    that is the largest in the end may go without a turn: those skipped in a part that
    another one has overtaken get theirs later. The set whose members are held most goes
    first, so that one turn connects most of a family of near copies.
    """
    sizes = np.array([len(s) for s in sets])
    _, member, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    begin = np.cumsum(sizes) - sizes
    parent, links = np.arange(len(sets)), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(x: int, y: int) -> None:
        a, b = root(x), root(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
            links.append((x, y))

    def largest_part(of: np.ndarray) -> tuple[int, int]:
        """Root and size of the largest connected part; afterwards ``parent`` holds roots."""
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]
        parts = np.bincount(parent[of])
        return int(np.argmax(parts)), int(parts.max())

    owner = np.repeat(np.arange(len(sets)), sizes)
    common = held[member] > FEW
    core = np.flatnonzero(100 * np.add.reduceat(common, begin, dtype=np.int64) >= percent * sizes)
    if len(core) > 1:
        popular = np.add.reduceat(held[member], begin)[core] / sizes[core]
        lengths = sizes[core]
        edges = np.cumsum(lengths) - lengths
        items = member[np.arange(lengths.sum()) - np.repeat(edges - begin[core], lengths)]
        marked = np.zeros(len(held), bool)
        waiting = core[np.argsort(-popular, kind="stable")].tolist()
        while waiting:
            skipped = []
            for x in waiting:
                largest, size = largest_part(core)
                if size == len(core):
                    break
                if size > 1 and parent[x] == largest:
                    skipped.append(x)
                    continue
                own = member[begin[x]:begin[x] + sizes[x]]
                marked[own] = True
                shared = np.add.reduceat(marked[items], edges, dtype=np.int64)
                marked[own] = False
                for y in core[is_link(shared, sizes[x], lengths, percent)].tolist():
                    join(x, y)
            # another part may have become the largest since a set was skipped
            largest, _ = largest_part(core)
            waiting = [x for x in skipped if parent[x] != largest]
    order = np.lexsort((member, held[member], owner))
    ranks = np.arange(len(owner)) - begin[owner]
    near = order[(ranks < prefix_length(sizes, percent)[owner])]
    near = near[~common[near]]
    near = near[np.lexsort((owner[near], member[near]))]
    tokens, holders = member[near], owner[near]
    pairs = [np.zeros((0, 2), np.int64)]
    for step in range(1, FEW):
        same = np.flatnonzero(tokens[step:] == tokens[:-step]) if step < len(tokens) else []
        if not len(same):
            break
        pairs.append(np.stack([holders[same], holders[same + step]], axis=1))
    for x, y in np.unique(np.concatenate(pairs), axis=0).tolist():
        small, large = sorted((int(sizes[x]), int(sizes[y])))
        if 100 * small >= percent * large and root(x) != root(y):
            shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if is_link(shared, small, large, percent):
                join(x, y)
    return links


def _as_sets(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def _solver(percent: int):
    def solve(table: pa.Table) -> pa.Table:
        nodes = table["node"].to_numpy()
        links = np.array(spanning_links(_as_sets(table["items"].combine_chunks()), percent), np.int64).reshape(-1, 2)
        if table.nbytes > LARGE:
            give_back()
        return pa.table({"a": nodes[links[:, 0]], "b": nodes[links[:, 1]]})
    return solve


def clusters_of(keys: DataFrame) -> DataFrame:
    """``node``, ``root``: nodes that share a ``key``, directly or through others; single nodes have no row."""
    least = keys.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("most")).filter("hub < most")
    return components(keys.join(least, "key").select(F.col("node").alias("a"), F.col("hub").alias("b")))


def verified_links(sets: DataFrame, keys: DataFrame, percent: int, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Links ``a``, ``b`` that connect the candidates just as all their links would.

    ``sets``: ``node`` long and ``items`` binary (sorted distinct unsigned 64-bit
    numbers, none empty); ``keys``: ``node`` and ``key``: nodes with a common key are
    candidates. Candidates are gathered into clusters; a cluster of up to
    ``group_items`` set members is solved exactly in one task. A larger one is dealt
    into blocks of half that size, and each two of its blocks are solved in a task of
    their own, so that a task stays bounded and every pair meets. Empty frames give no
    links.
    """
    members = written_table(sets.join(clusters_of(keys), "node").select(
        "node", "items", "root", (F.octet_length("items") / 8).cast("long").alias("n")))
    blocks = members.groupBy("root").agg(F.sum("n").alias("total"))
    # a block of hashed nodes stays below the limit although their sizes differ
    blocks = blocks.select("root", F.when(F.col("total") <= group_items, F.lit(1)).otherwise(
        F.ceil(F.col("total") * 4 / group_items)).cast("int").alias("blocks"))
    dealt = members.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = dealt.select("node", "items", "root", "block", other).select(
        "node", "items", "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    return paired.groupBy("root", "low", "high").applyInArrow(_solver(percent), "a long, b long")
