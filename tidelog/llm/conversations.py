"""Repair of the turn structure of conversations by lightest derivations."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512                # rows whose repairs are derived at once
CACHED = 1 << 14           # blocks whose derivations a task remembers
SPACES = " \t\n\x0b\f\r"   # fixed values: what does not count as content
ENDS = ".!?"               # fixed values: how a whole text ends

# what was written last: nothing, the system turn, a user turn, an assistant turn
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
KEEPS = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
RIGHT = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1

SOUND, BLANK, DUPLICATE, CUT = range(4)
HEAD, FIRST, ROW = range(3)   # a conversation's mark, the mark of a text's first row, a row

REPORT = ("conv_id {}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that crc32(``conv_id:turn``) modulo 20 gives them; nulls read as one space there.

    0 drops a row (``dropped`` is true, its other columns null), 1 empties its text, 2 takes
    the marks ``.!?`` from it, 3 repeats it, 4 makes its role ``user``. Null roles and texts
    become one space; ids and turns stay as they are.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(space("text"), ENDS, "")).otherwise(space("text"))
    rows = conversations.select(
        "conv_id", (fault == 0).alias("dropped"), "turn", F.when(fault == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"), F.when(fault == 3, 2).otherwise(1).alias("times"))
    kept = lambda c: F.when(~F.col("dropped"), F.col(c)).alias(c)
    return rows.select("conv_id", "dropped", kept("turn"), kept("role"), kept("text"),
                       F.explode(F.sequence(F.lit(1), "times")).alias("copy")).drop("copy")


@lru_cache(maxsize=CACHED)
def derive(block: str, entries: tuple[tuple[int, int], ...], last: bool) -> list[tuple[int, int, int, str]]:
    """Lightest derivations over a block of rows: (state, cost, entry, edits) per result.

    ``block`` has two signs per row: the role's initial, and ``D`` for a row that has to
    go, ``T`` for a truncated and ``-`` for a sound one. ``entries`` are the states reached
    before the block with their costs, lightest edits first. An item (rows done, state)
    is deduced from another by one edit; its value (cost, entry, edits) grows with every
    edit and keeps the order of values, so the items come off the agenda in the order
    of their final values. With ``last`` the only result is the goal: all rows done, in
    a state that ends a conversation. Otherwise there is one result per state reached
    by the edit of the block's last row.
    """
    rows = len(block) // 2
    agenda = [(cost, entry, "", 0, state) for entry, (state, cost) in enumerate(entries)]
    heapq.heapify(agenda)
    final: set[tuple[int, int]] = set()
    results = []
    while agenda:
        cost, entry, edits, at, state = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if at == rows:
            if not last:
                results.append((state, cost, entry, edits))
                continue
            if state in (EMPTY, ASSISTANT):
                return [(state, cost, entry, edits)]
        push = lambda letter, to, more, then: (
            (to, then) in final or heapq.heappush(agenda, (cost + COSTS[letter] + more, entry, edits + letter, to, then)))
        push(INSERT, at, 0, NEXT[state])
        if at < rows:
            initial, fault = block[2 * at], block[2 * at + 1]
            push(DELETE, at + 1, 0, state)
            if fault != "D":
                more = TRUNCATED_COST if fault == "T" else 0
                if (state, initial) in KEEPS:
                    push(KEEP, at + 1, more, KEEPS[state, initial])
                push(REROLE, at + 1, more, NEXT[state])
    return results


# a state is given up where another reaches all that it can, at less cost; by how much the other has to be cheaper
_REACHES = {(ASSISTANT, USER): 2, (USER, ASSISTANT): 2, (ASSISTANT, SYSTEM): 0, (USER, SYSTEM): 2, (EMPTY, SYSTEM): 0,
            (EMPTY, USER): 2, (EMPTY, ASSISTANT): 4, (SYSTEM, USER): 2, (SYSTEM, ASSISTANT): 4,
            (ASSISTANT, EMPTY): 3, (USER, EMPTY): 5}


class _Path:
    """Edits of the blocks so far, and the digest of what they leave."""

    __slots__ = ("before", "edits", "digest", "written", "state")

    def __init__(self, before, edits, digest, written, state):
        self.before, self.edits, self.digest, self.written, self.state = before, edits, digest, written, state

    def audit(self) -> str:
        parts, path = [], self
        while path is not None:
            parts.append(path.edits)
            path = path.before
        return "".join(reversed(parts))


class _Conversation:
    """Rows of one conversation in their order: counts, and the lightest repair, block by block.

    Held are a block of rows, the edits of the states that are still open, and nothing else.
    """

    def __init__(self, conv_id):
        self.conv_id, self.counts = conv_id, [0, 0, 0, 0]
        self.low = self.high = self.turn = None
        self.turns = self.illegal = 0
        self.initial = None
        self.first = self.row = None       # order of the last mark of a first row, and of the last row
        self.rows: list[tuple[str, str, int]] = []
        self.open = [(0, _Path(None, "", hashlib.sha256(), False, EMPTY))]

    def mark_first(self, order: tuple) -> None:
        self.first = order

    def add(self, order: tuple, turn, role: str, text: str, blank: bool, cut: bool) -> None:
        again = order != self.first or order == self.row
        self.row = order
        fault = BLANK if blank else DUPLICATE if again else CUT if cut else SOUND
        self.counts[fault] += 1
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.high:
                self.turns += 1
            self.high = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in RIGHT:
            self.illegal += 1
        self.initial = initial
        if len(self.rows) == BLOCK:
            self._advance(last=False)
        self.rows.append((role, text, fault))

    def _advance(self, last: bool) -> None:
        signs = "".join((role[:1] or " ") + ("T" if fault == CUT else "-" if fault == SOUND else "D") for role, _, fault in self.rows)
        entries = tuple((path.state, cost) for cost, path in self.open)
        least = min(cost for _, cost in entries)
        found = derive(signs, tuple((state, cost - least) for state, cost in entries), last)
        costs = {state: cost for state, cost, _, _ in found}
        ahead = []
        for state, cost, entry, edits in found:
            if any((other, state) in _REACHES and costs[other] + _REACHES[other, state] < cost for other in costs):
                continue
            ahead.append((cost + least, entry, edits, self._write(self.open[entry][1], edits)))
        # of equal entries the one with the lesser edits comes first: the order of (entry, edits)
        ahead.sort(key=lambda x: x[1:3])
        self.open = [(cost, path) for cost, _, _, path in ahead]
        self.rows = []

    def _write(self, path: _Path, edits: str) -> _Path:
        digest, written, state, rows = path.digest.copy(), path.written, path.state, iter(self.rows)
        for edit in edits:
            role, text, _ = ("", "", 0) if edit == INSERT else next(rows)
            if edit == DELETE:
                continue
            state = KEEPS[state, role[:1]] if edit == KEEP else NEXT[state]
            name = role if edit == KEEP else ROLES[state]
            digest.update(f"{chr(10) if written else ''}{name}:{text}".encode())
            written = True
        return _Path(path, edits, digest, written, state)

    def report(self) -> tuple:
        self._advance(last=True)
        cost, path = self.open[0]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT], self.illegal, cost,
                path.audit(), path.digest.hexdigest())


def _repairs(schema: pa.Schema, report_rows: int = 4096):
    def repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "digest", "text", "blank", "cut")]
            for conv_id, kind, turn, role, digest, text, blank, cut in zip(*columns):
                if current is None or conv_id != current.conv_id:
                    if current is not None:
                        done.append(current.report())
                    current = _Conversation(conv_id)
                if kind == FIRST:
                    current.mark_first((turn, role, digest))
                elif kind == ROW:
                    current.add((turn, role, digest), turn, role, text, blank, cut)
            if len(done) >= report_rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                done = []
        if current is not None:
            done.append(current.report())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
    return repairs


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Faults of every conversation and the cheapest edits that repair it.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and ``dropped`` (rows that only tell that
    a conversation exists; see ``damaged``). A conversation is in the order of its turns, null
    first; rows of one turn come by role, then by a digest of role and text, so equal rows stand
    together. ``gaps`` are missing turns; each row's first fault counts as ``blank``, ``duplicate``
    or ``truncated``; ``illegal`` are neighbours whose roles do not follow each other.

    Edits keep a row (K), give it the role user or assistant (R, cost 2), delete it (D, cost 3;
    blank and duplicate rows have to go) or insert an empty turn (I, cost 2); a truncated
    row that stays costs 1. The repaired initials are ``(s?(ua)+)?``. ``audit`` has the initials of
    the cheapest edits, the least string of equal cost. The edits are found by Knuth's
    generalisation of shortest paths to lightest derivations, in blocks of ``BLOCK`` rows.
    A row whose role is empty has no initial and is never kept as it is. Null roles and texts
    read as one space; a null ``conv_id`` is a conversation of its own.

    A text's first row is found by an aggregate over digests, and joins the stream of rows
    as a mark beside it. A conversation goes through one task as a stream, since a
    digest of its text is sequential; a task holds ``BLOCK`` rows and one letter per edit. No
    rows give no rows; other columns are ignored.
    """
    spark, binary = rows.sparkSession, lambda c: F.col(c).cast("binary")
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    given = rows.select("conv_id", "dropped", "turn", space("role").alias("role"), space("text").alias("text"))
    core = F.rtrim(F.col("text"), F.lit(SPACES))
    full = given.filter(~F.col("dropped")).select(
        "conv_id", "turn", "role", F.unhex(F.sha2(F.concat(binary("role"), F.lit(b"\x00"), binary("text")), 256)).alias("digest"),
        "text", (core == "").alias("blank"), (~F.right(core, F.lit(1)).isin(*ENDS)).alias("cut"))

    def marks(df: DataFrame, kind: int, turn: Column, role: Column, digest: Column) -> DataFrame:
        return df.select("conv_id", F.lit(kind).alias("kind"), turn.alias("turn"), role.alias("role"), digest.alias("digest"),
                         F.lit("").alias("text"), F.lit(False).alias("blank"), F.lit(False).alias("cut"))

    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = full.groupBy("conv_id", "role", "digest").agg(F.min(order).alias("__at"))
    first = marks(first, FIRST, F.col("__at")["turn"], F.col("role"), F.col("digest"))
    heads = marks(given.filter("dropped").select("conv_id").distinct(), HEAD, F.lit(None).cast(given.schema["turn"].dataType),
                  F.lit(None).cast("string"), F.lit(None).cast("binary"))
    stream = full.select("conv_id", F.lit(ROW).alias("kind"), "turn", "role", "digest", "text", "blank", "cut").unionByName(first).unionByName(heads)
    report = REPORT.format(given.schema["conv_id"].dataType.simpleString())
    schema = pa.schema(spark.createDataFrame([], report).toArrow().schema)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (stream.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest", "kind")
            .mapInArrow(_repairs(schema), report))
