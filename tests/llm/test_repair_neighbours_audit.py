"""Conversation repair, nearest neighbours and the filter audit against plain versions, and on odd tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidelog.llm import conversations, filter_audit, neighbours
from tidelog.llm.conversations import damaged, repair_conversations
from tidelog.llm.filter_audit import audit_filters, packed_masks, text_mask
from tidelog.llm.neighbours import nearest

SPACES = " \t\n\x0b\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string, kind int, digest string, blank string"
KEEPS = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
NEXT = {"E": "U", "S": "U", "U": "A", "A": "U"}
NAMES = {"U": "user", "A": "assistant"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def in_order(row):
    _, turn, role, text = row
    return turn is not None, turn or 0, role, hashlib.sha256(role.encode() + b"\0" + text.encode()).digest()


def fault_of(role, text, seen):
    core = text.rstrip(SPACES)
    return "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""


def plain_repair(rows):
    """Dynamic programme over positions that carries the edited text along."""
    seen, best = set(), {"E": (0, "", ())}

    def inserted(b):
        for _ in range(3):
            for s, (cost, audit, out) in list(b.items()):
                value, to = (cost + 2, audit + "I", (*out, NAMES[NEXT[s]] + ":")), NEXT[s]
                if to not in b or value < b[to]:
                    b[to] = value
        return b

    for _, _, role, text in rows:
        fault, after = fault_of(role, text, seen), {}
        seen.add((role, text))

        def put(state, value, into=after):
            if state not in into or value < into[state]:
                into[state] = value
        for s, (cost, audit, out) in inserted(best).items():
            put(s, (cost + 3, audit + "D", out))
            if fault in ("", "truncated"):
                more = int(fault != "")
                if (s, role[:1]) in KEEPS:
                    put(KEEPS[s, role[:1]], (cost + more, audit + "K", (*out, f"{role}:{text}")))
                put(NEXT[s], (cost + 2 + more, audit + "R", (*out, f"{NAMES[NEXT[s]]}:{text}")))
        best = after
    cost, audit, out = min(v for s, v in inserted(best).items() if s in "EA")
    return cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def plain_report(rows):
    by_conv = defaultdict(list)
    for row in rows:
        by_conv[row[0]]
    for row in plain_damage(rows):
        by_conv[row[0]].append(row)
    found = {}
    for conv, own in by_conv.items():
        own.sort(key=in_order)
        turns, seen, faults = [r[1] for r in own if r[1] is not None], set(), Counter()
        for _, _, role, text in own:
            faults[fault_of(role, text, seen)] += 1
            seen.add((role, text))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, *plain_repair(own))
    return found


def turns_table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], TURNS).repartition(3)


def report(rows):
    return {r[0]: tuple(r[1:]) for r in repair_conversations(damaged(rows)).collect()}


def random_turns(seed, convs, lengths):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for _ in range(rng.choice(lengths)):
            text = rng.choice(["a.", "b", "", " \t", "c!\n", None, "b ", f"{rng.random()}.", f"{rng.random()}", "é？", "x" * 3000 + "."])
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "", "tool", "unknown", None])
            rows.append((conv or None, rng.choice([None, rng.randrange(12), rng.randrange(12)]), role, text))
    return rows


def test_conversations_equal_plain_repair(spark):
    rows = random_turns(1, 120, [1, 3, 9, 40])
    assert report(turns_table(spark, rows)) == plain_report(rows)


def test_conversations_in_blocks(spark, monkeypatch):
    rng = random.Random(2)
    for _ in range(300):
        rows = [(1, t, rng.choice(["user", "assistant", "system", "x"]), rng.choice([f"a.{t}.", f"b{t}", "same.", ""]))
                for t in range(rng.choice([1, 2, 3, 7, 15, 40]))]
        kept = sorted(plain_damage(rows), key=in_order)
        monkeypatch.setattr(conversations, "BLOCK", rng.choice([1, 2, 3, 5]))
        one, seen = conversations._Conversation(1), set()
        for _, turn, role, text in kept:
            order = (turn, role, text)
            if (role, text) not in seen:
                one.mark_first(order)
                seen.add((role, text))
            core = text.rstrip(SPACES)
            one.add(order, turn, role, text, not core, bool(core) and core[-1] not in ".!?")
        assert one.report()[1:] == plain_report(rows)[1]


def test_one_long_conversation(spark):
    """Its edits are as many as its rows; a wholly dropped conversation keeps its row."""
    dropped = next(c for c in range(10**4) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(-5, t, "user" if t % 3 else "assistant", f"turn {t}.") for t in range(6000)] + [(dropped, 0, "user", "gone.")]
    got, want = report(turns_table(spark, rows)), plain_report(rows)
    assert got == want
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_conversations_of_no_rows(spark):
    assert repair_conversations(damaged(turns_table(spark, []))).collect() == []


def test_repeated_rows_of_a_conversation(spark):
    rows = [(1, 0, "user", "hello.")] * 50 + [(1, 1, "assistant", "yes.")] * 2
    assert report(turns_table(spark, rows)) == plain_report(rows)


# -- neighbours ---------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, row long, node long, block int, score double"


def vector_table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, 3, 0.5) for i, v in vectors], VECTORS).repartition(3)


def plain_nearest(vectors, every, k):
    """Sorted (distance, id) lists, one per query row."""
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in vectors
              if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    dim = max((len(v) for _, v in usable), default=0)
    rows = np.array([np.pad(v, (0, dim - len(v))) for _, v in usable]).reshape(len(usable), dim)
    found = []
    for at, (i, _) in enumerate(usable):
        if i is None or i % every:
            continue
        away = np.sqrt(((rows - rows[at]) ** 2).sum(axis=1))
        others = sorted((away[j], usable[j][0] is None, usable[j][0] or 0) for j in range(len(usable)) if j != at)
        found.append((i, [(d, None if null else x) for d, null, x in others[:k]]))
    return found


def lists_of(rows):
    out = defaultdict(list)
    for r in rows.orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    return out


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 24)) * 3
    points = np.concatenate([rng.standard_normal((1500, 24)), centres[rng.integers(0, 20, 1500)] + rng.standard_normal((1500, 24)) * 0.2])
    vectors = [(i, [float(x) for x in p]) for i, p in enumerate(points.astype(np.float32))]
    got, hits, total = lists_of(nearest(vector_table(spark, vectors), every=50, k=10)), 0, 0
    for query, want in plain_nearest(vectors, 50, 10):
        assert [r for r, _, _ in got[query]] == list(range(1, 11))
        scores = [s for _, s, _ in got[query]]
        assert scores == sorted(scores) and all(s >= d - 1e-9 for s, (d, _) in zip(scores, want))
        exact = {i: d for d, i in want}
        for _, s, i in got[query]:
            if i in exact:
                assert s == pytest.approx(exact[i], abs=1e-12)
                hits += 1
        total += 10
    assert hits >= 0.9 * total


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0]), (100, [0.0, 0.0]), (200, None), (300, [nan, 1.0]), (400, [inf, 1.0]), (500, [None, 1.0]), (600, []),
               (1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [0.5]), (3, [1.0, 0.0, 2.0]), (700, [3e38, -3e38]), (4, [2.5e38, 1.0])]
    got = lists_of(nearest(vector_table(spark, vectors), every=100, k=10))
    for query, want in plain_nearest(vectors, 100, 10):
        assert [i for _, _, i in got[query]] == [i for _, i in want]
        assert [s for _, s, _ in got[query]] == pytest.approx([d for d, _ in want], rel=1e-12)
    assert set(got) == {0, 700}


def test_neighbours_among_copies(spark):
    """A third of the rows hold one vector: its least ids are found, each query without its own row."""
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in rng.standard_normal(8).astype(np.float32)]) for i in range(400)] + [(i, [0.25] * 8) for i in range(400, 600)]
    got = lists_of(nearest(vector_table(spark, vectors), every=100, k=10))
    assert [i for _, _, i in got[400]] == list(range(401, 411))
    assert [i for _, _, i in got[500]] == list(range(400, 410))


def test_neighbours_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    monkeypatch.setattr(neighbours, "BLOCK_FLOATS", 8)
    rng = np.random.default_rng(6)
    vectors = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(700)]
    got = lists_of(nearest(vector_table(spark, vectors), every=7, k=5))
    agreed = total = 0
    for query, want in plain_nearest(vectors, 7, 5):
        agreed += sum(a == i for (_, _, a), (_, i) in zip(got[query], want))
        total += len(want)
    assert agreed >= 0.9 * total


def test_neighbours_of_few_or_no_rows(spark):
    assert nearest(vector_table(spark, [])).collect() == []
    assert nearest(vector_table(spark, [(0, [1.0])])).collect() == []
    assert [tuple(r) for r in nearest(vector_table(spark, [(0, [1.0]), (1, [4.0])])).collect()] == [(0, 1, 1, 3.0)]


def test_perturbations_come_in_order_of_cost():
    sets = neighbours._perturbations(4, 200)
    assert len({tuple(s) for s in sets}) == 200 and not sets[0].any()
    ranks = np.arange(1, 9)
    cost = np.where(ranks <= 4, ranks * (ranks + 1) / 120, 1 - (9 - ranks) / 5 + (9 - ranks) * (10 - ranks) / 120)
    totals = sets @ cost
    assert (np.diff(totals) >= -1e-12).all()
    every = np.sort([sum(c) for r in range(9) for c in itertools.combinations(cost, r)])[:200]
    assert totals == pytest.approx(every)


# -- filter audit --------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, mask int, digest string, part string, code long"


def document_table(spark, docs):
    return spark.createDataFrame([(*d, 1, "x", "y", 2) for d in docs], DOCS).repartition(3)


def label_table(spark, labels):
    return spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, part string")


def plain_audit(docs, labels):
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good, toxic = ({i for i, *x in labels if i is not None and x[at] == 1} for at in (0, 1))
    failing = defaultdict(list)
    for i, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": re.search(r"[#$%&*|]", text) is not None,
                 "E": i is not None and least[text] < i}
        failing[lang or ""].append(({x for x in "ABCDE" if fails[x]}, i in good, i in toxic))
    rows = {}
    for part, own in failing.items():
        removed_in_all = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone, left = [d for d in left if letter in d[0]], [d for d in left if letter not in d[0]]
                removed_in_all[letter] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), sum(letter in d[0] for d in own) - len(gone), sum(d[0] == {letter} for d in own),
                    sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(removed_in_all[order[step - 1]])
    return {key: tuple(row) for key, row in rows.items()}


def audited(spark, docs, labels):
    return {tuple(r[:3]): tuple(r[3:]) for r in audit_filters(document_table(spark, docs), label_table(spark, labels)).collect()}


def random_documents(seed, count):
    rng = random.Random(seed)
    texts = [None, "", " \t", "#", "A", "a b c", "x" * 50_000]
    for _ in range(12):
        words = [f"w{rng.randrange(rng.choice([40, 4000]))}" for _ in range(rng.choice([150, 200, 400]))]
        texts.append(" ".join(words) + rng.choice(["", " $5", " ÀÉ中文 😀", " UPPER CASE WORDS" * 6, "\x1c\x85 a"]))
    ids = [None, *range(count)]
    return [(rng.choice(ids), rng.choice(texts), rng.choice(["en", "de", None, "", "中文"])) for _ in range(count)]


def test_audit_equals_plain_audit(spark):
    docs = random_documents(7, 150)
    rng = random.Random(8)
    labels = [(rng.choice([None, *range(150)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)]
    got = audited(spark, docs, labels)
    assert got == plain_audit(docs, labels)
    assert len(got) == 600 * len({d[2] or "" for d in docs})


def test_audit_of_one_text_in_many_rows(spark):
    docs = [(i, "same text", "en") for i in range(300)] + [(0, "same text", "en"), (None, "same text", None), (None, None, None)]
    assert audited(spark, docs, [(5, 1, 1), (5, 0, 0)]) == plain_audit(docs, [(5, 1, 1), (5, 0, 0)])


def test_audit_without_rows(spark):
    assert audited(spark, [], []) == {}
    assert audited(spark, [], [(1, 1, 1)]) == {}


def test_audit_with_many_parts(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "PART_LIMIT", 2)
    docs = [(i, "ABC $" if i % 2 else "plain", f"lang{i % 9}") for i in range(60)]
    assert audited(spark, docs, []) == plain_audit(docs, [])


def test_fields_of_the_packed_integers_do_not_overflow():
    """Sums far beyond any table stay within their fields."""
    many, integers = 2**62, packed_masks()
    total = many * integers[31] + many * integers[31 + 32]
    fields = np.frombuffer(total.to_bytes(3 * filter_audit.FIELDS * 8, "little"), np.uint64).reshape(3, -1)
    assert fields[0, filter_audit.TOTAL] == 2 * many and fields[1, filter_audit.TOTAL] == many and not fields[2].any()
    assert fields[0, :600].reshape(120, 5)[:, 0].tolist() == [2 * many] * 120


def test_words_are_those_between_six_spaces():
    text = "a\x1cb\x85c\u00a0d\u2003e\x0bf"
    assert len(text.encode().split()) == len(WORD.findall(text)) == 2
    assert text_mask("".encode()) == 1
