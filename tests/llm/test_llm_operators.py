"""Operators of the training-data folder against plain versions, and on odd tables."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.llm import graph, language, linking, textnum, topk, warc
from tidelog.llm.fingerprints import edited, fingerprints, linked_documents
from tidelog.llm.graph import components, running_start
from tidelog.llm.language import UNKNOWN, fit_languages, identify, keep_identified, language_of
from tidelog.llm.linking import is_link, spanning_links, verified_links
from tidelog.llm.mixing import _permuted, mixed_blocks, repeated_documents, source_targets, taken_words
from tidelog.llm.near_dedup import near_duplicates, one_per_group
from tidelog.llm.packing import hilbert_keys, pack
from tidelog.llm.quality import OrdinalModel, fit_quality, grade, keep_good
from tidelog.llm.sharding import SLOTS, placed, rebalance, shard_documents, slotted, store_map
from tidelog.llm.toxicity import fit_toxicity, score_texts, toxicity_of
from tidelog.session import work_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, key int, row long, root long, label string, rank int, slot int"
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"


def table(spark, texts, first_id=0):
    rows = [(i + first_id, t, "en", ("b", "a", None)[i % 3], len(t or ""), "x", 1, 2, 3, "y", 4, 5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts():
    long_text = " ".join(f"w{i}" for i in range(30_000))
    return [None, "", " \t\n", "?!", "a", BASE, BASE.upper(), BASE + " more", BASE, long_text, long_text + " end", "é ñ 中文 😀" * 3, "x" * 70_000,
            "I can't say it's they've \n\n  done.", None, ""]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, odd_texts()).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def plain_components(sets, percent):
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def plain_set(text, words):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i:i + words]) for i in range(len(found) - words + 1)}


def varied_texts(seed, families=6, copies=9):
    rng, texts = np.random.default_rng(seed), []
    for f in range(families):
        base = [f"f{f}w{w}" for w in rng.integers(0, 500, rng.integers(3, 80))]
        for _ in range(copies):
            words = list(base)
            for at in rng.integers(0, len(words), rng.integers(0, 4)):
                words[at] = f"n{rng.integers(0, 9)}" if rng.random() < 0.5 else f"n{rng.integers(0, 10**6)}"
            texts.append(" ".join(words))
    return texts


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    texts = [t for t in odd_texts() if t] + varied_texts(1)
    data, offsets = textnum.utf8(pa.array(texts))
    whole = textnum.word_hashes(data, offsets, textnum.BY_SPACE_FOLDED)
    monkeypatch.setattr(textnum, "PIECE", 40)
    for a, b in zip(whole, textnum.word_hashes(data, offsets, textnum.BY_SPACE_FOLDED)):
        assert (a == b).all()
    assert np.diff(whole[2]).tolist() == [len(WORD.findall(t)) for t in texts]


@pytest.mark.parametrize("few", [1, 3, 24])
def test_spanning_links_connect_like_all_links(monkeypatch, few):
    monkeypatch.setattr(linking, "FEW", few)
    rng = np.random.default_rng(few)
    for _ in range(60):
        sets = []
        for _ in range(rng.integers(1, 4)):
            base = rng.integers(0, 10**6, rng.integers(3, 60))
            for _ in range(rng.integers(1, 25)):
                x, n = base.copy(), rng.integers(0, len(base) // 5 + 2)
                x[rng.choice(len(x), min(n, len(x)), replace=False)] = rng.integers(0, 40 if rng.random() < 0.5 else 10**6, min(n, len(x)))
                sets.append(np.unique(x).astype(np.uint64))
        plain = plain_components([set(s.tolist()) for s in sets], 80)
        parent = list(range(len(sets)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in spanning_links(sets, 80):
            assert is_link(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]), 80)
            parent[max(root(a), root(b))] = min(root(a), root(b))
        assert [root(i) for i in range(len(sets))] == plain


def test_spanning_links_when_a_part_is_overtaken():
    # the smaller family is held more; the link between both runs through sets skipped in either
    runs = [(0, 30), (10, 1), (30, 40), (20, 1)]
    sets = [np.arange(first, first + 90) for first, copies in runs for _ in range(copies)]
    sets += [np.r_[0:20, 1000 * i:1000 * i + 70] for i in range(1, 61)] + [np.r_[110:120, 1000 * i:1000 * i + 80] for i in range(61, 66)]
    parent = list(range(len(sets)))
    for a, b in spanning_links([s.astype(np.uint64) for s in sets], 80):
        parent = [parent[b] if p == parent[a] else p for p in parent]
    assert len(set(parent[:72])) == 1 and len(set(parent)) == 66


@pytest.mark.parametrize("group_items", [linking.GROUP_ITEMS, 40])
def test_large_clusters_are_divided_without_loss(spark, group_items):
    sets = [sorted(hash(s) & ((1 << 63) - 1) for s in plain_set(t, 2)) for t in varied_texts(2)]
    rows = [(i, np.array(s, np.uint64).tobytes()) for i, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "node long, items binary")
    keys = spark.range(len(rows)).select(F.col("id").alias("node"), F.lit(1).cast("long").alias("key"))
    roots = {r.node: r.root for r in components(verified_links(frame, keys, 80, group_items)).collect()}
    assert [roots.get(i, i) for i in range(len(rows))] == plain_components([set(s) for s in sets], 80)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (301, 300), (302, 301), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {i: 300 for i in range(300, 303)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("order", ["up", "down", "shuffled"])
def test_components_of_long_chains_take_few_rounds(spark, monkeypatch, order):
    monkeypatch.setattr(graph, "TASK_LINKS", 1)
    ids = list(range(3000))[::-1 if order == "down" else 1]
    if order == "shuffled":
        np.random.default_rng(1).shuffle(ids)
    tables, write = [], graph.written_table
    monkeypatch.setattr(graph, "written_table", lambda df, path=None: tables.append(path) or write(df, path))
    links = [(int(a), int(b)) for a, b in zip(ids, ids[1:])] + [(5000 + i, 5000) for i in range(1, 50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(3000)} | {i: 5000 for i in range(5000, 5050)}
    assert len(tables) <= 2 * 16 + 1
    monkeypatch.setattr(graph, "TASK_LINKS", 1 << 20)
    assert {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()} == got


def test_language_scores_equal_plain_kernels(spark, sf):
    """Scores of a batch against presence kernels computed with sets, window by window."""
    docs, _ = sf
    model = fit_languages(docs)
    texts = [r.text for r in docs.limit(60).collect()] + ["", None, "12 34", "ab " * 9000, "Ein Satz. Une phrase."]
    names, scores = model.predict(texts)
    weight = dict(zip(model.grams.tolist(), model.weights))
    for text, name, score in zip(texts, names, scores):
        sets = [set(w.tolist()) for w in language.windows(text)]
        if not sets:
            assert (name, score) == (UNKNOWN, 0)
            continue
        values = np.mean([sum((weight[g] for g in s if g in weight), np.zeros(len(model.names))) / len(s) ** 0.5 for s in sets], axis=0) + model.bias
        assert name == model.names[int(values.argmax())] and score == pytest.approx(np.clip((values.max() + 1) / 2, 0, 1))


def test_every_language_has_a_landmark(spark):
    """More languages than landmarks: the last ones of the alphabet are told as well."""
    rng = np.random.default_rng(9)
    letters = [chr(0x4E00 + i) for i in range(4000)]
    docs = [(i * 10 + j, " ".join("".join(rng.choice(letters[20 * i:20 * i + 20], 4)) for _ in range(30)), f"l{i:03d}") for i in range(150) for j in range(4)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    told = identify(frame, fit_languages(frame)).select("doc_id", "lang_pred").collect()
    right = [r.lang_pred == f"l{r.doc_id // 10:03d}" for r in told]
    assert sum(right) >= 0.95 * len(right)
    late = [r.lang_pred == f"l{r.doc_id // 10:03d}" for r in told if r.doc_id >= 1400]
    assert sum(late) >= 0.9 * len(late)


def test_running_start(spark):
    rows = [(i, ("hot" if i % 3 else None), i % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g string, n long")
    got = {r.id: r.start for r in running_start(df, ["g"], [F.col("id")], "n", "start").collect()}
    sums = {}
    for i, g, n in rows:
        assert got[i] == sums.get(g, 0)
        sums[g] = sums.get(g, 0) + n


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_match_plain_version(spark, words):
    texts = varied_texts(3) + odd_texts()
    got = {r.doc_id: r for r in near_duplicates(table(spark, texts), words, 80).collect()}
    sets = [plain_set(t, words) for t in texts]
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    plain = plain_components(sets, 80)
    assert [got[i].component_id for i in range(len(texts))] == plain
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_duplicates_null_and_repeated_ids(spark, none):
    df = table(spark, [BASE, BASE, "alone here"]).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_duplicates(df.union(df)).collect())
    assert got == [("1", "1", True)] * 2 + [("2", "2", True)] * 2 + [("None", "1", False)] * 2
    assert near_duplicates(none).count() == 0


def test_null_ids_with_different_texts(spark):
    other, third = BASE.replace("e", "x"), BASE.replace("e", "y")
    texts = [BASE, BASE + " more", other, other + " more", third, third, "", "lone words"]
    ids = [5, None, 9, None, None, None, None, None]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = near_duplicates(df, 4).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == sorted(
        [("5", "5", True), ("None", "5", False), ("9", "9", True), ("None", "9", False), ("None", "None", True), ("None", "None", False)] + [("None", "None", True)] * 2)


def test_one_row_of_each_group(spark, none):
    other = BASE.replace("e", "x")
    rows = [(7, BASE), (7, BASE), (7, other), (8, BASE + " more"), (None, "alone here"), (None, "alone here"), (None, other + " more"), (None, ""), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash"))
    got = one_per_group(df, 4)
    assert got.columns == df.columns and sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted(
        [("7", BASE), ("7", other), ("None", "alone here"), ("None", ""), ("None", "")])
    assert one_per_group(none).count() == 0


def test_fingerprints(spark, odd, none):
    texts = [t or "" for t in odd_texts()]
    rows = sorted(fingerprints(odd).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    by_text = {}
    for i, r in enumerate(rows):
        changed = edited(texts[i], texts[(i + 1) % len(texts)])
        assert r.n_chars == len(texts[i]) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert by_text.setdefault(texts[i], r.fingerprint) == r.fingerprint
        assert by_text.setdefault(changed, r.edited_fingerprint) == r.edited_fingerprint
        assert r.near_next == np.mean([a == b for a, b in zip(re.findall("....", r.fingerprint), re.findall("....", rows[(i + 1) % len(rows)].fingerprint))])
    assert rows[8].near_next == 0 and rows[5].near_next == 1  # upper and lower case are one
    assert abs(rows[9].near_next - 1) < 0.05
    assert fingerprints(none).count() == 0
    single = fingerprints(table(spark, ["one two"])).collect()
    assert len(single) == 1 and single[0].near_next == 1
    assert fingerprints(odd.union(odd)).count() == 2 * len(texts)
    without_id = fingerprints(table(spark, [BASE, "other"]).withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert len(without_id) == 2


def test_likeness_follows_jaccard(spark):
    words = [f"w{i}" for i in range(2000)]
    texts = [" ".join(words), " ".join(words[:1500] + ["z"] + words[1500:]), " ".join(words[:1000] + [f"x{i}" for i in range(1000)])]
    rows = sorted(fingerprints(table(spark, texts)).collect(), key=lambda r: r.doc_id)
    for i, r in enumerate(rows):
        a, b = plain_set(texts[i], 5), plain_set(texts[(i + 1) % 3], 5)
        assert abs(r.near_next - len(a & b) / len(a | b)) < 0.15


def test_linked_documents(spark, none):
    texts = varied_texts(4) + odd_texts()
    got = {r.doc_id: r.group_id for r in linked_documents(table(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_components([plain_set(t, 5) for t in texts], 80)
    assert linked_documents(none).count() == 0


def archive_rows(spark, texts):
    rows = [(i, f"http://a/{i} b\n", None if t is None else bytearray(t.encode())) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "record_id long, target_uri string, payload binary")


def test_archives_round_trip(spark, monkeypatch):
    texts = odd_texts() + ["p" * 999, "p" * 999, "q" * 1000, "q" * 1000, "WARC/1.0\r\n\r\n" * 500, "\r\n\r\n"]
    rows = warc.archive_round_trip(spark, archive_rows(spark, texts)).collect()
    data, last = {}, {}
    for r in sorted(rows, key=lambda r: (r.record_id, r.chunk_no)):
        n = int(re.search(r"-?\d+", r.record_id)[0])
        data[n] = data.get(n, b"") + (r.data or b"")
        if r.record_type == "response":
            assert r.upto == len(data[n]) and r.digest == hashlib.sha1(data[n]).hexdigest() and len(r.data) <= warc.CHUNK
        last[n] = r
    for i, t in enumerate(texts):
        payload = (t or "").encode()
        same = [j for j, u in enumerate(texts) if (u or "").encode() == payload]
        winner = max(same) if len(payload) >= 1000 else i
        assert last[i].last and last[i].payload_bytes == len(payload) and last[i].digest == hashlib.sha1(payload).hexdigest()
        assert last[i].record_type == ("response" if winner == i else "revisit")
        assert last[i].refers_to == (None if winner == i else f"<urn:record:{winner}>")
        assert data[i] == (payload if winner == i else b"")
    assert warc.archive_round_trip(spark, archive_rows(spark, [])).count() == 0


def test_archives_with_long_headers(spark):
    uri = "http://host/" + "é" * 200_000
    rows = archive_rows(spark, ["page", "p" * 2000]).withColumn("target_uri", F.lit(uri))
    chunks = warc.archive_round_trip(spark, rows).collect()
    assert {r.target_uri for r in chunks} == {uri} and [bytes(r.data) for r in sorted(chunks, key=lambda r: r.record_id)] == [b"page", b"p" * 2000]


def test_archives_with_null_and_repeated_ids(spark):
    page = "z" * 1500
    rows = archive_rows(spark, [page, page]).withColumn("record_id", F.when(F.col("record_id") == 1, 1)).withColumn("target_uri", F.lit(None).cast("string"))
    chunks = warc.archive_round_trip(spark, rows.union(rows)).collect()
    assert sorted((r.record_id, r.record_type) for r in chunks) == [("<urn:record:1>", "response")] * 2 + [("<urn:record:null>", "revisit")] * 2


def test_damaged_archives_fail(spark, tmp_path):
    folder = work_dir(spark, "warc")
    files = warc.write_archives(warc.chunked(warc.with_revisits(archive_rows(spark, ["a" * 5000]))), folder)
    path = [r.path for r in files.collect()][0]
    local = path.removeprefix("file:")
    raw = open(local, "rb").read()
    open(tmp_path / "cut.warc.gz", "wb").write(raw[:-20])
    with pytest.raises(Exception, match="ends within|invalid|incorrect"):
        warc.read_chunks(spark.createDataFrame([(str(tmp_path / "cut.warc.gz"),)], "path string")).collect()


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_packing_matches_tokenizer(spark, odd, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    texts = [t or "" for t in odd_texts()]
    ids = [t.ids + [0] for t in tokenizer.encode_batch(texts, add_special_tokens=False)]
    pieces = pack(odd, VOCABULARY).collect()
    got = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == len(got.setdefault(p.doc_id, [])) and p.doc_tokens == len(ids[p.doc_id])
        got[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
        assert p.length == len(p.ids) // 4
    assert [got[i] for i in range(len(texts))] == ids
    line = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    place = 0
    for p in line:
        assert p.sequence_id * 1024 + p.offset == place and p.offset + p.length <= 1024
        place += p.length
    assert pack(none, VOCABULARY).count() == 0
    assert sum(p.length for p in pack(odd.union(odd), VOCABULARY).collect()) == 2 * place


def test_tokens_of_mixed_characters():
    import random

    from tidelog.llm.tokens import word_tokens
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    parts = ["'", "'s", "'re", "'ll", "'ve", "'t", " ", "  ", "\n", "\t", "\r\n", "a", "Bc", "é", "中", "1", "٣", "²", "!", "...", "　", "😀", "<|endoftext|>", "_"]
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 20))) for _ in range(1500)]
    for text, ids, want in zip(texts, word_tokens(VOCABULARY).encode(texts), tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == want.ids, text


def test_added_tokens_in_texts():
    import random

    from tidelog.llm.tokens import token_ids
    from tokenizers import Tokenizer

    tokenizer, rnd = Tokenizer.from_file(VOCABULARY), random.Random(6)
    parts = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "a", " b", "'s", "é", "中", "1", "."]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "", "x"] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(800)]
    got = list(token_ids(pa.array([None, *texts]), VOCABULARY))
    assert got[0].tolist() == [] and got[1].tolist() == [64, 220, 50256, 275]
    for text, ids, want in zip(texts, got[1:], tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == want.ids, text


def test_mixing(spark, odd, none):
    texts = [" ".join(["w"] * (i % 37)) for i in range(600)]
    docs = table(spark, texts).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("doc_id") % 5)))
    rows = taken_words(docs).collect()
    assert sorted(r.doc_id for r in rows) == list(range(600)) and all(r.size == r.doc_id % 37 and r.taken <= 2 * r.size for r in rows)
    by_source = {}
    names = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    for r in rows:
        s = by_source.setdefault(names[r.doc_id], [0, 0, r.target, r.source_size])
        s[0], s[1] = s[0] + r.size, s[1] + r.taken
    total = sum(s[0] for s in by_source.values())
    level_targets = plain_targets({k: v[0] for k, v in by_source.items()})
    for name, (size, taken, target, source_size) in by_source.items():
        assert size == source_size and target == pytest.approx(level_targets[name])
        assert abs(taken - target) <= max(2, 0.02 * target)
    assert sum(s[2] for s in by_source.values()) == pytest.approx(1.5 * total)
    assert sorted(rows) == sorted(taken_words(docs.repartition(7)).collect())
    pieces = {}
    for p in mixed_blocks(docs).collect():
        pieces[p.doc_id] = pieces.get(p.doc_id, 0) + p.words
    assert {r.doc_id: r.taken for r in rows if r.taken} == pieces
    copies = repeated_documents(docs).groupBy("doc_id").count().collect()
    assert {r.doc_id for r in copies if r["count"] > 2} == set()
    assert taken_words(none).count() == 0 and repeated_documents(none).count() == 0
    assert taken_words(odd).count() == odd.count() and repeated_documents(odd).columns == odd.columns


@pytest.mark.parametrize("count", [1, 2, 3, 64, 65, 1000, 4097])
def test_permutations_reach_every_number_once(spark, count):
    rows = spark.range(count).select(_permuted(F.col("id"), F.lit(count).cast("long"), F.lit(7)).alias("p")).collect()
    assert sorted(r.p for r in rows) == list(range(count))
    if count == 4097:
        # no arithmetic progression: the steps between neighbours are all over the place
        assert len({(b.p - a.p) % count for a, b in zip(rows, rows[1:])}) > count // 2


def test_source_counts_of_shards_are_drawn(spark):
    """Mean and variance over shards are those of draws without putting back, not those of an even deal."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 1400).alias("text"), F.lit(1).alias("__turn"),
                                    F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    drawn = mixed_blocks(docs).select("shard", "slot", "source").distinct().groupBy("shard", "source").count().collect()
    sizes = {}
    for r in drawn:
        sizes[r.shard] = sizes.get(r.shard, 0) + r["count"]
    full = [s for s, n in sizes.items() if n == 1024]
    slots = sum(sizes.values())
    assert len(full) >= 40
    for source in ("s0", "s1", "s2"):
        counts = np.array([sum(r["count"] for r in drawn if r.shard == s and r.source == source) for s in full])
        share = sum(r["count"] for r in drawn if r.source == source) / slots
        variance = 1024 * share * (1 - share) * (slots - 1024) / (slots - 1)
        assert abs(counts.mean() - 1024 * share) < 5 * (variance / len(full)) ** 0.5 + 1
        assert 0.4 * variance < counts.var() < 2.2 * variance


def test_stages_keep_clashing_columns(spark):
    texts = [BASE, BASE, "other words that are not the same as those " * 3, None]
    docs = table(spark, texts).withColumns({n: F.col("doc_id") + 77 for n in ("__row", "__turn", "__times", "__doc", "__TIMES_")})
    for stage in (one_per_group, repeated_documents):
        got = stage(docs)
        assert got.columns == docs.columns
        assert all(r[n] == r.doc_id + 77 for r in got.collect() for n in ("__row", "__turn", "__times", "__doc", "__TIMES_"))


def plain_targets(sizes, weights=(3, 1, 2)):
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    left, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        share = left / sum(weight[n] for n in free)
        full = [n for n in free if share * weight[n] > 2 * sizes[n]]
        if not full:
            return target | {n: share * weight[n] for n in free}
        for n in full:
            target[n] = 2.0 * sizes[n]
            left -= target[n]
            free.discard(n)
    return target


def test_targets_of_odd_sources(spark):
    for sizes in ({"a": 0, "b": 5}, {"a": 0}, {None: 7}, {"a": 1, "b": 1000, "c": 3, "ü": 500, None: 2}):
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in source_targets(df).collect()}
        assert got == pytest.approx(plain_targets(sizes))


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(0, 0.2, 8).tolist()) for i in range(300)] + [(50, [0.1] * 8), (50, [0.1] * 8), (None, [0.3] * 8), (301, [9.0])]
    rows += [(400 + i, [0.25] * 8) for i in range(60)] + [(100, None), (150, [0.1, None]), (200, [float("nan")]), (250, [float("inf")])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", F.lit("clash")).withColumn("block", F.lit(1))
    usable = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows
              if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for at, (q, v) in enumerate(usable):
        if q is not None and q % 50 == 0:
            scores = sorted((-int((v[:min(len(v), len(c))] * c[:min(len(v), len(c))]).sum()), (i is None, i or 0)) for j, (i, c) in enumerate(usable) if j != at)
            want += [(q, r + 1, None if i[0] else i[1], -s) for r, (s, i) in enumerate(scores[:5])]
    for blocks in (2048, 37):
        got = [tuple(r) for r in topk.top_k(df, block_rows=blocks).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.filter("vec_id = 50").limit(1)).count() == 0


def test_top_k_of_large_components(spark):
    """Every finite vector is scored, exactly as far as 64 bits go."""
    rows = [(50, [70_000.0, 1.0]), (1, [70_000.0, -3.0]), (2, [-1e9, 5.0]), (3, [1e30, 0.0]), (4, [-1e30, 0.0]), (5, [0.0, 1e17]), (6, [2e12, 7.0])]
    got = [tuple(r)[2:] for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=9).orderBy("rank").collect()]
    most, least = (1 << 63) - 1, -(1 << 63)
    floor = lambda x: max(min(int(256 * x), most), least)
    exact = {i: sum(floor(a) * floor(b) for a, b in zip(rows[0][1], v)) for i, v in rows[1:]}
    want = sorted(((i, min(max(s, least), most)) for i, s in exact.items()), key=lambda r: (-r[1], r[0]))
    assert got == want


def test_sharding(spark, odd, none):
    hot = table(spark, ["same text"] * 300 + [f"text {i} " + "w" * (i % 90) for i in range(600)])
    rows = shard_documents(hot).collect()
    loads = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    assert max(loads) - min(loads) <= 30 and sum(loads) == sum(r.size for r in rows)
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    got = {r.doc_id: r for r in shard_documents(odd).collect()}
    for i, t in enumerate(odd_texts()):
        assert got[i].size == len((t or "").encode()) + 1 and got[i].text_crc32 == zlib.crc32((t or "").encode())
    assert len({got[i].shard for i in (5, 8)}) == 1 and {r.law for r in rows} == {"bytes"}
    assert shard_documents(none).count() == 0


def test_equal_texts_share_a_shard(spark):
    """Whatever slot they fall into; only copies that outweigh a fair shard are divided, and evenly."""
    texts = [f"group {i % 40} " + "x" * (i % 40) * 9 for i in range(800)] + ["single " + str(i) for i in range(50)]
    rows = shard_documents(table(spark, texts), slots=16).collect()
    where = {}
    for r in rows:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(shards) == 1 for shards in where.values())
    heavy = table(spark, [None] * 3000 + ["very heavy text"] * 900 + [f"text {i}" for i in range(500)])
    rows = shard_documents(heavy).collect()
    loads = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    assert max(loads) <= 1.1 * sum(loads) / 8
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_rebalancing_moves_few_slots(spark):
    docs = table(spark, [f"text {i} " + "w" * (i % 90) for i in range(800)])
    folder = work_dir(spark, "maps")
    records = slotted(docs)
    first = store_map(spark, placed([(r.slot, r.b, r.n) for r in records.groupBy("slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()], 8), folder, 0)
    grown = rebalance(records, first, 9, folder, 1)
    old, new = ({r.slot: r.shard for r in m.collect()} for m in (first, grown))
    moved = [s for s in old if new[s] != old[s]]
    assert moved and np.mean([new[s] == 8 for s in moved]) > 0.9 and len(moved) < len(old) / 4
    loads = {r.shard: r.b for r in grown.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
    assert len(loads) == 9 and max(loads.values()) < 1.15 * min(loads.values())
    same = rebalance(records, first, 8, folder, 2)
    assert sum(old[r.slot] != r.shard for r in same.collect()) < len(old) / 20
    assert sorted(r.version for r in spark.read.parquet(folder).select("version").distinct().collect()) == [0, 1, 2] and max(old) < SLOTS


@pytest.fixture(scope="module")
def sf(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    return read("documents").cache(), read("labels").cache()


def test_languages(spark, sf, odd, none):
    docs, _ = sf
    rows = language_of(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    model = fit_languages(docs)
    got = {r.doc_id: r for r in identify(odd, model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, 3, 14)] == [UNKNOWN] * 5 and got[0].score == 0
    assert got[5].lang_pred == "en" and got[5].score == got[8].score
    assert identify(none, model).count() == 0 and keep_identified(odd, model).columns == odd.columns
    assert {r.doc_id for r in keep_identified(odd, model).collect()} <= set(got) - {0, 1, 2, 3, 14}
    unlabelled = language_of(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {UNKNOWN} and language_of(none).count() == 0
    one = language_of(odd).collect()
    assert {r.lang_pred for r in one} == {"en", UNKNOWN}


def test_languages_of_very_long_texts(spark, sf):
    docs, _ = sf
    rng = np.random.default_rng(4)
    script = [chr(0x4E00 + i) for i in range(3000)]
    zipf = 1 / np.arange(1, 3001)
    chinese = lambda n: "".join(np.array(script)[rng.choice(3000, n, p=zipf / zipf.sum())])
    model = fit_languages(docs.select("doc_id", "text", "lang").union(
        spark.createDataFrame([(10**6 + i, chinese(400), "zh") for i in range(60)], "doc_id long, text string, lang string")))
    texts, want = [], []
    for lang in ("de", "en", "es", "fr"):
        own = [r.text for r in docs.filter(F.col("lang") == lang).orderBy("doc_id").limit(60).collect()]
        long = next(t for t in own if len(t) > 500)
        texts += [long * (1_000_000 // len(long)), (" ".join(own) + " ") * (1_000_000 // sum(map(len, own)))]
        want += [lang] * 2
        short = model.predict([long])
        assert short[0] == [lang] and abs(short[1][0] - model.predict(texts[-2:-1])[1][0]) < 0.1
    names, scores = model.predict([*texts, chinese(20_000), chinese(500_000)])
    assert names == [*want, "zh", "zh"] and (scores > 0.7).all()


def test_held_out_languages_are_not_learned(spark, sf):
    docs, _ = sf
    wrong = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, "xx").otherwise(F.col("lang")))
    assert sorted(language_of(docs).collect()) == sorted(language_of(wrong).collect())


def test_quality(spark, sf, odd, none):
    docs, labels = sf
    even = fit_quality(docs, labels.filter("doc_id % 2 = 0"))
    rows = grade(docs, even).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    kept = {q: np.mean([r.tail >= 0.3 for r in rows if r.quality == q]) for q in (0, 1)}
    assert kept[1] > 0.95 and kept[0] < 0.3
    got = grade(odd, even).collect()
    assert len(got) == odd.count() and all(0 <= r.tail <= 1 for r in got) and grade(none, even).count() == 0
    assert keep_good(odd, even).columns == odd.columns and keep_good(none, even).count() == 0
    unrated = fit_quality(docs, labels.limit(0))
    assert {(r.expected_grade, r.tail) for r in grade(odd, unrated).collect()} == {(None, 1.0)}
    assert keep_good(odd, unrated).count() == odd.count()
    assert {r.expected_grade for r in grade(odd, fit_quality(docs, labels.filter("quality = 1"))).collect()} == {1.0}


def test_ordinal_model_orders_more_grades():
    rng = np.random.default_rng(2)
    rows = rng.normal(0, 1, (900, 5)).astype(np.float32)
    hidden = rows[:, 0] + 0.3 * rng.normal(0, 1, 900)
    model = OrdinalModel.fit(rows, np.digitize(hidden, [-0.8, 0.2, 0.9]) + 2)
    assert model.grades == [2, 3, 4, 5] and (np.diff(model.thresholds) > 0).all()
    tails = model.tails(rows)
    assert (np.diff(tails, axis=1) <= 0).all()
    assert np.corrcoef(tails.sum(axis=1), hidden)[0, 1] > 0.9


def test_texts_without_content_are_not_selected(spark, sf):
    docs, labels = sf
    model = fit_quality(docs, labels)
    hollow = spark.createDataFrame([(1, None), (2, ""), (3, " \n\t")], "doc_id long, text string")
    assert {(r.expected_grade, r.tail) for r in grade(hollow, model).collect()} == {(float(model.grades[0]), 0.0)}
    assert keep_good(hollow, model).count() == 0


def test_toxicity(spark, sf, odd, none):
    docs, labels = sf
    rows = toxicity_of(docs, labels).join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    clean = [r for r in rows if not r.toxic]
    assert np.mean([r.predicted for r in clean]) < 0.05
    flagged = [r for r in rows if r.toxic and not r.held_out]
    assert np.mean([r.predicted for r in flagged]) > 0.5
    model = fit_toxicity(docs, labels)
    got = {r.doc_id: r for r in score_texts(odd, model).collect()}
    assert got[0].score == got[1].score == got[3].score == 0 and got[0].sentences == 0 and len(got) == odd.count()
    assert score_texts(none, model).count() == 0
    assert {r.score < 1e-6 for r in score_texts(odd, fit_toxicity(docs, labels.limit(0))).collect()} == {True}


def test_places_are_those_of_the_given_text(spark):
    """Also behind letters whose lower case has another length."""
    words = np.random.default_rng(9).integers(0, 400, (200, 60))
    texts = [" ".join(f"İw{w}ẞ" for w in words[i]) + f". Line {i}. All İs so." + (" You vile wretch! İye." if i % 2 else "") for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    for r in score_texts(docs, fit_toxicity(docs, labels)).collect():
        if r.doc_id % 2:
            assert [texts[r.doc_id][o.start:o.end].strip() for o in r.offending] == ["You vile wretch!"]


def test_offending_sentences_are_located(spark):
    words = np.random.default_rng(9).integers(0, 400, (200, 60))
    texts = [" ".join(f"w{w}" for w in words[i]) + f". Line {i}. All is so." + (" You vile wretch! Bye." if i % 2 else "") for i in range(200)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    docs = table(spark, texts)
    for r in score_texts(docs, fit_toxicity(docs, labels)).collect():
        assert (r.score >= 0.7) == (r.doc_id % 2 == 1)
        if r.doc_id % 2:
            assert [texts[r.doc_id][o.start:o.end].strip() for o in r.offending] == ["You vile wretch!"]


def test_held_out_labels_are_not_learned(spark, sf):
    docs, labels = sf
    wrong = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(toxicity_of(docs, labels).select("doc_id", "score").collect()) == sorted(toxicity_of(docs, wrong).select("doc_id", "score").collect())
