"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.conversations import damaged, repair_conversations
from tidelog.llm.filter_audit import audit_filters
from tidelog.llm.fingerprints import fingerprints
from tidelog.llm.language import language_of
from tidelog.llm.mixing import taken_words
from tidelog.llm.near_dedup import near_duplicates
from tidelog.llm.neighbours import nearest
from tidelog.llm.packing import pack
from tidelog.llm.quality import SELECT, fit_quality, grade
from tidelog.llm.sharding import shard_documents
from tidelog.llm.topk import top_k
from tidelog.llm.toxicity import toxicity_of
from tidelog.llm.warc import archive_round_trip, record_number


VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    records = pages.select(F.col("page_id").alias("record_id"), F.col("url").alias("target_uri"),
                           F.col("html").cast("binary").alias("payload"))
    last = archive_round_trip(spark, records).filter("last")
    return last.select(
        record_number("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type",
        record_number("refers_to").alias("refers_to"), (F.col("chunk_no") + 1).alias("chunks"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity_of(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.withColumns({"offending": F.size("offending"), "places": F.col("offending")})


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(_table(spark, sf_dir, "documents"))


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"))


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_of(_table(spark, sf_dir, "documents"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    graded = grade(docs, fit_quality(docs, _table(spark, sf_dir, "labels")))
    return graded.withColumn("selected", (F.col("tail") >= SELECT).cast("int"))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"), shards=8)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(_table(spark, sf_dir, "conversations")))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), every=100, k=10)


def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": fingerprint,
    "op2_warc": warc,
    "op3_packing": packing,
    "op4_toxicity": toxicity,
    "op5_mixing": mixing,
    "op6_topk": search,
    "op7_near_dedup": near_dedup,
    "op8_language": language,
    "op9_quality": quality,
    "op10_sharding": sharding,
    "op11_conversations": conversations,
    "op12_neighbours": neighbours,
    "op13_filter_audit": filter_audit,
}

TOPK_SQL = """
WITH terms AS (
  SELECT vec_id, rowid_, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS t
  FROM (SELECT *, row_number() OVER () AS rowid_ FROM embeddings)
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.rowid_, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.t, c.t), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
  FROM terms q JOIN terms c ON q.rowid_ <> c.rowid_ WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rowid_ ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

WARC_SQL = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
winners AS (SELECT html, max(page_id) AS winner FROM sized WHERE n >= 1000 GROUP BY html)
SELECT page_id, n AS payload_bytes, sha1(s.html) AS payload_digest,
       CASE WHEN winner IS NULL OR winner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN winner <> page_id THEN winner END AS refers_to,
       CASE WHEN winner <> page_id THEN 1 ELSE greatest(1, CAST(ceil(n / 65536) AS BIGINT)) END AS chunks
FROM sized s LEFT JOIN winners w ON s.html = w.html
"""

NEAR_DEDUP_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
  FROM w),
n AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n FROM s),
f AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM f a JOIN f b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT l.y, r.root FROM reach r JOIN both_ways l ON l.x = r.node)
SELECT n.doc_id, n.n AS n_shingles, min(root) AS component_id, n.doc_id = min(root) AS kept
FROM n JOIN reach ON node = n.doc_id GROUP BY n.doc_id, n.n
"""

FILTER_AUDIT_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE) AS e, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic
  FROM w LEFT JOIN l USING (doc_id)),
m AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
         count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY 1, 2),
x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)),
o AS (
  SELECT v.letter || w.letter || x.letter || y.letter || z.letter AS filter_order, [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits
  FROM x v JOIN x w ON w.bit <> v.bit JOIN x ON x.bit NOT IN (v.bit, w.bit) JOIN x y ON y.bit NOT IN (v.bit, w.bit, x.bit)
  JOIN x z ON z.bit NOT IN (v.bit, w.bit, x.bit, y.bit)),
s AS (SELECT filter_order, step, bits[step] AS own, list_sum(bits[1:step - 1]) AS before FROM o, range(1, 6) t(step)),
r AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN mask & (coalesce(before, 0) | own)::INT = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0)::INT = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0)::INT <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0)::INT = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0)::INT = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r
"""

CONVERSATIONS_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT) AS bytes
  FROM conversations),
drawn AS (
  SELECT *, xor(list_reduce([4294967295::BIGINT] || bytes, lambda crc, b: list_reduce(
           [xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295) % 20 AS fault
  FROM keyed),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM drawn WHERE fault <> 0),
placed AS (
  SELECT *, row_number() OVER w AS n, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS ending, left(lag(role) OVER w, 1) || left(role, 1) AS pair
  FROM hurt WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(role || chr(0) || text), copy)),
faulty AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
ins(f, t, c, l, o) AS (VALUES
  ('E', 'E', 0, '', []::VARCHAR[]), ('S', 'S', 0, '', []), ('U', 'U', 0, '', []), ('A', 'A', 0, '', []), ('E', 'U', 2, 'I', ['user:']),
  ('S', 'U', 2, 'I', ['user:']), ('A', 'U', 2, 'I', ['user:']), ('U', 'A', 2, 'I', ['assistant:']),
  ('E', 'A', 4, 'II', ['user:', 'assistant:']), ('S', 'A', 4, 'II', ['user:', 'assistant:'])),
edit(f, l, t, c, initial, name) AS (VALUES
  ('E', 'K', 'S', 0, 's', ''), ('E', 'K', 'U', 0, 'u', ''), ('S', 'K', 'U', 0, 'u', ''), ('U', 'K', 'A', 0, 'a', ''), ('A', 'K', 'U', 0, 'u', ''),
  ('E', 'R', 'U', 2, '', 'user'), ('S', 'R', 'U', 2, '', 'user'), ('A', 'R', 'U', 2, '', 'user'), ('U', 'R', 'A', 2, '', 'assistant'),
  ('E', 'D', 'E', 3, '', ''), ('S', 'D', 'S', 3, '', ''), ('U', 'D', 'U', 3, '', ''), ('A', 'D', 'A', 3, '', '')),
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS n, 'E' AS state, {'c': 0, 'l': '', 'o': []::VARCHAR[]} AS v FROM conversations
  UNION ALL
  SELECT b.conv_id, r.n, e.t, min({
      'c': b.v.c + i.c + e.c + CASE WHEN e.l <> 'D' AND r.fault = 'truncated' THEN 1 ELSE 0 END, 'l': b.v.l || i.l || e.l,
      'o': b.v.o || i.o || CASE WHEN e.l = 'D' THEN [] WHEN e.l = 'K' THEN [r.role || ':' || r.text] ELSE [e.name || ':' || r.text] END})
  FROM best b JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.n = b.n + 1 JOIN ins i ON i.f = b.state JOIN edit e ON e.f = i.t
  WHERE (e.l <> 'K' OR left(r.role, 1) = e.initial) AND (e.l = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
  GROUP BY b.conv_id, r.n, e.t),
goal AS (
  SELECT b.conv_id, min({'c': b.v.c + i.c, 'l': b.v.l || i.l, 'o': b.v.o || i.o}) AS v
  FROM (SELECT * FROM best QUALIFY n = max(n) OVER (PARTITION BY conv_id)) b JOIN ins i ON i.f = b.state WHERE i.t IN ('E', 'A') GROUP BY b.conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id)
SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, v.c::BIGINT AS cost, v.l AS audit,
       sha256(array_to_string(v.o, chr(10))) AS repaired_sha256
FROM goal g LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
"""

SQL: dict[str, str] = {"op2_warc": WARC_SQL, "op6_topk": TOPK_SQL, "op7_near_dedup": NEAR_DEDUP_SQL,
                       "op11_conversations": CONVERSATIONS_SQL, "op13_filter_audit": FILTER_AUDIT_SQL}
