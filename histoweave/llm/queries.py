"""The registered queries of this subpackage and the SQL that some of them can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histoweave.llm import chat_format, cost_packing, decontamination, hard_negatives, language_id, license_scan, minhash_dedup, packing, pitman_yor, prefix_trie, secret_ledger, tiff, toxicity
from histoweave.llm.common import fold, table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ledger.scan_documents(table(spark, sf_dir, "documents"))


def op3_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.text_media(table(spark, sf_dir, "documents"))


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxicity.score(docs, model).select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"))
    return language_id.identify(docs, language_id.fit(docs, ~F.col("held_out")), ("doc_id", "held_out"))


def op11_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost_packing.pack_balanced(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_minhash_dedup, op2_secret_ledger, op3_tiff_media, op4_pitman_yor, op5_best_fit_packing, op6_decontamination, op7_toxicity, op8_license_scan, op9_chat_format, op10_language_id, op11_cost_packing, op12_prefix_trie, op13_hard_negatives)}

OP1_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM w WHERE len(ws) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS (SELECT doc_id, md5(string_agg(g, chr(10) ORDER BY g)) AS h FROM s GROUP BY doc_id),
c AS (SELECT h, min(doc_id) AS rep FROM f GROUP BY h),
r AS (SELECT s.doc_id, g FROM s JOIN c ON s.doc_id = c.rep),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM r a JOIN r b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
t(a, b) AS (SELECT rep, rep FROM c UNION SELECT t.a, u.b FROM t JOIN u ON t.b = u.a),
k AS (SELECT a, min(b) AS component_id FROM t GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(k.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(k.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN c USING (h) LEFT JOIN k ON k.a = c.rep
"""


def _op2_sql() -> str:
    parts = []
    for order, rule in enumerate(secret_ledger.RULES):
        p = rule.pattern.replace("'", "''")
        parts.append(
            f"SELECT doc_id, {order} AS o, '{rule.kind}' AS kind, {rule.least} AS least, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {rule.group}) AS g, string_split_regex(t, '{p}') AS s FROM d WHERE regexp_matches(t, '{p}')"
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r AS ({" UNION ALL ".join(parts)}),
x AS (SELECT doc_id, o, kind, least, unnest(generate_series(1, len(m))) AS i, m, g, s FROM r),
y AS (SELECT doc_id, o, kind, length(g[i]) >= least AS ok,
             list_sum(list_transform(s[1:i], lambda z: length(z))) + coalesce(list_sum(list_transform(m[1:i-1], lambda z: length(z))), 0) AS st, length(m[i]) AS n FROM x),
f AS (SELECT doc_id, o, kind, CAST(st AS BIGINT) AS st, CAST(st + n AS BIGINT) AS en FROM y WHERE ok)
SELECT d.doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, o) FILTER (o < 3), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, o), '') AS spans
FROM d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id
"""


#: DuckDB has no crc32, so `z` and `h` spell it out: a table of bytes, and a fold over the digits.
OP12_SQL = """
WITH z AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END, i)) AS z),
t AS (
  SELECT conv_id, md5(length(r) || ':' || r || x) AS m, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS w,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || x)) AS n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL) y),
l AS (SELECT conv_id AS c, list({'m': m, 'w': w} ORDER BY n) AS own FROM t GROUP BY 1),
h AS (
  SELECT c, own, xor(4294967295, list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: ascii(d)),
         lambda a, d: xor(z[1 + xor(a & 255, d)], a >> 8), 4294967295)) % 4 AS h FROM l, z),
r AS (SELECT h.c, list_concat(coalesce(b.own[1:h], []), h.own[h + 1:]) AS s FROM h LEFT JOIN l b ON b.c = h.c - h.c % 20),
p AS (
  SELECT c, d, len(s) AS total, array_to_string(list_transform(s[1:d], lambda x: x.m), ',') AS k, array_to_string(list_transform(s[1:d - 1], lambda x: x.m), ',') AS up, coalesce(s[d].w, 0) AS w, s
  FROM (SELECT c, s, unnest(generate_series(0, len(s))) AS d FROM r) x),
n AS (
  SELECT d, k, min(up) AS up, min(w) AS w, min(c) AS rep, count(*) AS n, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = total), '') AS ends, min(list_transform(s[1:d], lambda x: x.m)) AS path
  FROM p GROUP BY d, k),
g AS (SELECT d, up, count(*) AS children FROM n WHERE d > 0 GROUP BY d, up),
f AS (SELECT n.*, coalesce(g.children, 0) AS children FROM n LEFT JOIN g ON g.d = n.d + 1 AND g.up = n.k),
u AS (SELECT a AS d, array_to_string(path[1:a], ',') AS k, sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * w) AS saved FROM (SELECT f.*, unnest(generate_series(0, d)) AS a FROM f) x GROUP BY 1, 2)
SELECT f.rep AS conv_id, f.d AS depth, q.rep AS parent_conv_id, f.n AS n_convs, f.children AS n_children, CAST(u.leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN u USING (d, k) LEFT JOIN n q ON q.d = f.d - 1 AND q.k = f.up
"""

OP13_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.k AS ak, a.vec_id AS anchor_id, b.k AS bk, b.vec_id, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS s
  FROM e a JOIN e b ON a.vec_id % 100 = 0),
p AS (
  SELECT ak, slot, vec_id AS positive_id, s AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY ak ORDER BY s DESC, vec_id NULLS LAST) AS slot FROM s WHERE same AND ak <> bk) x WHERE slot <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s AS negative_score,
         row_number() OVER (PARTITION BY ak, slot ORDER BY s DESC, s.vec_id NULLS LAST) AS rank
  FROM p JOIN s USING (ak) WHERE NOT same AND 30 * positive_score <= 100 * s AND 100 * s <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {"op1_minhash_dedup": OP1_SQL, "op2_secret_ledger": _op2_sql(), "op12_prefix_trie": OP12_SQL, "op13_hard_negatives": OP13_SQL}
