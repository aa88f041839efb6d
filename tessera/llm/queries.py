"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import bond, hnsw, html, licenses, lines, minhash, piecewise, runs, segmentation, suffixes, toxicity, warc, wavelet
from tessera.llm.common import scratch, table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", F.col("__main").alias("text"), F.length("__main").cast("long").alias("n_chars"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"),
                                          F.sha2("__kept", 256).alias("kept_sha256"))


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op4_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    wavelet.write(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return wavelet.read_index(spark, path)


def op5_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise.neighbour_fingerprints(table(spark, sf_dir, "documents"))


def op6_gumbel_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = segmentation.sampled(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return out.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffixes.with_hits(docs, table(spark, sf_dir, "benchmark")).withColumn("__longest", suffixes.longest_match())
    ids = F.array_sort(F.transform("__hit.items", lambda x: x.cast("string")))
    return out.select(
        "doc_id", F.col("__hit.n_words").alias("n_words"), suffixes.hit_words().alias("n_hit"),
        F.size("__hit.items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("__hit.intervals") > 0).alias("contaminated"), F.coalesce(-F.col("__longest.less"), F.lit(0)).cast("long").alias("longest_words"),
        F.col("__longest.start").alias("longest_start"), F.col("__longest.item_id").cast("long").alias("longest_item"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select(
        "page_id", F.coalesce("length", F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type", "refers_to")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.with_score(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", toxicity.held_out().alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector, against all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = bond.usable(table(spark, sf_dir, "embeddings"), "vec_id", label, "embedding", 256)
    return bond.hard_negatives(rows, F.col("id") % 50 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_vector_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all vectors of equal labels."""
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of them with a periodic tail."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = runs.collapse(docs, arrange=runs.periodic_tail).withColumn("__best", runs.best_run())
    lines = F.transform("__runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.select(
        "doc_id", F.size("__runs").cast("long").alias("n_runs"), F.col("__best.start").alias("start"),
        F.col("__best.length").alias("length"), F.col("__best.period").alias("period"),
        F.expr("1000 * __best.length div __best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("__collapsed", 256).alias("collapsed_sha256"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP3_SQL = rf"""
WITH l AS (
  SELECT doc_id, i, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS p
  FROM (SELECT doc_id, row_number() OVER () AS i, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT *, {_LOWER.format("regexp_replace(line, '^[ \t-\r]+|[ \t-\r]+$', '', 'g')")} AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
f AS (SELECT k.*, coalesce(k.doc_id > r.first, false) AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id, i
"""

OP7_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS d, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
places AS (SELECT item_id, row_number() OVER () AS r, least(len(ws), 10) AS m, ws FROM b WHERE len(ws) > 0),
cuts AS (SELECT item_id, r, m, unnest(range(1, len(ws) - m + 2)) AS j, ws FROM places),
win AS (SELECT item_id, r, m, j, array_to_string(ws[j:j + m - 1], ' ') AS g FROM cuts),
m AS (SELECT DISTINCT m FROM win),
g AS (SELECT doc_id, d, m, unnest(range(1, len(ws) - m + 2)) AS i, ws FROM d, m WHERE len(ws) >= m),
hit AS (SELECT g.doc_id, g.d, g.i, g.m, win.item_id, win.r, win.j FROM (SELECT doc_id, d, i, m, array_to_string(ws[i:i + m - 1], ' ') AS t FROM g) g
        JOIN win ON win.m = g.m AND win.g = g.t),
pos AS (SELECT d, count(DISTINCT p) AS n_hit FROM (SELECT d, unnest(range(i, i + m)) AS p FROM hit) GROUP BY d),
it AS (SELECT d, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT d, CAST(item_id AS VARCHAR) AS s FROM hit WHERE item_id IS NOT NULL) GROUP BY d),
runs AS (SELECT *, i - row_number() OVER (PARTITION BY d, r, i - j ORDER BY i) AS run FROM hit),
spans AS (SELECT d, item_id, min(i) - 1 AS start, max(m) + count(*) - 1 AS n FROM runs GROUP BY d, r, item_id, i - j, run),
best AS (SELECT * FROM spans QUALIFY row_number() OVER (PARTITION BY d ORDER BY n DESC, start, item_id NULLS FIRST) = 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       CAST(coalesce(best.n, 0) AS BIGINT) AS longest_words, best.start AS longest_start, CAST(best.item_id AS BIGINT) AS longest_item
FROM d LEFT JOIN pos USING (d) LEFT JOIN it USING (d) LEFT JOIN best USING (d)
"""

OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, octet_length(encode(t)) AS n, sha1(t) AS d FROM p),
bits AS (SELECT *, list_reduce(list_transform(range(1, 41), lambda i: right(bin(strpos('0123456789abcdef', d[i]) + 15), 4)), lambda x, y: x || y) AS b FROM h),
code AS (SELECT *, list_reduce(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16 * CAST(b[5*i+1] AS INT) + 8 * CAST(b[5*i+2] AS INT) + 4 * CAST(b[5*i+3] AS INT) + 2 * CAST(b[5*i+4] AS INT) + CAST(b[5*i+5] AS INT)]), lambda x, y: x || y) AS digest FROM bits),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM code)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM f
"""

OP11_SQL = """
WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q, row_number() OVER () AS r
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, a.r AS ar, b.id, b.r, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])), 0) AS BIGINT) AS score
  FROM (SELECT * FROM e WHERE id % 50 = 0) a JOIN e b ON len(a.q) = len(b.q) AND a.r <> b.r),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, r) <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.ar, p.r ORDER BY s.score DESC, s.id, s.r) AS rank
  FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

OP12_SQL = """
WITH RECURSIVE r AS (SELECT *, row_number() OVER () AS i FROM embeddings),
v AS (SELECT i, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM r
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT i, vec_id, label, x, sqrt(list_sum(list_transform(x, lambda a: a * a))) AS norm FROM v),
p AS (SELECT a.i AS a, b.i AS b FROM u a JOIN u b ON a.label = b.label AND len(a.x) = len(b.x) AND a.i < b.i
      WHERE list_sum(list_transform(range(1, len(a.x) + 1), lambda k: a.x[k] * b.x[k])) / (a.norm * b.norm) >= 0.93),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
reach(i, other) AS (SELECT i, i FROM r UNION SELECT reach.i, l.b FROM reach JOIN l ON l.a = reach.other),
c AS (SELECT reach.i, min(r.vec_id) AS component_id FROM reach JOIN r ON r.i = reach.other GROUP BY reach.i),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM r JOIN c USING (i) LEFT JOIN n ON n.a = r.i
"""

QUERIES = {f.__name__: f for f in (op1_minhash_dedup, op2_html_text, op3_line_dedup, op4_wavelet_tokens, op5_piecewise_hash, op6_gumbel_segmentation, op7_decontamination, op8_license_scan, op9_warc, op10_toxicity, op11_hard_negatives, op12_vector_groups, op13_periodic_runs)}
ORACLES = {"op1_minhash_dedup": OP1_SQL, "op3_line_dedup": OP3_SQL, "op7_decontamination": OP7_SQL, "op9_warc": OP9_SQL, "op11_hard_negatives": OP11_SQL, "op12_vector_groups": OP12_SQL}
