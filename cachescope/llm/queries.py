"""The operators' queries over the given tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cachescope.llm import (bpe, classifier, covertree, htmltext, langid, linededup, mixing, quality, resampling, simhash,
                            toxicity, urlfilter, whitening)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(_read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, min_words=linededup.EVERY_LINE, counts=True)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(_read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_read(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score_quality(docs, _read(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_read(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), ids=False)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.score_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_language_id, op3_embedding_dedup, op4_line_dedup, op5_toxicity, op6_simhash_dedup,
    op7_url_filter, op8_html_text, op9_quality_rules, op10_byte_bpe, op11_importance_resampling,
    op12_quality_classifier, op13_embedding_whitening)}

ORACLES = {
    "op1_mix_sources": r"""
WITH sized AS (SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 8))::BIGINT
           / 4294967296.0::DOUBLE AS u FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
w AS (SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
         WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END)::DOUBLE AS weight FROM per),
r AS (SELECT *, 3.0::DOUBLE * source_size / weight AS ratio FROM w),
lv AS (SELECT *, ((SELECT sum(source_size) FROM per)
           - coalesce(sum(source_size * 3.0::DOUBLE) OVER (ORDER BY ratio, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY ratio, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM r),
t AS (SELECT source, source_size, CASE WHEN source_size > 0 THEN least(source_size * 3.0::DOUBLE,
           weight * (SELECT max(lvl) FROM lv WHERE lvl <= ratio)) ELSE 0 END AS target FROM lv),
q AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized JOIN q ON sized.source IS NOT DISTINCT FROM q.source
""",
    "op3_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT vec_id, label, e FROM v WHERE len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
  AND len([x FOR x IN e IF x <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e)
  AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a), c AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.m, e.vec_id)) AS component_id,
  least(e.vec_id, coalesce(c.m, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.a = e.vec_id
""",
    "op7_url_filter": r"""
WITH RECURSIVE p AS (SELECT page_id, html,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(verdict, h, pre) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (SELECT p.page_id, h || pre AS rule, verdict, row_number() OVER (PARTITION BY p.page_id
      ORDER BY length(h || pre) DESC, h || pre DESC) AS k
  FROM p JOIN rules ON (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, pre)),
j AS (SELECT p.*, fit.rule, fit.verdict FROM p LEFT JOIN fit ON fit.page_id = p.page_id AND fit.k = 1),
raw AS (SELECT host AS src, unnest(regexp_extract_all(html,
  '(?i)\bhref\s*=\s*["'']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"''\s>]+)', 1)) AS t FROM p),
lk AS (SELECT src, translate(regexp_extract(CASE WHEN t LIKE '//%' THEN 'x:' || t ELSE t END,
    '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM raw),
e0 AS (SELECT src, dst, count(*)::DOUBLE AS n FROM lk WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
e1 AS (SELECT 'trust' AS kind, src, dst, n FROM e0 UNION ALL SELECT 'distrust', dst, src, n FROM e0),
e AS (SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS share FROM e1),
s0 AS (SELECT kind, host, sum(seed) AS seed FROM (
  SELECT 'trust' AS kind, host, (count(*) FILTER (verdict = 'allow'))::DOUBLE AS seed FROM j WHERE host <> '' GROUP BY host
  UNION ALL SELECT 'distrust', host, (count(*) FILTER (verdict = 'block'))::DOUBLE FROM j WHERE host <> '' GROUP BY host
  UNION ALL SELECT kind, dst, 0 FROM e) GROUP BY kind, host),
s AS (SELECT kind, host, seed, coalesce(seed / nullif(sum(seed) OVER (PARTITION BY kind), 0), 0) AS jump,
  (kind, host) IN (SELECT (kind, src) FROM e) AS goes_on FROM s0),
it(k, kind, host, mass) AS (
  SELECT 0, kind, host, seed FROM s
  UNION ALL
  SELECT x.k, s.kind, s.host, 0.15 * s.seed + 0.85 * (sum(x.flow) + any_value(x.stuck) * s.jump) FROM (
    SELECT it.k + 1 AS k, n.kind AS kind, n.host AS host,
      CASE WHEN e.src IS NOT NULL THEN it.mass * e.share ELSE 0 END AS flow,
      sum(CASE WHEN NOT o.goes_on AND n.host = it.host THEN it.mass ELSE 0 END) OVER (PARTITION BY n.kind) AS stuck
    FROM it JOIN s o ON o.kind = it.kind AND o.host = it.host JOIN s n ON n.kind = it.kind
      LEFT JOIN e ON e.kind = it.kind AND e.src = it.host AND e.dst = n.host
    WHERE it.k < 60) x JOIN s ON s.kind = x.kind AND s.host = x.host GROUP BY x.k, s.kind, s.host, s.seed, s.jump),
score AS (SELECT host, sum(mass) FILTER (kind = 'trust') AS trust, sum(mass) FILTER (kind = 'distrust') AS distrust
  FROM it WHERE k = 60 GROUP BY host)
SELECT j.page_id, j.host, j.path, j.rule, coalesce(j.verdict,
  CASE WHEN coalesce(distrust, 0) > 2 * coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN score USING (host)
""",
    "op11_importance_resampling": r"""
WITH tab AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 1, 2, 3, 4, 5, 6, 7], lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
bf AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
code AS (SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(1, strlen(f) + 1),
      lambda i: ('0x' || substr(hex(f), 2 * i - 1, 2))::BIGINT)),
      lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT f FROM df UNION SELECT f FROM bf), tab),
s AS (SELECT bucket, count(*) AS n FROM df JOIN code USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bf JOIN code USING (f) GROUP BY bucket),
gain AS (SELECT range AS bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE)
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS g
  FROM range(10000) LEFT JOIN s ON s.bucket = range LEFT JOIN t ON t.bucket = range),
wt AS (SELECT r, count(*) AS n, sum(g)::BIGINT AS total FROM df JOIN code USING (f) JOIN gain USING (bucket) GROUP BY r),
sc AS (SELECT d.r, doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features,
    CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE)))::BIGINT AS noise FROM d LEFT JOIN wt ON wt.r = d.r),
o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id NULLS LAST, weight, n_features) AS k
  FROM sc)
SELECT doc_id, n_features, weight, weight + noise AS score,
  CASE WHEN n_words >= 20 AND k <= 25 * (SELECT count(*) FROM sc WHERE n_words >= 20) // 100 THEN k END::BIGINT AS rank FROM o
""",
}
