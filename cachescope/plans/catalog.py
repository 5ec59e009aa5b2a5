"""Registered queries: Spark plans over the given tables, with DuckDB oracles.

Every query reads whole tables (or data Spark derives from them).  Doubles are
rounded to 6 digits on both sides of the comparison; arrays are joined to text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cachescope.functions import grading as G
from cachescope.functions import text as X
from cachescope.operators import hits as H
from cachescope.operators import items as I
from cachescope.operators import metrics as M
from cachescope.operators import report as R
from cachescope.plans import sql as S
from cachescope.sources import tables as TB

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --------------------------------------------------------------------------
# shared Spark building blocks
# --------------------------------------------------------------------------

def hits_df(spark: SparkSession, sf: str, carry: tuple[str, ...] | None = ()) -> DataFrame:
    return H.detect_hits(TB.request_log(spark, sf), carry=carry)


def metrics_df(spark: SparkSession, sf: str) -> DataFrame:
    return M.run_metrics(hits_df(spark, sf))


SUMMARY_COLS = ["run_id", "cache_mode", "embedding_model", "similarity_threshold", "correctness",
                "cache_hit_rate", "bad_cache_hit_rate", "cache_accuracy", "total_queries", "cache_hits",
                "cache_misses", "bad_cache_hits", "good_cache_hits", "latency_mean_sec", "latency_p95_sec",
                "throughput_qps", "reliability_degradation", "cache_effectiveness",
                "correctness_without_bad_hits", "cache_impact_on_correctness"]


def summary_df(spark: SparkSession, sf: str) -> DataFrame:
    """One summary row per run of the log, with its configuration where there is one."""
    return metrics_df(spark, sf).join(TB.runs(spark), "run_id", "left").select(*SUMMARY_COLS)


# --------------------------------------------------------------------------
# shared DuckDB building blocks (brute force, independent of the Spark plans)
# --------------------------------------------------------------------------

HITS_CTES = f"""
f AS (SELECT run_id, seq, prompt, response, latency_sec, expected,
             row_number() OVER (PARTITION BY run_id ORDER BY seq) - 1 AS pos,
             {S.num('response')} AS num, {S.norm('response')} AS nrm
      FROM request_log),
cand AS (SELECT run_id, seq, unnest(expected) AS e FROM f),
cg AS (SELECT run_id, seq, {S.num('e')} AS en, {S.norm('e')} AS enrm FROM cand),
gr AS (SELECT f.run_id, f.seq,
         CASE WHEN f.response IS NULL THEN false
              WHEN f.num IS NOT NULL AND coalesce(bool_or(cg.en IS NOT NULL), false)
                THEN coalesce(bool_or(abs(f.num - cg.en) <= 1e-6), false)
              ELSE coalesce(bool_or(cg.enrm = f.nrm OR contains(f.nrm, cg.enrm) OR contains(cg.enrm, f.nrm)), false)
         END AS correct
       FROM f LEFT JOIN cg ON f.run_id = cg.run_id AND f.seq = cg.seq
       GROUP BY f.run_id, f.seq, f.response, f.num, f.nrm),
m AS (SELECT a.run_id, a.seq, min(b.pos) AS src_pos
      FROM f a JOIN f b ON a.run_id = b.run_id AND b.pos < a.pos
       AND a.latency_sec < greatest(0.25, b.latency_sec * 0.7)
       AND CASE WHEN a.num IS NOT NULL AND b.num IS NOT NULL THEN abs(a.num - b.num) <= 1e-6
                ELSE a.nrm = b.nrm END
      GROUP BY a.run_id, a.seq),
hits AS (SELECT f.run_id, f.seq, f.pos, f.prompt, f.response, f.latency_sec, f.expected, gr.correct,
           (m.src_pos IS NOT NULL OR coalesce(f.latency_sec < 0.1, false)) AS cache_hit,
           CASE WHEN m.src_pos IS NOT NULL THEN
                  (CASE WHEN b.prompt = f.prompt THEN 'exact_match_query_' ELSE 'semantic_match_query_' END)
                  || CAST(m.src_pos AS VARCHAR)
                WHEN f.latency_sec < 0.1 THEN 'timing_based' END AS hit_source
         FROM f JOIN gr ON f.run_id = gr.run_id AND f.seq = gr.seq
         LEFT JOIN m ON f.run_id = m.run_id AND f.seq = m.seq
         LEFT JOIN f b ON b.run_id = f.run_id AND b.pos = m.src_pos)"""

METRICS_CTES = HITS_CTES + """,
lat_rank AS (SELECT run_id, latency_sec,
               row_number() OVER (PARTITION BY run_id ORDER BY latency_sec) - 1 AS rk,
               count(*) OVER (PARTITION BY run_id) AS n
             FROM hits WHERE latency_sec IS NOT NULL),
pct AS (SELECT run_id,
          max(CASE WHEN rk = greatest(0, CAST(ceil(0.95 * n) AS BIGINT) - 1) THEN latency_sec END) AS p95,
          max(CASE WHEN rk = greatest(0, CAST(ceil(0.99 * n) AS BIGINT) - 1) THEN latency_sec END) AS p99
        FROM lat_rank GROUP BY run_id),
st AS (SELECT run_id, count(*) AS total_queries, count_if(cache_hit) AS cache_hits,
         count_if(cache_hit AND NOT correct) AS bad_cache_hits,
         avg(CAST(correct AS DOUBLE)) AS acc, avg(latency_sec) AS mean_lat, sum(latency_sec) AS lat_sum
       FROM hits GROUP BY run_id),
met AS (SELECT st.run_id,
          round(mean_lat, 6) AS latency_mean_sec, round(p95, 6) AS latency_p95_sec, round(p99, 6) AS latency_p99_sec,
          CASE WHEN total_queries > 0 THEN cache_hits / total_queries ELSE 0.0 END AS cache_hit_rate,
          CASE WHEN cache_hits > 0 THEN bad_cache_hits / cache_hits ELSE 0.0 END AS bad_cache_hit_rate,
          CASE WHEN cache_hits > 0 THEN (cache_hits - bad_cache_hits) / cache_hits ELSE 0.0 END AS cache_accuracy,
          total_queries, cache_hits, total_queries - cache_hits AS cache_misses, bad_cache_hits,
          cache_hits - bad_cache_hits AS good_cache_hits, cache_hits AS queries_with_hits,
          round(CASE WHEN lat_sum > 0 THEN total_queries / lat_sum ELSE 0.0 END, 6) AS throughput_qps,
          round(coalesce(acc, 0.0), 6) AS correctness
        FROM st JOIN pct ON st.run_id = pct.run_id),
rel AS (SELECT *, CASE WHEN total_queries > 0 THEN bad_cache_hits / total_queries ELSE 0.0 END AS reliability_degradation,
          cache_hit_rate * cache_accuracy AS cache_effectiveness,
          CASE WHEN total_queries > 0 THEN (correctness * total_queries + bad_cache_hits) / total_queries
               ELSE correctness END AS correctness_without_bad_hits
        FROM met),
summary AS (SELECT rel.run_id, r.cache_mode, r.embedding_model, r.similarity_threshold, correctness,
              cache_hit_rate, bad_cache_hit_rate, cache_accuracy, total_queries, cache_hits, cache_misses,
              bad_cache_hits, good_cache_hits, latency_mean_sec, latency_p95_sec, throughput_qps,
              reliability_degradation, cache_effectiveness, correctness_without_bad_hits,
              correctness_without_bad_hits - correctness AS cache_impact_on_correctness
            FROM rel LEFT JOIN runs r ON r.run_id = rel.run_id)"""


def hits_sql(body: str) -> str:
    return S.with_views(f"WITH {HITS_CTES}\n{body}", "request_log")


def summary_sql(body: str) -> str:
    return S.with_views(f"WITH {METRICS_CTES}\n{body}", "request_log", "runs")


# --------------------------------------------------------------------------
# Request log
# --------------------------------------------------------------------------

@register("detect_hits", hits_sql(
    "SELECT run_id, seq, pos, cache_hit, hit_source, correct, (cache_hit AND NOT correct) AS bad_hit FROM hits"))
def q_detect_hits(spark, sf):
    return hits_df(spark, sf).select("run_id", "seq", "pos", "cache_hit", "hit_source", "correct", "bad_hit")


@register("grade_answers", hits_sql("SELECT run_id, seq, correct FROM hits"))
def q_grade_answers(spark, sf):
    log = TB.request_log(spark, sf)
    return log.select("run_id", "seq", G.grade("expected", "response").alias("correct"))


@register("hit_stats", hits_sql("""
SELECT run_id, count(*) AS total_queries, count_if(cache_hit) AS cache_hits,
       count(*) - count_if(cache_hit) AS cache_misses, count_if(cache_hit AND NOT correct) AS bad_cache_hits,
       count_if(cache_hit AND correct) AS good_cache_hits,
       round(CASE WHEN count(*) > 0 THEN count_if(cache_hit) / count(*) ELSE 0.0 END, 6) AS hit_rate,
       round(CASE WHEN count_if(cache_hit) > 0 THEN count_if(cache_hit AND NOT correct) / count_if(cache_hit) ELSE 0.0 END, 6) AS bad_hit_rate,
       round(CASE WHEN count_if(cache_hit) > 0 THEN count_if(cache_hit AND correct) / count_if(cache_hit) ELSE 0.0 END, 6) AS cache_accuracy,
       count_if(cache_hit) AS queries_with_hits
FROM hits GROUP BY run_id"""))
def q_hit_stats(spark, sf):
    s = M.hit_stats(hits_df(spark, sf))
    return s.select(*[r6(c).alias(c) if c in ("hit_rate", "bad_hit_rate", "cache_accuracy") else c
                      for c in s.columns])


@register("hit_sources", hits_sql("""
SELECT run_id, regexp_extract(hit_source, '^(exact_match|semantic_match|timing_based)', 1) AS source_kind,
       count(*) AS hits
FROM hits WHERE cache_hit GROUP BY 1, 2"""))
def q_hit_sources(spark, sf):
    return H.hit_sources(hits_df(spark, sf))


@register("running_metrics", hits_sql("""
SELECT run_id, seq, pos,
  round(sum(CAST(correct AS BIGINT)) OVER w / count(*) OVER w, 6) AS running_correct_rate,
  round(sum(CAST(cache_hit AS BIGINT)) OVER w / count(*) OVER w, 6) AS running_hit_rate,
  round(latency_sec, 6) AS current_latency_sec
FROM hits WINDOW w AS (PARTITION BY run_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def q_running_metrics(spark, sf):
    r = M.running_metrics(hits_df(spark, sf))
    return r.select("run_id", "seq", "pos", r6("running_correct_rate").alias("running_correct_rate"),
                    r6("running_hit_rate").alias("running_hit_rate"),
                    r6("current_latency_sec").alias("current_latency_sec"))


@register("item_log", hits_sql("""
SELECT run_id, seq, pos AS row_index, prompt AS question, array_to_string(expected, '|') AS expected,
       response AS model_output, round(latency_sec, 6) AS latency_sec, cache_hit, correct
FROM hits"""))
def q_item_log(spark, sf):
    r = I.item_log(hits_df(spark, sf, ("prompt", "response", "expected")))
    return r.select("run_id", "seq", "row_index", "question", F.array_join("expected", "|").alias("expected"),
                    "model_output", "latency_sec", "cache_hit", "correct")


# --------------------------------------------------------------------------
# Per-run metrics and reports
# --------------------------------------------------------------------------

@register("latency_stats", summary_sql(
    "SELECT run_id, latency_mean_sec, latency_p95_sec, latency_p99_sec FROM met"))
def q_latency_stats(spark, sf):
    s = M.latency_stats(TB.request_log(spark, sf))
    return s.select("run_id", *[r6(c).alias(c) for c in
                                ("latency_mean_sec", "latency_p95_sec", "latency_p99_sec")])


METRIC_COLS = ["run_id", "latency_mean_sec", "latency_p95_sec", "latency_p99_sec", "cache_hit_rate",
               "bad_cache_hit_rate", "cache_accuracy", "total_queries", "cache_hits", "cache_misses",
               "bad_cache_hits", "good_cache_hits", "queries_with_hits", "throughput_qps", "correctness"]
DOUBLE_METRICS = {"latency_mean_sec", "latency_p95_sec", "latency_p99_sec", "cache_hit_rate",
                  "bad_cache_hit_rate", "cache_accuracy", "throughput_qps", "correctness",
                  "reliability_degradation", "cache_effectiveness", "correctness_without_bad_hits",
                  "cache_impact_on_correctness", "similarity_threshold"}


def _round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in DOUBLE_METRICS else F.col(c) for c in df.columns])


def _sql_round(cols):
    return ", ".join(f"round({c}, 6) AS {c}" if c in DOUBLE_METRICS else c for c in cols)


@register("run_metrics", summary_sql(f"SELECT {_sql_round(METRIC_COLS)} FROM met"))
def q_run_metrics(spark, sf):
    return _round_doubles(metrics_df(spark, sf).select(*METRIC_COLS))


REL_COLS = ["run_id", "reliability_degradation", "cache_effectiveness", "correctness_without_bad_hits",
            "cache_impact_on_correctness"]


@register("reliability", summary_sql(f"""
SELECT {_sql_round(REL_COLS)} FROM (SELECT *, correctness_without_bad_hits - correctness AS cache_impact_on_correctness FROM rel)"""))
def q_reliability(spark, sf):
    return _round_doubles(metrics_df(spark, sf).select(*REL_COLS))


@register("run_summary", summary_sql(f"SELECT {_sql_round(SUMMARY_COLS)} FROM summary"))
def q_run_summary(spark, sf):
    return _round_doubles(summary_df(spark, sf))


@register("empty_runs", summary_sql(f"""
SELECT r.run_id, r.cache_mode, coalesce(rel.total_queries, 0) AS total_queries,
       coalesce(rel.cache_hits, 0) AS cache_hits, round(coalesce(rel.correctness, 0), 6) AS correctness,
       round(coalesce(rel.latency_mean_sec, 0), 6) AS latency_mean_sec, rel.run_id IS NULL AS is_empty
FROM runs r LEFT JOIN rel ON r.run_id = rel.run_id"""))
def q_empty_runs(spark, sf):
    e = M.empty_runs(TB.runs(spark), metrics_df(spark, sf))
    return e.select("run_id", "cache_mode", "total_queries", "cache_hits", r6("correctness").alias("correctness"),
                    r6("latency_mean_sec").alias("latency_mean_sec"), "is_empty")


@register("vs_baseline", summary_sql("""
SELECT run_id, embedding_model, round(similarity_threshold, 6) AS similarity_threshold,
       round(correctness, 6) AS correctness, round(latency_mean_sec, 6) AS latency_mean_sec,
       round(bc, 6) AS baseline_correctness, round(bl, 6) AS baseline_latency_mean_sec,
       round(correctness - bc, 6) AS correctness_change, round(latency_mean_sec / bl - 1.0, 6) AS latency_change
FROM summary, (SELECT avg(correctness) AS bc, avg(latency_mean_sec) AS bl FROM summary WHERE cache_mode = 'none') b
WHERE cache_mode <> 'none'"""))
def q_vs_baseline(spark, sf):
    v = R.vs_baseline(summary_df(spark, sf))
    return v.select(*[r6(c).alias(c) if c not in ("run_id", "embedding_model") else c for c in v.columns])


@register("subset_report", hits_sql("""
SELECT coalesce(run_id, 'OVERALL') AS subset, count_if(correct) AS correct, count(*) AS total,
       round(100.0 * count_if(correct) / count(*), 6) AS accuracy_pct, round(avg(latency_sec), 6) AS avg_latency_sec
FROM hits GROUP BY ROLLUP (run_id)"""))
def q_subset_report(spark, sf):
    g = hits_df(spark, sf).withColumnRenamed("run_id", "subset")
    r = R.subset_report(g, "subset")
    return r.select("subset", "correct", "total", r6("accuracy_pct").alias("accuracy_pct"),
                    r6("avg_latency_sec").alias("avg_latency_sec"))


@register("by_model_threshold", summary_sql("""
SELECT embedding_model, round(similarity_threshold, 6) AS similarity_threshold,
       round(avg(correctness), 6) AS correctness, round(avg(latency_mean_sec), 6) AS latency_mean_sec,
       round(avg(cache_accuracy), 6) AS cache_accuracy, round(avg(good_cache_hits), 6) AS good_cache_hits,
       round(avg(cache_hits), 6) AS cache_hits, round(avg(bad_cache_hit_rate), 6) AS bad_cache_hit_rate,
       round(avg(bad_cache_hits), 6) AS bad_cache_hits
FROM summary WHERE cache_mode <> 'none' AND embedding_model IS NOT NULL AND similarity_threshold IS NOT NULL
GROUP BY embedding_model, similarity_threshold"""))
def q_by_model_threshold(spark, sf):
    g = R.by_model_threshold(summary_df(spark, sf))
    return g.select("embedding_model", *[r6(c).alias(c) for c in g.columns if c != "embedding_model"])


def _pivot_sql() -> str:
    cols = []
    for t, tag in ((0.9, "0_9"), (0.95, "0_95")):
        cond = f"similarity_threshold = {t}"
        cols += [f"round(max(CASE WHEN {cond} THEN correctness END), 6) AS correctness_{tag}",
                 f"round(max(CASE WHEN {cond} THEN cache_accuracy END), 6) AS cache_accuracy_{tag}",
                 f"round(max(CASE WHEN {cond} THEN bad_cache_hit_rate END), 6) AS bad_cache_hit_rate_{tag}",
                 f"max(CASE WHEN {cond} THEN CAST(trunc(good_cache_hits) AS BIGINT) END) AS good_hits_{tag}",
                 f"max(CASE WHEN {cond} THEN CAST(trunc(bad_cache_hits) AS BIGINT) END) AS bad_hits_{tag}",
                 f"max(CASE WHEN {cond} THEN CAST(trunc(cache_hits) AS BIGINT) END) AS total_hits_{tag}"]
    return summary_sql(f"""
, g AS (SELECT embedding_model, similarity_threshold, avg(correctness) AS correctness,
          avg(cache_accuracy) AS cache_accuracy, avg(bad_cache_hit_rate) AS bad_cache_hit_rate,
          avg(good_cache_hits) AS good_cache_hits, avg(bad_cache_hits) AS bad_cache_hits, avg(cache_hits) AS cache_hits
        FROM summary WHERE cache_mode <> 'none' AND embedding_model IS NOT NULL AND similarity_threshold IS NOT NULL
        GROUP BY 1, 2)
SELECT embedding_model, {', '.join(cols)} FROM g GROUP BY embedding_model""")


@register("pivot_model_threshold", _pivot_sql())
def q_pivot_model_threshold(spark, sf):
    p = R.pivot_model_threshold(summary_df(spark, sf))
    return p.select(*[r6(c).alias(c) if c.startswith(("correctness", "cache_accuracy", "bad_cache_hit_rate"))
                      else F.col(c) for c in p.columns])


@register("by_model", summary_sql("""
SELECT embedding_model, round(avg(correctness), 6) AS correctness, round(avg(latency_mean_sec), 6) AS latency_mean_sec,
       round(avg(cache_hit_rate), 6) AS cache_hit_rate, round(avg(cache_accuracy), 6) AS cache_accuracy
FROM summary WHERE cache_mode <> 'none' AND embedding_model IS NOT NULL GROUP BY embedding_model"""))
def q_by_model(spark, sf):
    g = R.by_model(summary_df(spark, sf))
    return g.select("embedding_model", *[r6(c).alias(c) for c in g.columns if c != "embedding_model"])


@register("run_inventory", summary_sql("""
SELECT array_to_string(list_sort(list_distinct(list(cache_mode))), ',') AS cache_modes,
       array_to_string(list_sort(list_distinct(list(embedding_model))), ',') AS embedding_models
FROM summary"""))
def q_run_inventory(spark, sf):
    return R.run_inventory(summary_df(spark, sf))


# --------------------------------------------------------------------------
# Labelled items
# --------------------------------------------------------------------------

NOT_REJECTED = "cleaning_status IS DISTINCT FROM 'rejected'"
QUESTION_SQL = "coalesce(nullif(platinum_prompt, ''), nullif(question, ''), nullif(statement, ''))"


def _expected_sql() -> str:
    ia, il = S.int_or_null("answer"), S.int_or_null("label")
    return f"""CASE
  WHEN len(coalesce(platinum_target, [])) > 0
    THEN array_to_string(list_transform(platinum_target, lambda x: coalesce(x, 'None')), '|')
  WHEN subset IN ('singleq', 'singleop', 'multiarith') AND output_answer <> '' THEN output_answer
  WHEN subset = 'gsm8k' AND answer <> '' THEN answer
  WHEN subset = 'mmlu_math' AND {ia} >= 0 AND {ia} < len(choices) THEN choices[{ia} + 1]
  WHEN subset IN ('squad', 'hotpotqa') AND answer <> '' THEN answer
  WHEN subset = 'winograd_wsc' AND {il} >= 0 AND {il} < len(options) THEN options[{il} + 1]
  WHEN label <> '' THEN label
  WHEN output_answer <> '' THEN output_answer
  WHEN answer <> '' THEN answer
  ELSE '' END"""


EXPECTED_SQL = _expected_sql()


def items_df(spark, sf):
    return TB.eval_items(spark, sf)


@register("drop_rejected", S.with_views(
    f"SELECT subset, item_idx, cleaning_status FROM eval_items WHERE {NOT_REJECTED}", "eval_items"))
def q_drop_rejected(spark, sf):
    return I.drop_rejected(items_df(spark, sf)).select("subset", "item_idx", "cleaning_status")


SLICE_START = 5


@register("slice_items", S.with_views(f"""
SELECT subset, item_idx, item_pos FROM (
  SELECT subset, item_idx, row_number() OVER (PARTITION BY subset ORDER BY item_idx) - 1 AS item_pos
  FROM eval_items WHERE {NOT_REJECTED}) WHERE item_pos >= {SLICE_START}""", "eval_items"))
def q_slice_items(spark, sf):
    return I.slice_items(items_df(spark, sf), SLICE_START, None).select("subset", "item_idx", "item_pos")


@register("pick_question", S.with_views(
    f"SELECT subset, item_idx, {QUESTION_SQL} AS question FROM eval_items", "eval_items"))
def q_pick_question(spark, sf):
    it = items_df(spark, sf)
    return it.select("subset", "item_idx", I.pick_question(it).alias("question"))


@register("expected_answers", S.with_views(
    f"SELECT subset, item_idx, {EXPECTED_SQL} AS expected FROM eval_items", "eval_items"))
def q_expected_answers(spark, sf):
    return items_df(spark, sf).select("subset", "item_idx",
                                      F.array_join(I.expected_answers(), "|").alias("expected"))


SAMPLE_N, SAMPLE_SEED = 25, 7


@register("sample_items", S.with_views(f"""
SELECT subset, item_idx FROM (
  SELECT subset, item_idx, row_number() OVER (
    PARTITION BY subset ORDER BY sha256(concat('{SAMPLE_SEED}:', CAST(item_idx AS VARCHAR))), item_idx) AS rn
  FROM eval_items WHERE {NOT_REJECTED}) WHERE rn <= {SAMPLE_N}""", "eval_items"))
def q_sample_items(spark, sf):
    return I.sample_items(items_df(spark, sf), SAMPLE_N, SAMPLE_SEED).select("subset", "item_idx")


ITEM_INDEX = 3


@register("item_at", S.with_views(f"""
SELECT subset, item_idx, item_pos FROM (
  SELECT subset, item_idx, row_number() OVER (PARTITION BY subset ORDER BY item_idx) - 1 AS item_pos,
         count(*) OVER (PARTITION BY subset) AS n
  FROM eval_items WHERE {NOT_REJECTED})
WHERE item_pos = CASE WHEN {ITEM_INDEX} < n THEN {ITEM_INDEX} ELSE 0 END""", "eval_items"))
def q_item_at(spark, sf):
    return I.item_at(items_df(spark, sf), ITEM_INDEX).select("subset", "item_idx", "item_pos")


@register("paraphrase", S.with_views(
    f"SELECT subset, item_idx, {S.paraphrase(QUESTION_SQL)} AS paraphrase FROM eval_items", "eval_items"))
def q_paraphrase(spark, sf):
    it = items_df(spark, sf)
    return it.select("subset", "item_idx", X.paraphrase(I.pick_question(it)).alias("paraphrase"))


@register("plan_requests", S.with_views(f"""
WITH sel AS (SELECT subset, item_idx, {QUESTION_SQL} AS question, {EXPECTED_SQL} AS expected,
               row_number() OVER (PARTITION BY subset ORDER BY item_idx) - 1 AS item_pos
             FROM eval_items WHERE {NOT_REJECTED}),
plan AS (SELECT run_id, unnest(subsets) AS subset, unnest(range(len(subsets))) AS subset_ord FROM run_plan),
sizes AS (SELECT subset, count(*) AS n FROM sel GROUP BY subset),
off AS (SELECT p.run_id, p.subset,
          coalesce(sum(coalesce(s.n, 0)) OVER (PARTITION BY p.run_id ORDER BY p.subset_ord
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
        FROM plan p LEFT JOIN sizes s ON p.subset = s.subset)
SELECT off.run_id, off.off + sel.item_pos AS seq, sel.subset, sel.item_pos AS row_index, sel.item_idx,
       sel.question, sel.expected
FROM off JOIN sel ON off.subset = sel.subset""", "eval_items", "run_plan"))
def q_plan_requests(spark, sf):
    p = I.plan_requests(TB.run_plan(spark), items_df(spark, sf))
    return p.select("run_id", "seq", "subset", "row_index", "item_idx", "question",
                    F.array_join("expected", "|").alias("expected"))


# --------------------------------------------------------------------------
# C1, C2, C5-C8, C10, C12 on whole texts; D7 pairing
# --------------------------------------------------------------------------

@register("normalize_text", f"SELECT doc_id, {S.norm('text')} AS norm_text FROM documents")
def q_normalize_text(spark, sf):
    d = TB.table(spark, sf, "documents")
    return d.select("doc_id", X.normalize_text("text").alias("norm_text"))


@register("final_number", f"SELECT doc_id, {S.num('text')} AS final_number FROM documents")
def q_final_number(spark, sf):
    d = TB.table(spark, sf, "documents")
    return d.select("doc_id", X.final_number("text").alias("final_number"))


@register("prompt_key", "SELECT doc_id, sha256(text) AS prompt_key FROM documents")
def q_prompt_key(spark, sf):
    return TB.table(spark, sf, "documents").select("doc_id", X.prompt_key("text").alias("prompt_key"))


@register("safe_name", f"SELECT page_id, {S.safe_name('url')} AS safe_name FROM pages")
def q_safe_name(spark, sf):
    return TB.table(spark, sf, "pages").select("page_id", X.safe_name("url").alias("safe_name"))


VERDICT_CTES = f"""
WITH cand AS (SELECT run_id, seq, response, {S.num('response')} AS mn, {S.norm('response')} AS mnrm,
                len(expected) AS n_exp, unnest(expected) AS e FROM request_log),
c AS (SELECT *, {S.num('e')} AS en, {S.norm('e')} AS enrm FROM cand),
v AS (SELECT run_id, seq,
        coalesce(bool_or(mn IS NOT NULL AND en IS NOT NULL AND (en = mn OR
          abs(en - mn) <= greatest(1e-6 * greatest(abs(en), abs(mn)), 1e-6))), false) AS verdict_numeric,
        coalesce(bool_or(enrm = mnrm OR contains(mnrm, enrm) OR contains(enrm, mnrm)), false) AS verdict_text,
        count_if(en IS NOT NULL) >= greatest(1, max(n_exp) // 2) AS mostly_numeric
      FROM c GROUP BY run_id, seq)"""


@register("verdict_numeric", S.with_views(VERDICT_CTES + "\nSELECT run_id, seq, verdict_numeric FROM v",
                                          "request_log"))
def q_verdict_numeric(spark, sf):
    return TB.request_log(spark, sf).select(
        "run_id", "seq", G.verdict_numeric("expected", "response").alias("verdict_numeric"))


@register("verdict_text", S.with_views(VERDICT_CTES + "\nSELECT run_id, seq, verdict_text FROM v", "request_log"))
def q_verdict_text(spark, sf):
    return TB.request_log(spark, sf).select(
        "run_id", "seq", G.verdict_text("expected", "response").alias("verdict_text"))


@register("mostly_numeric", S.with_views(VERDICT_CTES + "\nSELECT run_id, seq, mostly_numeric FROM v",
                                         "request_log"))
def q_mostly_numeric(spark, sf):
    return TB.request_log(spark, sf).select(
        "run_id", "seq", G.mostly_numeric("expected").alias("mostly_numeric"))


@register("task_verdict", S.with_views(VERDICT_CTES + """
SELECT run_id, seq, CASE WHEN mostly_numeric THEN verdict_numeric ELSE verdict_text END AS task_verdict FROM v""",
                                       "request_log"))
def q_task_verdict(spark, sf):
    return TB.request_log(spark, sf).select(
        "run_id", "seq", G.task_verdict("expected", "response").alias("task_verdict"))


@register("paired_hits", S.with_views("""
WITH f AS (SELECT run_id, response, latency_sec,
             row_number() OVER (PARTITION BY run_id ORDER BY seq) - 1 AS pos FROM request_log),
s AS (SELECT run_id, pos // 2 AS pair_id, response AS seed_output, latency_sec AS seed_latency_sec
      FROM f WHERE pos % 2 = 0),
p AS (SELECT run_id, pos // 2 AS pair_id, response AS paraphrase_output, latency_sec AS paraphrase_latency_sec
      FROM f WHERE pos % 2 = 1)
SELECT run_id, pair_id, seed_output, paraphrase_output, round(seed_latency_sec, 6) AS seed_latency_sec,
       round(paraphrase_latency_sec, 6) AS paraphrase_latency_sec,
       coalesce(paraphrase_output = seed_output
                AND paraphrase_latency_sec < greatest(0.25, seed_latency_sec * 0.7), false) AS semantic_hit_likely
FROM s JOIN p USING (run_id, pair_id)""", "request_log"))
def q_paired_hits(spark, sf):
    from cachescope.operators.scan import positions
    f = positions(TB.request_log(spark, sf), ["run_id"], "seq", "pos") \
        .withColumn("pair_id", F.floor(F.col("pos") / 2).cast("long"))
    seed = f.where(F.col("pos") % 2 == 0)
    para = f.where(F.col("pos") % 2 == 1)
    j = H.paired_hits(seed, para, keys=("run_id", "pair_id"))
    return j.select("run_id", "pair_id", "seed_output", "paraphrase_output",
                    r6("seed_latency_sec").alias("seed_latency_sec"),
                    r6("paraphrase_latency_sec").alias("paraphrase_latency_sec"), "semantic_hit_likely")


# --------------------------------------------------------------------------
# Answer reuse over documents as prompts
# --------------------------------------------------------------------------

from cachescope.operators import reuse as U  # noqa: E402

REUSE_THRESHOLD = 0.9
SWEEP_THRESHOLDS = (0.85, 0.9, 0.95)


def docs_df(spark, sf):
    d = TB.table(spark, sf, "documents")
    return d.select(F.lit("all").alias("run_id"), F.col("doc_id").alias("seq"),
                    F.col("text").alias("prompt"), "lang")


VEC_CTES = f"""
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+|[0-9]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
nd AS (SELECT count(*) AS n FROM documents),
w0 AS (SELECT doc_id, term, tf * ln((n + 1.0) / (df + 1.0)) AS w FROM tf JOIN dfreq USING (term), nd),
w AS (SELECT * FROM w0 WHERE w > 0),
nrm AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY doc_id),
v AS (SELECT doc_id, term, w / nrm AS x FROM w JOIN nrm USING (doc_id) WHERE nrm > 0)"""


def _pairs_cte(t: float) -> str:
    return f"""pairs AS (SELECT a.doc_id AS i, b.doc_id AS j, sum(a.x * b.x) AS sim
  FROM v a JOIN v b ON a.term = b.term AND b.doc_id < a.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING sum(a.x * b.x) >= {t})"""


def _first_come_sql(t: float) -> str:
    """Sequential store-the-misses loop as a recursive CTE (independent oracle)."""
    return f"""WITH RECURSIVE {VEC_CTES},
{_pairs_cte(t)},
nb AS (SELECT i, list(j) AS nbrs FROM pairs GROUP BY i),
ord AS (SELECT d.doc_id, row_number() OVER (ORDER BY d.doc_id) AS k, coalesce(nb.nbrs, []) AS nbrs
        FROM documents d LEFT JOIN nb ON nb.i = d.doc_id),
r AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS stored
      UNION ALL
      SELECT r.k + 1, CASE WHEN list_has_any(r.stored, o.nbrs) THEN r.stored
                           ELSE list_append(r.stored, o.doc_id) END
      FROM r JOIN ord o ON o.k = r.k + 1),
fin AS (SELECT stored FROM r ORDER BY k DESC LIMIT 1),
miss AS (SELECT unnest(stored) AS doc_id FROM fin),
best AS (SELECT i, j, sim, row_number() OVER (PARTITION BY i ORDER BY round(sim, 9) DESC, j) AS rn
         FROM pairs WHERE j IN (SELECT doc_id FROM miss))
SELECT 'all' AS run_id, d.doc_id AS seq, b.j IS NOT NULL AS reuse_hit, b.j AS served_seq,
       round(b.sim, 6) AS similarity
FROM documents d LEFT JOIN (SELECT * FROM best WHERE rn = 1) b ON b.i = d.doc_id"""


@register("semantic_reuse", _first_come_sql(REUSE_THRESHOLD))
def q_semantic_reuse(spark, sf):
    r = U.semantic_reuse(docs_df(spark, sf), REUSE_THRESHOLD, store="misses")
    return r.select(F.col("scope").alias("run_id"), F.col("id").alias("seq"), "reuse_hit",
                    F.col("served_id").alias("served_seq"), r6("similarity").alias("similarity"))


@register("nearest_earlier", f"""WITH {VEC_CTES},
{_pairs_cte(REUSE_THRESHOLD)},
best AS (SELECT i, j, sim, row_number() OVER (PARTITION BY i ORDER BY round(sim, 9) DESC, j) AS rn FROM pairs)
SELECT 'all' AS run_id, d.doc_id AS seq, b.j IS NOT NULL AS reuse_hit, b.j AS served_seq,
       round(b.sim, 6) AS similarity
FROM documents d LEFT JOIN (SELECT * FROM best WHERE rn = 1) b ON b.i = d.doc_id""")
def q_nearest_earlier(spark, sf):
    r = U.semantic_reuse(docs_df(spark, sf), REUSE_THRESHOLD, store="all")
    return r.select(F.col("scope").alias("run_id"), F.col("id").alias("seq"), "reuse_hit",
                    F.col("served_id").alias("served_seq"), r6("similarity").alias("similarity"))


@register("exact_reuse", """
SELECT 'all' AS run_id, doc_id AS seq, first_id < doc_id AS reuse_hit,
       CASE WHEN first_id < doc_id THEN first_id END AS served_seq
FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first_id FROM documents)""")
def q_exact_reuse(spark, sf):
    return U.exact_reuse(docs_df(spark, sf))


def gappy_requests(spark, sf):
    """The request log with prompts and runs missing in some rows, by rule."""
    return TB.request_log(spark, sf).select(
        F.when(F.col("seq") % 11 != 0, F.col("run_id")).alias("run_id"), "seq",
        F.when(F.col("seq") % 7 != 0, F.col("prompt")).alias("prompt"))


@register("exact_reuse_gaps", S.with_views("""
WITH g AS (SELECT CASE WHEN seq % 11 <> 0 THEN run_id END AS run_id, seq,
             CASE WHEN seq % 7 <> 0 THEN prompt END AS prompt FROM request_log)
SELECT a.run_id, a.seq, count(b.seq) > 0 AS reuse_hit, min(b.seq) AS served_seq
FROM g a LEFT JOIN g b ON a.run_id IS NOT DISTINCT FROM b.run_id AND a.prompt = b.prompt AND b.seq < a.seq
GROUP BY a.run_id, a.seq""", "request_log"))
def q_exact_reuse_gaps(spark, sf):
    """D2 where prompts and runs are missing: as many rows out as in."""
    return U.exact_reuse(gappy_requests(spark, sf))


@register("no_reuse", S.with_views(
    "SELECT run_id, seq, false AS reuse_hit, CAST(NULL AS BIGINT) AS served_seq FROM request_log",
    "request_log"))
def q_no_reuse(spark, sf):
    return U.no_reuse(TB.request_log(spark, sf))


def _sweep_sql() -> str:
    t0 = min(SWEEP_THRESHOLDS)
    ts = ", ".join(str(t) for t in SWEEP_THRESHOLDS)
    return f"""WITH RECURSIVE {VEC_CTES},
{_pairs_cte(t0)},
th AS (SELECT CAST(unnest([{ts}]) AS DOUBLE) AS t),
pt AS (SELECT t, i, j, sim FROM pairs, th WHERE sim >= t),
nb AS (SELECT t, i, list(j) AS nbrs FROM pt GROUP BY t, i),
ord AS (SELECT th.t, d.doc_id, row_number() OVER (PARTITION BY th.t ORDER BY d.doc_id) AS k,
               coalesce(nb.nbrs, []) AS nbrs
        FROM documents d CROSS JOIN th LEFT JOIN nb ON nb.i = d.doc_id AND nb.t = th.t),
r AS (SELECT t, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS stored FROM th
      UNION ALL
      SELECT r.t, r.k + 1, CASE WHEN list_has_any(r.stored, o.nbrs) THEN r.stored
                                ELSE list_append(r.stored, o.doc_id) END
      FROM r JOIN ord o ON o.t = r.t AND o.k = r.k + 1),
fin AS (SELECT t, arg_max(stored, k) AS stored FROM r GROUP BY t),
miss AS (SELECT t, unnest(stored) AS doc_id FROM fin),
best AS (SELECT pt.t, i, j, row_number() OVER (PARTITION BY pt.t, i ORDER BY round(sim, 9) DESC, j) AS rn
         FROM pt JOIN miss ON miss.t = pt.t AND miss.doc_id = pt.j),
served AS (SELECT t, i, j FROM best WHERE rn = 1)
SELECT CAST(th.t AS DOUBLE) AS threshold, count(*) AS total_queries, count(s.j) AS cache_hits,
       count_if(s.j IS NOT NULL AND (dj.lang IS DISTINCT FROM di.lang)) AS bad_cache_hits
FROM th CROSS JOIN documents di
LEFT JOIN served s ON s.t = th.t AND s.i = di.doc_id
LEFT JOIN documents dj ON dj.doc_id = s.j
GROUP BY th.t"""


@register("reuse_sweep", _sweep_sql())
def q_reuse_sweep(spark, sf):
    d = docs_df(spark, sf)
    ans = d.select("seq", F.col("lang").alias("answer"))
    return U.reuse_sweep(d, ans, SWEEP_THRESHOLDS)


SCOPED_CTES = """
sd AS (SELECT coalesce(source, 'none') AS run_id, text, lang,
         row_number() OVER (PARTITION BY coalesce(source, 'none') ORDER BY doc_id) - 1 AS seq FROM documents),
tok AS (SELECT run_id, seq, unnest(regexp_extract_all(lower(text), '\\p{L}+|[0-9]+')) AS term FROM sd),
tf AS (SELECT run_id, seq, term, count(*) AS tf FROM tok GROUP BY ALL),
dfreq AS (SELECT run_id, term, count(*) AS df FROM tf GROUP BY ALL),
nd AS (SELECT run_id, count(*) AS n FROM sd GROUP BY run_id),
w0 AS (SELECT run_id, seq, term, tf * ln((n + 1.0) / (df + 1.0)) AS w
       FROM tf JOIN dfreq USING (run_id, term) JOIN nd USING (run_id)),
nrm AS (SELECT run_id, seq, sqrt(sum(w * w)) AS nrm FROM w0 WHERE w > 0 GROUP BY ALL),
v AS (SELECT run_id, seq, term, w / nrm AS x FROM w0 JOIN nrm USING (run_id, seq) WHERE w > 0 AND nrm > 0),
pairs AS (SELECT a.run_id, a.seq AS i, b.seq AS j, sum(a.x * b.x) AS sim
  FROM v a JOIN v b ON a.run_id = b.run_id AND a.term = b.term AND b.seq < a.seq
  GROUP BY ALL HAVING sum(a.x * b.x) >= 0.85),
th AS (SELECT unnest([0.85, 0.9, 0.95])::DOUBLE AS t),
nb AS (SELECT t, run_id, i, list(j) AS nbrs FROM pairs JOIN th ON sim >= t GROUP BY ALL),
chain AS (SELECT th.t, sd.run_id, sd.seq, coalesce(nb.nbrs, []) AS nbrs
        FROM sd CROSS JOIN th LEFT JOIN nb ON nb.t = th.t AND nb.run_id = sd.run_id AND nb.i = sd.seq),
r AS (SELECT t, run_id, -1::BIGINT AS k, []::BIGINT[] AS stored FROM th CROSS JOIN nd
      UNION ALL
      SELECT r.t, r.run_id, r.k + 1, CASE WHEN list_has_any(r.stored, c.nbrs) THEN r.stored
                                          ELSE list_append(r.stored, c.seq) END
      FROM r JOIN chain c ON c.t = r.t AND c.run_id = r.run_id AND c.seq = r.k + 1),
miss AS (SELECT t, run_id, unnest(arg_max(stored, k)) AS j FROM r GROUP BY t, run_id),
best AS (SELECT t, run_id, i, j, sim,
           row_number() OVER (PARTITION BY t, run_id, i ORDER BY round(sim, 9) DESC, j) AS rn
         FROM pairs JOIN miss USING (run_id, j) WHERE sim >= t),
served AS (SELECT c.t, c.run_id, c.seq, b.j, b.sim FROM chain c
           LEFT JOIN best b ON b.t = c.t AND b.run_id = c.run_id AND b.i = c.seq AND rn = 1)"""


def source_docs_df(spark, sf):
    """Documents as the requests of one run a source; every run counts from 0."""
    from cachescope.operators.scan import positions
    d = TB.table(spark, sf, "documents").select(
        F.coalesce("source", F.lit("none")).alias("run_id"), "doc_id", F.col("text").alias("prompt"), "lang")
    return positions(d, ["run_id"], "doc_id", "seq").drop("doc_id")


@register("semantic_reuse_by_source", f"""WITH RECURSIVE {SCOPED_CTES}
SELECT run_id, seq, j IS NOT NULL AS reuse_hit, j AS served_seq, round(sim, 6) AS similarity
FROM served WHERE t = 0.9""")
def q_semantic_reuse_by_source(spark, sf):
    r = U.semantic_reuse(source_docs_df(spark, sf), 0.9, store="misses")
    return r.select(F.col("scope").alias("run_id"), F.col("id").alias("seq"), "reuse_hit",
                    F.col("served_id").alias("served_seq"), r6("similarity").alias("similarity"))


@register("reuse_sweep_by_source", f"""WITH RECURSIVE {SCOPED_CTES},
g AS (SELECT s.t AS threshold, count(*) AS total_queries, count(s.j) AS cache_hits,
        count_if(s.j IS NOT NULL AND b.lang IS DISTINCT FROM a.lang) AS bad_cache_hits
      FROM served s JOIN sd a ON a.run_id = s.run_id AND a.seq = s.seq
        LEFT JOIN sd b ON b.run_id = s.run_id AND b.seq = s.j GROUP BY s.t)
SELECT *, total_queries - cache_hits AS cache_misses, cache_hits - bad_cache_hits AS good_cache_hits,
  round(cache_hits / total_queries, 6) AS hit_rate,
  round(CASE WHEN cache_hits > 0 THEN bad_cache_hits / cache_hits ELSE 0.0 END, 6) AS bad_hit_rate,
  round(CASE WHEN cache_hits > 0 THEN (cache_hits - bad_cache_hits) / cache_hits ELSE 0.0 END, 6) AS cache_accuracy
FROM g""")
def q_reuse_sweep_by_source(spark, sf):
    d = source_docs_df(spark, sf)
    r = U.reuse_rates(U.reuse_sweep(d, d.select("run_id", "seq", F.col("lang").alias("answer")), SWEEP_THRESHOLDS))
    return r.select(*[c for c in r.columns if "rate" not in c and c != "cache_accuracy"],
                    *[r6(c).alias(c) for c in ("hit_rate", "bad_hit_rate", "cache_accuracy")])


# --------------------------------------------------------------------------
# Run documents and the flat summary
# --------------------------------------------------------------------------

from cachescope.sources import documents as DOC  # noqa: E402

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def run_documents(spark, sf):
    """(run_id, document): documents of the runs, built from the log's metrics."""
    log = TB.request_log(spark, sf)
    stamps = log.groupBy("run_id").agg(F.date_format(F.max("ts"), TS_FORMAT).alias("timestamp"))
    m = metrics_df(spark, sf).join(TB.runs(spark), "run_id", "left").join(TB.run_plan(spark), "run_id", "left") \
        .join(stamps, "run_id", "left")
    cfg = {k: F.col(k) for k in ("timestamp", "cache_mode", "embedding_model", "similarity_threshold",
                                 "subsets")}
    return DOC.to_documents(m, cfg)


SUMMARY31 = [c for c in DOC.SUMMARY_COLUMNS]


@register("document_summary", summary_sql(f"""
, stamps AS (SELECT run_id, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS ts FROM request_log GROUP BY run_id),
plan AS ({S.RUN_PLAN})
SELECT s.run_id, stamps.ts AS timestamp, 'gemma2:9b' AS model_name, 'ollama' AS model_provider,
       s.cache_mode, 'platinum-bench' AS dataset_name,
       coalesce(array_to_string(plan.subsets, ','), 'unknown') AS dataset_subsets, 0 AS slice_limit,
       CAST(0.0 AS DOUBLE) AS temperature, 256 AS max_tokens, CAST(0.9 AS DOUBLE) AS top_p, s.embedding_model,
       round(s.similarity_threshold, 6) AS similarity_threshold, CAST(NULL AS VARCHAR) AS looseness_preset,
       {_sql_round(['correctness', 'cache_hit_rate', 'bad_cache_hit_rate', 'cache_accuracy'])},
       total_queries, cache_hits, cache_misses, bad_cache_hits, good_cache_hits,
       {_sql_round(['latency_mean_sec', 'latency_p95_sec', 'throughput_qps', 'reliability_degradation',
                    'cache_effectiveness', 'correctness_without_bad_hits', 'cache_impact_on_correctness'])},
       s.run_id || '.json' AS result_file
FROM summary s LEFT JOIN stamps ON s.run_id = stamps.run_id LEFT JOIN plan ON s.run_id = plan.run_id"""))
def q_document_summary(spark, sf):
    docs = run_documents(spark, sf).select(F.concat("run_id", F.lit(".json")).alias("result_file"), "document")
    flat = DOC.flatten_documents(DOC.check_documents(docs))
    return _round_doubles(flat.select(*SUMMARY31))


# Field paths of the summary contract, in check order.
CONTRACT_PATHS = (DOC.REQUIRED_TOP + [f"model.{x}" for x in DOC.REQUIRED_MODEL]
                  + [f"metrics.{x}" for x in DOC.REQUIRED_METRICS]
                  + [f"metrics.cache_statistics.{x}" for x in DOC.REQUIRED_STATS])


def _missing_expect() -> str:
    rows = []
    for k, p in enumerate(CONTRACT_PATHS):
        n = 6 if p == "metrics.cache_statistics" else 1
        rows.append(f"({k}, {S.lit(p)}, {n})")
    rows.append(f"({len(CONTRACT_PATHS)}, NULL, 0)")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS t(variant, first_missing, n_missing)"


@register("missing_fields", S.with_views(f"""
WITH runs_seen AS (SELECT DISTINCT run_id FROM request_log),
v AS ({_missing_expect()})
SELECT r.run_id, v.variant, v.first_missing, v.n_missing, v.n_missing = 0 AS valid
FROM runs_seen r CROSS JOIN v""", "request_log"))
def q_missing_fields(spark, sf):
    """H1/G4 on documents with one contract field removed per variant."""
    log = TB.request_log(spark, sf)
    stamps = log.groupBy("run_id").agg(F.date_format(F.max("ts"), TS_FORMAT).alias("timestamp"))
    m = metrics_df(spark, sf).join(stamps, "run_id", "left")
    doc = DOC.document_struct({"timestamp": F.col("timestamp")})
    variants = [F.to_json(doc.dropFields(p), {"ignoreNullFields": "false"}) for p in CONTRACT_PATHS]
    variants.append(F.to_json(doc, {"ignoreNullFields": "false"}))
    d = m.select("run_id", F.posexplode(F.array(*variants)).alias("variant", "document"))
    c = DOC.check_documents(d)
    return c.select("run_id", F.col("variant").cast("int").alias("variant"), "first_missing",
                    F.size("missing").alias("n_missing"), "valid")


# --------------------------------------------------------------------------
# U2 + D3 / G2 over dense embeddings
# --------------------------------------------------------------------------

from cachescope.operators import vectors as VEC  # noqa: E402

EMB_THRESHOLD = 0.3

EMB_CTES = f"""
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS VARCHAR) AS label FROM embeddings),
pairs AS (SELECT a.vec_id AS i, b.vec_id AS j, list_cosine_similarity(a.v, b.v) AS sim
          FROM e a JOIN e b ON b.vec_id < a.vec_id
          WHERE list_cosine_similarity(a.v, b.v) >= {EMB_THRESHOLD})"""


def _emb_out(best_from: str) -> str:
    return f"""best AS (SELECT i, j, sim, row_number() OVER (PARTITION BY i ORDER BY round(sim, 9) DESC, j) AS rn
         FROM {best_from})
SELECT 'emb' AS run_id, x.vec_id AS seq, b.j IS NOT NULL AS reuse_hit, b.j AS served_seq,
       round(b.sim, 6) AS similarity, coalesce(b.j IS NOT NULL AND y.label <> x.label, false) AS bad_hit
FROM e x LEFT JOIN (SELECT * FROM best WHERE rn = 1) b ON b.i = x.vec_id LEFT JOIN e y ON y.vec_id = b.j"""


@register("embedding_reuse", f"""WITH RECURSIVE {EMB_CTES},
nb AS (SELECT i, list(j) AS nbrs FROM pairs GROUP BY i),
ord AS (SELECT x.vec_id, row_number() OVER (ORDER BY x.vec_id) AS k, coalesce(nb.nbrs, []) AS nbrs
        FROM e x LEFT JOIN nb ON nb.i = x.vec_id),
r AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS stored
      UNION ALL
      SELECT r.k + 1, CASE WHEN list_has_any(r.stored, o.nbrs) THEN r.stored
                           ELSE list_append(r.stored, o.vec_id) END
      FROM r JOIN ord o ON o.k = r.k + 1),
fin AS (SELECT stored FROM r ORDER BY k DESC LIMIT 1),
miss AS (SELECT unnest(stored) AS vec_id FROM fin),
{_emb_out("pairs WHERE j IN (SELECT vec_id FROM miss)")}""")
def q_embedding_reuse(spark, sf):
    reqs = TB.embedding_requests(spark, sf)
    r = VEC.vector_reuse(reqs, EMB_THRESHOLD, store="misses")
    return _emb_result(reqs, r)


def _emb_result(reqs, r):
    lab = reqs.select(F.col("seq").alias("id"), F.col("answer").alias("_a"))
    slab = reqs.select(F.col("seq").alias("served_id"), F.col("answer").alias("_sa"))
    g = r.join(lab, "id", "left").join(slab, "served_id", "left")
    return g.select(F.col("scope").alias("run_id"), F.col("id").alias("seq"), "reuse_hit",
                    F.col("served_id").alias("served_seq"), r6("similarity").alias("similarity"),
                    F.coalesce(F.col("reuse_hit") & (F.col("_sa") != F.col("_a")), F.lit(False)).alias("bad_hit"))


@register("nearest_embedding", f"WITH {EMB_CTES},\n{_emb_out('pairs')}")
def q_nearest_embedding(spark, sf):
    reqs = TB.embedding_requests(spark, sf)
    return _emb_result(reqs, VEC.vector_reuse(reqs, EMB_THRESHOLD, store="all"))


# --------------------------------------------------------------------------
# Presets over run configurations derived from the log
# --------------------------------------------------------------------------

# Rule that gives the derived runs a preset (the list holds an
# unknown name and a missing one on purpose) and a direct threshold.
PRESET_RULE = ["conservative", "moderate", "aggressive", "reckless", "sloppy", None]


def derived_runs(spark, sf):
    log = TB.request_log(spark, sf)
    r = log.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_requests"))
    presets = F.array(*[F.lit(p).cast("string") for p in PRESET_RULE])
    return r.select("run_id", "n_requests",
                    F.element_at(presets, (F.length("run_id") % len(PRESET_RULE) + 1).cast("int"))
                    .alias("looseness_preset"),
                    F.when(F.length("run_id") % 2 == 0, F.lit(0.9)).cast("double").alias("similarity_threshold"))


def _derived_runs_sql() -> str:
    arr = "[" + ", ".join("NULL" if p is None else S.lit(p) for p in PRESET_RULE) + "]"
    return f"""dr AS (SELECT run_id, count(*) AS n_requests,
         list_extract({arr}, CAST(length(run_id) % {len(PRESET_RULE)} AS INT) + 1) AS looseness_preset,
         CASE WHEN length(run_id) % 2 = 0 THEN CAST(0.9 AS DOUBLE) END AS similarity_threshold
       FROM request_log GROUP BY run_id)"""


def _preset_case(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {S.lit(k)} THEN CAST({v} AS DOUBLE)"
                              for k, v in S.PRESETS.items()) + " END"


@register("resolve_threshold", S.with_views(f"""
WITH {_derived_runs_sql()}
SELECT run_id, n_requests, looseness_preset,
       round(CASE WHEN looseness_preset IS NOT NULL THEN {_preset_case('looseness_preset')}
                  ELSE coalesce(similarity_threshold, 0.35) END, 6) AS resolved_threshold,
       (looseness_preset IS NULL OR {_preset_case('looseness_preset')} IS NOT NULL) AS preset_known
FROM dr""", "request_log"))
def q_resolve_threshold(spark, sf):
    r = U.resolve_threshold(derived_runs(spark, sf), strict=False)
    return r.select("run_id", "n_requests", "looseness_preset", r6("resolved_threshold").alias("resolved_threshold"),
                    "preset_known")


@register("unknown_presets", S.with_views(f"""
WITH {_derived_runs_sql()}
SELECT run_id, looseness_preset FROM dr
WHERE looseness_preset IS NOT NULL AND looseness_preset NOT IN ({', '.join(S.lit(k) for k in S.PRESETS)})""",
                                          "request_log"))
def q_unknown_presets(spark, sf):
    return U.unknown_presets(derived_runs(spark, sf)).select("run_id", "looseness_preset")


# --------------------------------------------------------------------------
# Entry 1 end to end: plan (D8) -> answers (U3) -> grade -> detect -> summary
# --------------------------------------------------------------------------

from cachescope.operators import answers as ANS  # noqa: E402


def logged_answers(spark, sf):
    """Logged answers per item, derived from ``part`` (the answer function's log)."""
    p = TB.table(spark, sf, "part")
    k = F.col("p_partkey")
    resp = (F.when(k % 4 == 0, F.concat(F.lit("Answer: "), (F.col("p_size") % 6).cast("string")))
            .when(k % 4 == 1, F.col("p_brand"))
            .when(k % 4 == 2, F.concat(F.lit("It is "), F.col("p_name")))
            .otherwise(F.concat(F.lit("Answer: "), F.col("p_size").cast("string"))))
    return p.select(k.alias("item_idx"), resp.alias("response"), ((k % 89) / 40.0).alias("latency_sec"))


LOGGED_ANSWERS_SQL = """SELECT p_partkey AS item_idx,
  CASE WHEN p_partkey % 4 = 0 THEN concat('Answer: ', CAST(p_size % 6 AS VARCHAR))
       WHEN p_partkey % 4 = 1 THEN p_brand
       WHEN p_partkey % 4 = 2 THEN concat('It is ', p_name)
       ELSE concat('Answer: ', CAST(p_size AS VARCHAR)) END AS response,
  (p_partkey % 89) / 40.0 AS latency_sec
FROM part"""


def _expected_list_sql() -> str:
    ia, il = S.int_or_null("answer"), S.int_or_null("label")
    return f"""CASE
  WHEN len(coalesce(platinum_target, [])) > 0 THEN list_transform(platinum_target, lambda x: coalesce(x, 'None'))
  WHEN subset IN ('singleq', 'singleop', 'multiarith') AND output_answer <> '' THEN [output_answer]
  WHEN subset = 'gsm8k' AND answer <> '' THEN [answer]
  WHEN subset = 'mmlu_math' AND {ia} >= 0 AND {ia} < len(choices) THEN [choices[{ia} + 1]]
  WHEN subset IN ('squad', 'hotpotqa') AND answer <> '' THEN [answer]
  WHEN subset = 'winograd_wsc' AND {il} >= 0 AND {il} < len(options) THEN [options[{il} + 1]]
  WHEN label <> '' THEN [label]
  WHEN output_answer <> '' THEN [output_answer]
  WHEN answer <> '' THEN [answer]
  ELSE [''] END"""


def _experiment_sql(body: str) -> str:
    planned = f"""WITH sel AS (SELECT subset, item_idx, {QUESTION_SQL} AS question, {_expected_list_sql()} AS expected,
               row_number() OVER (PARTITION BY subset ORDER BY item_idx) - 1 AS item_pos
             FROM eval_items WHERE {NOT_REJECTED}),
plan AS (SELECT run_id, unnest(subsets) AS subset, unnest(range(len(subsets))) AS subset_ord FROM run_plan),
sizes AS (SELECT subset, count(*) AS n FROM sel GROUP BY subset),
off AS (SELECT p.run_id, p.subset,
          coalesce(sum(coalesce(s.n, 0)) OVER (PARTITION BY p.run_id ORDER BY p.subset_ord
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
        FROM plan p LEFT JOIN sizes s ON p.subset = s.subset),
ans AS ({LOGGED_ANSWERS_SQL})
SELECT off.run_id, off.off + sel.item_pos AS seq, sel.question AS prompt, ans.response, ans.latency_sec,
       sel.expected, off.subset, sel.item_pos AS row_index
FROM off JOIN sel ON off.subset = sel.subset LEFT JOIN ans ON ans.item_idx = sel.item_idx"""
    views = {"eval_items": S.EVAL_ITEMS, "run_plan": S.RUN_PLAN, "runs": S.RUNS, "request_log": planned}
    ctes = ",\n".join(f"{n} AS ({v})" for n, v in views.items())
    return f"WITH {ctes},\n{METRICS_CTES}\n{body}"


def _experiment_hits(spark, sf, carry: tuple[str, ...] | None = None):
    plan = I.plan_requests(TB.run_plan(spark), items_df(spark, sf))
    log = ANS.as_request_log(ANS.answer_from_log(plan, logged_answers(spark, sf)))
    return H.detect_hits(log, carry=carry)


@register("experiment_item_log", _experiment_sql("""
SELECT h.run_id, h.seq, l.subset, l.row_index, h.prompt AS question, array_to_string(h.expected, '|') AS expected,
       h.response AS model_output, round(h.latency_sec, 6) AS latency_sec, h.cache_hit, h.correct
FROM hits h JOIN request_log l ON l.run_id = h.run_id AND l.seq = h.seq"""))
def q_experiment_item_log(spark, sf):
    """B9 over runs of several subsets: row_index is the position in the subset."""
    r = I.item_log(_experiment_hits(spark, sf))
    return r.withColumn("expected", F.array_join("expected", "|"))


@register("experiment_summary", _experiment_sql(f"SELECT {_sql_round(SUMMARY_COLS)} FROM summary"))
def q_experiment_summary(spark, sf):
    m = M.run_metrics(_experiment_hits(spark, sf, ()))
    return _round_doubles(m.join(TB.runs(spark), "run_id", "left").select(*SUMMARY_COLS))


from cachescope.plans import catalog_contract, catalog_reports, catalog_reuse, catalog_sources  # noqa: E402,F401  (register their queries)
