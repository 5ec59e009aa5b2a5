"""Registered queries of reports: accuracy by subset (E7), pairs of an item (D7), pivot over many thresholds (E9),
inventory of documents (E11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cachescope.functions import grading as G
from cachescope.functions import text as X
from cachescope.operators import answers as ANS
from cachescope.operators import hits as H
from cachescope.operators import items as I
from cachescope.operators import report as R
from cachescope.plans import catalog as C
from cachescope.plans import sql as S
from cachescope.sources import documents as DOC
from cachescope.sources import tables as TB

register, r6 = C.register, C.r6


def answered_items(spark, sf):
    """Every item that is not rejected, with its question, gold answers and logged answer."""
    it = I.drop_rejected(TB.eval_items(spark, sf))
    asked = it.select("subset", "item_idx", I.pick_question(it).alias("question"), I.expected_answers().alias("expected"))
    return ANS.answer_from_log(asked, C.logged_answers(spark, sf))


_ANSWERED_SQL = f"""
ans AS ({C.LOGGED_ANSWERS_SQL}),
items AS (SELECT subset, item_idx, {C.QUESTION_SQL} AS question, {C._expected_list_sql()} AS expected
          FROM eval_items WHERE {C.NOT_REJECTED}),
answered AS (SELECT items.*, ans.response, ans.latency_sec FROM items LEFT JOIN ans USING (item_idx))"""


# --------------------------------------------------------------------------
# Accuracy by subset with the verdict of the task
# --------------------------------------------------------------------------

@register("subset_accuracy", S.with_views(f"""WITH {_ANSWERED_SQL},
cand AS (SELECT subset, item_idx, response, latency_sec, len(expected) AS n_exp, unnest(expected) AS e FROM answered),
c AS (SELECT *, {S.num('response')} AS mn, {S.norm('response')} AS mnrm, {S.num('e')} AS en, {S.norm('e')} AS enrm FROM cand),
v AS (SELECT subset, item_idx, any_value(latency_sec) AS latency_sec,
        CASE WHEN count_if(en IS NOT NULL) >= greatest(1, max(n_exp) // 2)
             THEN coalesce(bool_or(en = mn OR abs(en - mn) <= greatest(1e-6 * greatest(abs(en), abs(mn)), 1e-6)), false)
             ELSE coalesce(bool_or(enrm = mnrm OR contains(mnrm, enrm) OR contains(enrm, mnrm)), false) END AS correct
      FROM c GROUP BY subset, item_idx)
SELECT coalesce(subset, 'OVERALL') AS subset, count_if(correct) AS correct, count(*) AS total,
       round(100.0 * count_if(correct) / count(*), 6) AS accuracy_pct, round(avg(latency_sec), 6) AS avg_latency_sec
FROM v GROUP BY ROLLUP (subset)""", "eval_items"))
def q_subset_accuracy(spark, sf):
    """E7 over the subsets of the items, graded by the task's verdict."""
    graded = answered_items(spark, sf).withColumn("correct", G.task_verdict("expected", "response"))
    r = R.subset_report(graded)
    return r.select("subset", "correct", "total", r6("accuracy_pct").alias("accuracy_pct"),
                    r6("avg_latency_sec").alias("avg_latency_sec"))


# --------------------------------------------------------------------------
# The question of an item and its paraphrase
# --------------------------------------------------------------------------

@register("paraphrase_hits", S.with_views(f"""WITH {_ANSWERED_SQL},
second AS (SELECT subset, item_idx, {S.paraphrase('question')} AS paraphrase,
             CASE WHEN item_idx % 5 = 0 THEN concat('No, ', response) ELSE response END AS response,
             latency_sec * CASE WHEN item_idx % 3 = 0 THEN 1.0 ELSE 0.5 END AS latency_sec FROM answered)
SELECT a.subset, a.item_idx, a.question, b.paraphrase, a.response AS seed_output, b.response AS paraphrase_output,
       coalesce(a.response = b.response AND b.latency_sec < greatest(0.25, 0.7 * a.latency_sec), false) AS semantic_hit_likely
FROM answered a JOIN second b USING (subset, item_idx)""", "eval_items"))
def q_paraphrase_hits(spark, sf):
    """D7 on true pairs: every item's question and its paraphrase (B7), whose answers differ and take as long by rule."""
    seed = answered_items(spark, sf)
    k = F.col("item_idx")
    second = seed.select(
        "subset", "item_idx", F.when(k % 5 == 0, F.concat(F.lit("No, "), "response")).otherwise(F.col("response")).alias("response"),
        (F.col("latency_sec") * F.when(k % 3 == 0, 1.0).otherwise(0.5)).alias("latency_sec"))
    pairs = H.paired_hits(seed, second, keys=("subset", "item_idx"), carry=("question",))
    return pairs.select("subset", "item_idx", "question", X.paraphrase("question").alias("paraphrase"), "seed_output",
                        "paraphrase_output", "semantic_hit_likely")


# --------------------------------------------------------------------------
# Many thresholds, model names
# --------------------------------------------------------------------------

def graded_thresholds(spark, sf):
    """The summary of 18 runs, dealt from the log, with six thresholds by rule (one unknown) and three encoders."""
    log = TB.request_log(spark, sf).withColumn("run_id", (F.col("seq") % 18).cast("string"))
    m = C.M.run_metrics(H.detect_hits(log, carry=()))
    k = F.col("run_id").cast("int")
    return m.select(
        "*", F.when(k % 6 == 5, "none").otherwise("custom_semantic").alias("cache_mode"),
        F.get(F.array(*[F.lit(x) for x in ("bge_small", "e5_large_v2", "mpnet")]), (k % 3)).alias("embedding_model"),
        F.when(k != 4, F.get(F.array(*[F.lit(x) for x in (0.6, 0.75, 0.8, 0.85, 0.9, 0.95)]), F.floor(k / 3).cast("int")))
        .alias("similarity_threshold"))


_DEALT_LOG = S.REQUEST_LOG.replace("event_type AS run_id", "CAST(event_id % 18 AS VARCHAR) AS run_id")
_MANY_RUNS = """SELECT CAST(k AS VARCHAR) AS run_id, CASE WHEN k % 6 = 5 THEN 'none' ELSE 'custom_semantic' END AS cache_mode,
  CASE k % 3 WHEN 0 THEN 'bge_small' WHEN 1 THEN 'e5_large_v2' ELSE 'mpnet' END AS embedding_model,
  CASE WHEN k <> 4 THEN CAST(CASE k // 3 WHEN 0 THEN 0.6 WHEN 1 THEN 0.75 WHEN 2 THEN 0.8 WHEN 3 THEN 0.85
    WHEN 4 THEN 0.9 ELSE 0.95 END AS DOUBLE) END AS similarity_threshold FROM range(18) t(k)"""


def _many_thresholds_sql() -> str:
    cols = []
    for t in ("0.6", "0.75", "0.8", "0.85", "0.9", "0.95"):
        tag = t.replace(".", "_")
        mean = "avg({}) FILTER (similarity_threshold = " + t + ")"
        cols += [f"round({mean.format(c)}, 6) AS {c}_{tag}" for c in ("correctness", "cache_accuracy", "bad_cache_hit_rate")]
        cols += [f"CAST(trunc({mean.format(c)}) AS BIGINT) AS {out}_{tag}" for c, out in (
            ("good_cache_hits", "good_hits"), ("bad_cache_hits", "bad_hits"), ("cache_hits", "total_hits"))]
    return f"""WITH request_log AS ({_DEALT_LOG}), runs AS ({_MANY_RUNS}), {C.METRICS_CTES}
SELECT embedding_model, {', '.join(cols)} FROM summary
WHERE cache_mode <> 'none' AND similarity_threshold IS NOT NULL GROUP BY embedding_model"""


@register("pivot_many_thresholds", _many_thresholds_sql())
def q_pivot_many_thresholds(spark, sf):
    """E9 where the thresholds come from the runs: six of them, one run without any."""
    p = R.pivot_model_threshold(graded_thresholds(spark, sf))
    return p.select(*[r6(c).alias(c) if c.startswith(("correctness", "cache_accuracy", "bad_cache_hit_rate"))
                      else F.col(c) for c in p.columns])


@register("document_inventory", C.summary_sql("""
SELECT array_to_string(list_sort(list_distinct(list(cache_mode))), ',') AS cache_modes,
       any_value('gemma2:9b') AS model_names,
       array_to_string(list_sort(list_distinct(list(embedding_model))), ',') AS embedding_models
FROM summary"""))
def q_document_inventory(spark, sf):
    """E11 over the flattened run documents, with their model names."""
    docs = C.run_documents(spark, sf).select(F.concat("run_id", F.lit(".json")).alias("result_file"), "document")
    return R.run_inventory(DOC.flatten_documents(DOC.check_documents(docs)))
