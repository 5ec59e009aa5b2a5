"""Registered queries over files that Spark derives from the given tables: A1, A2, A7, E6, E14."""

from __future__ import annotations

from pyspark.sql import functions as F

from cachescope.operators import items as I
from cachescope.operators import metrics as M
from cachescope.plans import catalog as C
from cachescope.plans import sql as S
from cachescope.session import shared_folder
from cachescope.sources import configs as CF
from cachescope.sources import items as SI
from cachescope.sources import tables as TB

register, r6 = C.register, C.r6


# --------------------------------------------------------------------------
# A1, A2: items written as files and read back
# --------------------------------------------------------------------------

def item_lines(spark, sf):
    """JSON lines of the items: targets are lists in some rows and scalars in others, and a rule breaks some lines."""
    it = TB.eval_items(spark, sf)
    k = F.col("item_idx")
    split = F.when(k % 9 == 0, "train").otherwise("test")
    fields = [c for c in it.columns if c not in ("subset", "platinum_target", "answers")]
    as_list = F.to_json(F.struct(*fields, "platinum_target"))
    as_text = F.to_json(F.struct(*fields, F.get("platinum_target", 0).alias("platinum_target")))
    line = F.when(k % 14 == 0, as_text).otherwise(as_list)
    line = F.when(k % 13 == 0, F.substring(line, 1, 20)).when(k % 17 == 0, F.lit("[1, 2]")).otherwise(line)
    return it.select("subset", split.alias("split"), line.alias("line"))


def written_lines(spark, sf):
    path = shared_folder(spark, "items")
    SI.write_items(item_lines(spark, sf), path, "json")
    return path


_FILE_ITEMS = """
fi AS (SELECT *, CASE WHEN item_idx % 9 = 0 THEN 'train' ELSE 'test' END AS split,
         CASE WHEN item_idx % 13 = 0 THEN 'not JSON' WHEN item_idx % 17 = 0 THEN 'not an object' END AS reason,
         CASE WHEN item_idx % 14 = 0 THEN platinum_target[1:1] ELSE platinum_target END AS target_list
       FROM eval_items)"""


def _read_items_sql(where: str) -> str:
    body = C._expected_list_sql().replace("platinum_target", "target_list")
    return S.with_views(f"""WITH {_FILE_ITEMS}
SELECT subset, item_idx, {C.QUESTION_SQL} AS question, array_to_string({body}, '|') AS expected
FROM fi WHERE reason IS NULL AND {where}""", "eval_items")


def _chosen(items):
    return items.select("subset", "item_idx", I.pick_question(items).alias("question"),
                        F.array_join(I.expected_answers(), "|").alias("expected"))


@register("read_json_items", _read_items_sql("split = 'test' AND subset IN ('gsm8k', 'squad', 'mmlu_math')"))
def q_read_json_items(spark, sf):
    """A2: three subsets of the test split from JSON lines, ragged targets unified."""
    items, _ = SI.read_json_items(spark, written_lines(spark, sf), ["gsm8k", "squad", "mmlu_math"])
    return _chosen(items)


@register("rejected_item_lines", S.with_views(f"""WITH {_FILE_ITEMS}
SELECT subset, split, reason, count(*) AS n FROM fi WHERE reason IS NOT NULL GROUP BY ALL""", "eval_items"))
def q_rejected_item_lines(spark, sf):
    """A2: lines that are no JSON object, by subset, split and reason."""
    _, rejects = SI.read_json_items(spark, written_lines(spark, sf), split=None)
    return rejects.groupBy("subset", "split", "reason").agg(F.count(F.lit(1)).alias("n"))


@register("read_parquet_items", S.with_views(f"""
SELECT e.subset, e.item_idx, {C.QUESTION_SQL} AS question, array_to_string({C._expected_list_sql()}, '|') AS expected
FROM eval_items e WHERE item_idx % 9 <> 0 AND subset IN (SELECT unnest(subsets) FROM run_plan WHERE run_id IN ('click', 'view'))""",
                                             "eval_items", "run_plan"))
def q_read_parquet_items(spark, sf):
    """A1: the test items of the subsets that two runs ask for, from Parquet folders pruned at run time."""
    path = shared_folder(spark, "items")
    it = TB.eval_items(spark, sf)
    SI.write_items(it.withColumn("split", F.when(F.col("item_idx") % 9 == 0, "train").otherwise("test")), path)
    plan = TB.run_plan(spark).where(F.col("run_id").isin("click", "view"))
    return _chosen(SI.items_of_runs(SI.read_parquet_items(spark, path), plan))


# --------------------------------------------------------------------------
# Runs from configuration documents
# --------------------------------------------------------------------------

def config_documents(spark, sf):
    """One configuration document a nation: four belong to runs of the log, the others have no requests; keys,
    types and names are left out or broken by rule."""
    n = TB.table(spark, sf, "nation")
    k = F.col("n_nationkey")
    logged = F.get(F.array(*[F.lit(x) for x in ("click", "view", "signup", "purchase")]), k)
    run = F.struct(F.coalesce(logged, F.concat(F.lit("idle_"), F.lower("n_name"))).alias("id"),
                   F.when(k % 2 == 0, k).alias("seed"))
    cache = F.struct(
        F.when(k % 5 == 4, "custom-semantic").when(k % 5 != 0, "custom_semantic").alias("mode"),
        F.when(k % 2 == 0, "bge_small").otherwise("mpnet").alias("embedding_model"),
        F.when(k % 3 != 0, 0.9).alias("similarity_threshold"), F.when(k == 11, "lots").alias("capacity"))
    subset = F.struct(F.when(k % 4 == 1, "squad").alias("subset"))
    subsets = F.struct(F.array(F.lit("gsm8k"), F.lit("squad")).alias("subsets"),
                       F.struct((k % 3).alias("start"), F.when(k % 2 == 0, 40).alias("limit")).alias("slice"))
    model = F.struct(F.when(k == 12, "other").alias("provider"), F.lit("gemma2:9b").alias("name"),
                     F.struct(F.lit(0.0).alias("temperature"), F.lit(256).alias("max_tokens")).alias("params"))
    short = F.to_json(F.struct(run.alias("run"), model.alias("model"), subset.alias("dataset"), cache.alias("cache")))
    long = F.to_json(F.struct(run.alias("run"), model.alias("model"), subsets.alias("dataset"), cache.alias("cache"),
                              F.when(k == 13, k).alias("extra")))
    text = F.when(k == 14, F.substring(long, 1, 30)).when(k % 2 == 0, short).otherwise(long)
    return n.select("n_nationkey", text.alias("config"))


_CONFIG_SQL = """
cf AS (SELECT n_nationkey AS k, coalesce(['click', 'view', 'signup', 'purchase'][n_nationkey + 1],
         'idle_' || lower(n_name)) AS run_id FROM nation),
rc AS (SELECT k, run_id, CASE WHEN k % 2 = 0 THEN k END AS seed,
         CASE WHEN k = 12 THEN 'other' ELSE 'ollama' END AS model_provider,
         CASE WHEN k % 2 = 0 THEN CASE WHEN k % 4 = 1 THEN 'squad' ELSE 'gsm8k' END ELSE 'gsm8k,squad' END AS subsets,
         CASE WHEN k % 2 = 0 THEN 0 ELSE k % 3 END AS slice_start, 10 AS slice_limit,
         CASE WHEN k % 5 = 0 THEN 'none' ELSE 'custom_semantic' END AS cache_mode,
         CASE WHEN k % 2 = 0 THEN 'bge_small' ELSE 'mpnet' END AS embedding_model,
         CASE WHEN k % 3 <> 0 THEN CAST(0.9 AS DOUBLE) END AS similarity_threshold
       FROM cf WHERE k <> 14)"""


def configured_runs(spark, sf):
    """Typed runs of the documents that are JSON objects."""
    return CF.resolve_configs(config_documents(spark, sf)).where(F.col("run_id").isNotNull())


@register("configured_runs", f"""WITH {_CONFIG_SQL}
SELECT run_id, CAST(seed AS BIGINT) AS seed, model_provider, subsets, CAST(slice_start AS BIGINT) AS slice_start,
       CAST(slice_limit AS BIGINT) AS slice_limit, cache_mode, embedding_model, similarity_threshold,
       '256' AS max_tokens, '{{run_id}}.json' AS filename_pattern FROM rc""")
def q_configured_runs(spark, sf):
    """Configuration documents as rows, with the declared defaults."""
    r = configured_runs(spark, sf)
    return r.select("run_id", "seed", "model_provider", F.array_join("subsets", ",").alias("subsets"), "slice_start",
                    "slice_limit", "cache_mode", "embedding_model", "similarity_threshold",
                    F.try_element_at("params", F.lit("max_tokens")).alias("max_tokens"), "filename_pattern")


@register("config_problems", f"""WITH {_CONFIG_SQL}
SELECT k AS n_nationkey, run_id, 'type:cache.capacity' AS problem FROM cf WHERE k = 11
UNION ALL SELECT k, run_id, 'unsupported:model.provider:other' FROM cf WHERE k = 12
UNION ALL SELECT k, run_id, 'unknown:extra' FROM cf WHERE k = 13
UNION ALL SELECT k, NULL, 'not a JSON object' FROM cf WHERE k = 14""")
def q_config_problems(spark, sf):
    """What the documents hold that the declaration does not know."""
    return CF.config_problems(config_documents(spark, sf)).select("n_nationkey", "run_id", "problem")


CONFIGURED = ["run_id", "cache_mode", "embedding_model", "similarity_threshold"]


@register("configured_summary", C.summary_sql(f""",
{_CONFIG_SQL}
SELECT coalesce(m.run_id, c.run_id) AS run_id, c.cache_mode, c.embedding_model, c.similarity_threshold,
       coalesce(m.total_queries, 0) AS total_queries, coalesce(m.cache_hits, 0) AS cache_hits,
       round(coalesce(m.correctness, 0), 6) AS correctness, m.run_id IS NULL AS is_empty, c.run_id IS NULL AS is_unconfigured
FROM met m FULL JOIN rc c ON c.run_id = m.run_id"""))
def q_configured_summary(spark, sf):
    """E6 and E14 over configured runs: runs without requests have zeros, requests without a configuration stay."""
    s = M.configured_metrics(configured_runs(spark, sf).select(*CONFIGURED), C.metrics_df(spark, sf))
    return s.select(*CONFIGURED, "total_queries", "cache_hits", r6("correctness").alias("correctness"), "is_empty",
                    "is_unconfigured")
