"""Input tables and the views that stand in for the reference's data model.

Every view is a projection of the given parquet tables, so its size grows with
the scale factor.  Scans are column-pruned and filters reach parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# The subset names of the stand-in items view, in this order.
SUBSETS = ["gsm8k", "hotpotqa", "singleq", "mmlu_math", "winograd_wsc", "squad"]


# Row keys used to spread a scan on request (hash partitioning on a key is
# deterministic, so a retried task sees the same rows).
ROW_KEYS = {"documents": ["doc_id"], "events": ["event_id"], "pages": ["page_id"],
            "conversations": ["conv_id", "turn"], "embeddings": ["vec_id"], "part": ["p_partkey"],
            "benchmark": ["item_id"], "labels": ["doc_id"], "lineitem": ["l_orderkey", "l_linenumber"],
            "orders": ["o_orderkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"]}


SCAN_PARTITIONS = "spark.cachescope.scanPartitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  Where the session sets ``SCAN_PARTITIONS``, its rows are spread over so many
    partitions (for tables that are one row group, as in local tests); a cluster leaves it unset and
    sizes its scans by ``spark.sql.files.maxPartitionBytes``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get(SCAN_PARTITIONS, None)
    if not parts or name not in ROW_KEYS:
        return df
    return df.repartition(int(parts), *ROW_KEYS[name])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by its row key over the shuffle partitions, before work that is heavy for the bytes it reads: a
    narrow scan of few MB is one or two tasks, however long each of its rows takes afterwards."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answered requests: one row per call (FIXTURES 1.2, 3)."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    expected = F.when(F.col("event_id") % 3 != 0, k).otherwise((F.col("user_id") % 100).cast("string"))
    return ev.select(
        F.col("event_type").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.concat(F.lit("question "), F.col("user_id").cast("string")).alias("prompt"),
        F.concat(F.lit("Answer: "), k).alias("response"),
        (F.col("value") / 100).alias("latency_sec"),
        F.array(expected).alias("expected"),
        F.col("ts"),
    )


def eval_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled questions with the ragged shape of the benchmark (FIXTURES 1.1, 3)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    subset = F.element_at(F.array(*[F.lit(s) for s in SUBSETS]), (k % 6).cast("int") + 1)
    return p.select(
        subset.alias("subset"),
        k.alias("item_idx"),
        F.when(k % 10 == 0, "rejected").when(k % 10 == 1, F.lit(None).cast("string"))
         .otherwise("consensus").alias("cleaning_status"),
        F.lit(None).cast("string").alias("platinum_prompt_no_cot"),
        F.when(k % 4 == 0, F.concat(F.lit("How big is "), F.col("p_name"), F.lit("?")))
         .when(k % 4 == 1, F.lit("")).alias("platinum_prompt"),
        F.when((k % 4).isin(1, 2), F.concat(F.lit("Size of "), F.col("p_name"), F.lit("?")))
         .alias("question"),
        F.lit(None).cast("string").alias("input"),
        F.lit(None).cast("string").alias("text"),
        F.concat(F.col("p_name"), F.lit(" has a size.")).alias("statement"),
        F.lit(None).cast("string").alias("question_concat"),
        F.when(k % 7 == 0, F.array(F.col("p_size").cast("string"), F.col("p_type"))).alias("platinum_target"),
        F.when(k % 5 != 0, (F.col("p_size") % 6).cast("string")).otherwise(F.lit("")).alias("answer"),
        F.when(k % 3 == 0, F.col("p_size").cast("string")).alias("output_answer"),
        F.lit(None).cast("string").alias("target"),
        (F.col("p_size") % 3).cast("string").alias("label"),
        F.array(F.col("p_brand"), F.col("p_type"), F.col("p_name"), F.lit("none")).alias("choices"),
        F.array(F.col("p_brand"), F.col("p_name")).alias("options"),
        F.lit(None).cast("struct<text:array<string>>").alias("answers"),
    )


RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("cache_mode", T.StringType()),
    T.StructField("embedding_model", T.StringType()),
    T.StructField("similarity_threshold", T.DoubleType()),
])

# The run configurations of the stand-in runs view (FIXTURES 3).
RUN_ROWS = [
    ("error", "none", None, None),
    ("click", "custom_semantic", "bge_small", 0.9),
    ("view", "custom_semantic", "bge_small", 0.95),
    ("signup", "custom_semantic", "mpnet", 0.9),
    ("purchase", "custom_semantic", "mpnet", 0.95),
]


def runs(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """Run configurations: one row per run (configuration data, not a log)."""
    return spark.createDataFrame(RUN_ROWS, RUNS_SCHEMA)


# Which subsets each stand-in run asks, in order (run plan of D8).
RUN_PLAN_ROWS = [
    ("error", ["gsm8k", "hotpotqa", "singleq", "mmlu_math", "winograd_wsc"]),
    ("click", ["gsm8k", "singleq"]),
    ("view", ["squad"]),
    ("signup", ["winograd_wsc", "mmlu_math", "hotpotqa"]),
    ("purchase", ["hotpotqa", "gsm8k"]),
]


def run_plan(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """Run configurations with their ordered subset lists."""
    return spark.createDataFrame(RUN_PLAN_ROWS, "run_id string, subsets array<string>")


def embedding_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with embeddings: vec_id is the request order, one scope."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.lit("emb").alias("run_id"), F.col("vec_id").alias("seq"),
                    F.concat(F.lit("prompt "), F.col("vec_id").cast("string")).alias("prompt"),
                    F.col("embedding"), F.col("label").cast("string").alias("answer"))


def document_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as prompts: doc_id is the request order, one scope per source."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("run_id"), F.col("doc_id").alias("seq"),
                    F.col("text").alias("prompt"), F.col("lang"))
