"""Run documents and the flat summary: A3-A6, B10, B11, E5 (from documents), G1, G4, H1.

A run document is one nested JSON object per run (FIXTURES 1.3).  Item rows
stay a table of their own (``item_log``); documents carry configuration and
metrics only, so no run is ever gathered into one array.

Reading is ``spark.read.text(wholetext=True)``: one row per file, with its path
from the ``_metadata`` column.  Parsing uses ``try_parse_json`` (invalid JSON
becomes NULL and goes to the rejects table instead of failing the job);
key presence uses ``json_object_keys``, so a key holding JSON null counts as
present, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cachescope.operators.metrics import reliability
from cachescope.sources.run_files import PATTERN, write_run_files

# ---------------------------------------------------------------------------
# The summary contract of the reference, in its order.
#   top level:        run_id timestamp model dataset cache metrics items
#   model:            provider name params
#   metrics:          cache_hit_rate bad_cache_hit_rate cache_accuracy
#                     cache_statistics correctness latency_mean_sec
#   cache_statistics: total_queries cache_hits cache_misses bad_cache_hits good_cache_hits
# Columns the comparison step requires in the summary, and the ones it coerces
# to numbers.
# ---------------------------------------------------------------------------
REQUIRED_TOP = ["run_id", "timestamp", "model", "dataset", "cache", "metrics", "items"]
REQUIRED_MODEL = ["provider", "name", "params"]
REQUIRED_METRICS = ["cache_hit_rate", "bad_cache_hit_rate", "cache_accuracy", "cache_statistics",
                    "correctness", "latency_mean_sec"]
REQUIRED_STATS = ["total_queries", "cache_hits", "cache_misses", "bad_cache_hits", "good_cache_hits"]
REQUIRED_SUMMARY_COLS = ["cache_mode", "model_name", "embedding_model", "similarity_threshold",
                         "correctness", "cache_hit_rate", "bad_cache_hit_rate", "cache_accuracy",
                         "bad_cache_hits", "good_cache_hits", "cache_hits", "latency_mean_sec"]
NUMERIC_SUMMARY_COLS = ["similarity_threshold", "correctness", "cache_hit_rate", "bad_cache_hit_rate",
                        "cache_accuracy", "bad_cache_hits", "good_cache_hits", "cache_hits",
                        "latency_mean_sec"]

SUMMARY_COLUMNS = [
    "run_id", "timestamp", "model_name", "model_provider", "cache_mode", "dataset_name",
    "dataset_subsets", "slice_limit", "temperature", "max_tokens", "top_p", "embedding_model",
    "similarity_threshold", "looseness_preset", "correctness", "cache_hit_rate",
    "bad_cache_hit_rate", "cache_accuracy", "total_queries", "cache_hits", "cache_misses",
    "bad_cache_hits", "good_cache_hits", "latency_mean_sec", "latency_p95_sec", "throughput_qps",
    "reliability_degradation", "cache_effectiveness", "correctness_without_bad_hits",
    "cache_impact_on_correctness", "result_file"]

STATS_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in REQUIRED_STATS] + [
    T.StructField("hit_rate", T.DoubleType()), T.StructField("bad_hit_rate", T.DoubleType()),
    T.StructField("cache_accuracy", T.DoubleType()), T.StructField("queries_with_hits", T.LongType())])

DOC_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("model", T.StructType([
        T.StructField("provider", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("base_url", T.StringType()),
        T.StructField("params", T.StructType([
            T.StructField("temperature", T.DoubleType()), T.StructField("max_tokens", T.LongType()),
            T.StructField("top_p", T.DoubleType())]))])),
    T.StructField("dataset", T.StructType([
        T.StructField("name", T.StringType()), T.StructField("split", T.StringType()),
        T.StructField("slice", T.StructType([T.StructField("start", T.LongType()),
                                             T.StructField("limit", T.LongType())])),
        T.StructField("subset", T.StringType()), T.StructField("subsets", T.ArrayType(T.StringType()))])),
    T.StructField("cache", T.StructType([
        T.StructField("mode", T.StringType()), T.StructField("embedding_model", T.StringType()),
        T.StructField("similarity_threshold", T.DoubleType()), T.StructField("looseness_preset", T.StringType()),
        T.StructField("vstore", T.StringType()), T.StructField("capacity", T.LongType()),
        T.StructField("eviction", T.StringType())])),
    T.StructField("metrics", T.StructType([
        T.StructField("latency_mean_sec", T.DoubleType()), T.StructField("latency_p95_sec", T.DoubleType()),
        T.StructField("latency_p99_sec", T.DoubleType()), T.StructField("cache_hit_rate", T.DoubleType()),
        T.StructField("bad_cache_hit_rate", T.DoubleType()), T.StructField("cache_accuracy", T.DoubleType()),
        T.StructField("cache_statistics", STATS_TYPE), T.StructField("throughput_qps", T.DoubleType()),
        T.StructField("correctness", T.DoubleType())])),
])


# ---------------------------------------------------------------------------
# build and write (A4)
# ---------------------------------------------------------------------------

def document_struct(cfg: dict[str, Column], m: str = "") -> Column:
    """Nested run document from run configuration columns and per-run metric
    columns (names as produced by ``operators.metrics.run_metrics``)."""
    c = lambda k, default=None: cfg.get(k, F.lit(default))
    subsets = cfg.get("subsets", F.lit(None).cast("array<string>"))
    dataset = F.struct(
        c("dataset_name", "platinum-bench").alias("name"), c("split", "test").alias("split"),
        F.struct(c("slice_start", 0).cast("long").alias("start"),
                 c("slice_limit").cast("long").alias("limit")).alias("slice"),
        F.when(F.size(subsets) == 1, F.get(subsets, 0)).alias("subset"),
        F.when(F.size(subsets) != 1, subsets).alias("subsets"))
    stats = F.struct(*[F.col(x) for x in REQUIRED_STATS], F.col("cache_hit_rate").alias("hit_rate"),
                     F.col("bad_cache_hit_rate").alias("bad_hit_rate"), F.col("cache_accuracy"),
                     F.col("queries_with_hits"))
    metrics = F.struct(
        "latency_mean_sec", "latency_p95_sec", "latency_p99_sec", "cache_hit_rate", "bad_cache_hit_rate",
        "cache_accuracy", stats.alias("cache_statistics"), "throughput_qps", "correctness")
    return F.struct(
        F.col("run_id"), c("timestamp").cast("string").alias("timestamp"),
        F.struct(c("model_provider", "ollama").alias("provider"), c("model_name", "gemma2:9b").alias("name"),
                 c("base_url").cast("string").alias("base_url"),
                 F.struct(c("temperature", 0.0).cast("double").alias("temperature"),
                          c("max_tokens", 256).cast("long").alias("max_tokens"),
                          c("top_p", 0.9).cast("double").alias("top_p")).alias("params")).alias("model"),
        dataset.alias("dataset"),
        F.struct(c("cache_mode", "none").alias("mode"), c("embedding_model").cast("string").alias("embedding_model"),
                 c("similarity_threshold").cast("double").alias("similarity_threshold"),
                 c("looseness_preset").cast("string").alias("looseness_preset"),
                 c("vstore").cast("string").alias("vstore"), c("capacity").cast("long").alias("capacity"),
                 c("eviction").cast("string").alias("eviction")).alias("cache"),
        metrics.alias("metrics"),
        F.array().cast("array<string>").alias("items"))


def to_documents(df: DataFrame, cfg: dict[str, Column]) -> DataFrame:
    """(run_id, document JSON text), one row per run; the dataset has ``subset`` or ``subsets``, never both."""
    doc, keep = document_struct(cfg), {"ignoreNullFields": "false"}
    text = F.when(doc["dataset"]["subset"].isNotNull(), F.to_json(doc.dropFields("dataset.subsets"), keep)).otherwise(
        F.to_json(doc.dropFields("dataset.subset"), keep))
    return df.select("run_id", text.alias("document"))


def write_documents(docs: DataFrame, path: str, pattern: str = PATTERN) -> None:
    """A4: one file per run, named by ``pattern`` (columns of ``docs`` in braces)."""
    write_run_files(docs, path, pattern)


def write_items(items: DataFrame, path: str) -> None:
    """Item rows of every run as parquet, partitioned by run (the
    per-run array of the reference stays a table)."""
    items.write.mode("overwrite").partitionBy("run_id").parquet(path)


# ---------------------------------------------------------------------------
# read and check
# ---------------------------------------------------------------------------

def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A3: every ``*.json`` file of the folder ``path``, not of folders below it, as one row (result_file, document)."""
    raw = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.json").text(path)
    return raw.select(F.col("_metadata.file_path").alias("result_file"), F.col("value").alias("document"))


def _keys(doc: Column, path: str | None = None) -> Column:
    j = doc if path is None else F.get_json_object(doc, f"$.{path}")
    obj = F.when(F.regexp_like(F.coalesce(j, F.lit("")), F.lit(r"^\s*\{")), j)
    return F.coalesce(F.json_object_keys(obj), F.array().cast("array<string>"))


def _missing(required: list[str], keys: Column, prefix: str = "") -> Column:
    miss = F.array_except(F.array(*[F.lit(r) for r in required]), keys)
    return miss if not prefix else F.transform(miss, lambda x: F.concat(F.lit(prefix), x))


def check_documents(docs: DataFrame, doc: str = "document") -> DataFrame:
    """Adds ``missing`` (required names absent, in contract order),
    ``first_missing``, ``is_json`` and ``valid``.  The reference stops at the
    first missing top-level name before looking inside; the list keeps that
    order."""
    d = F.col(doc)
    is_json = F.try_parse_json(d).isNotNull() & F.regexp_like(F.coalesce(d, F.lit("")), F.lit(r"^\s*\{"))
    top = _missing(REQUIRED_TOP, _keys(d))
    nested = F.concat(_missing(REQUIRED_MODEL, _keys(d, "model"), "model."),
                      _missing(REQUIRED_METRICS, _keys(d, "metrics"), "metrics."),
                      _missing(REQUIRED_STATS, _keys(d, "metrics.cache_statistics"), "metrics.cache_statistics."))
    missing = F.when(~is_json, F.array(F.lit("<invalid json>"))) \
        .when(F.size(top) > 0, top).otherwise(nested)
    return docs.select("*", is_json.alias("is_json"), missing.alias("missing")) \
        .withColumn("first_missing", F.get(F.col("missing"), 0)) \
        .withColumn("valid", F.size("missing") == 0)


def dataset_label(subsets: Column, subset: Column) -> Column:
    """Subsets joined by comma, else the single subset, else ``unknown``."""
    return F.coalesce(F.array_join(subsets, ","), subset, F.lit("unknown"))


def flatten_documents(checked: DataFrame, base_dir: str | None = None) -> DataFrame:
    """B11 + E5: valid documents to the 31 summary columns, in file-name order (G1)."""
    p = checked.where("valid").select("result_file", F.from_json("document", DOC_SCHEMA).alias("d"))
    rel = F.col("result_file")
    if base_dir:
        # path below the scanned folder (file URIs differ from the given path)
        last = base_dir.rstrip("/").split("/")[-1]
        rel = F.regexp_replace(rel, "^.*?/\\Q" + last + "\\E/", "")
    st = "d.metrics.cache_statistics"
    flat = p.select(
        F.col("d.run_id").alias("run_id"), F.col("d.timestamp").alias("timestamp"),
        F.col("d.model.name").alias("model_name"), F.col("d.model.provider").alias("model_provider"),
        F.col("d.cache.mode").alias("cache_mode"),
        F.coalesce(F.col("d.dataset.name"), F.lit("unknown")).alias("dataset_name"),
        dataset_label(F.col("d.dataset.subsets"), F.col("d.dataset.subset")).alias("dataset_subsets"),
        F.coalesce(F.col("d.dataset.slice.limit"), F.lit(0)).alias("slice_limit"),
        F.col("d.model.params.temperature").alias("temperature"),
        F.col("d.model.params.max_tokens").alias("max_tokens"),
        F.col("d.model.params.top_p").alias("top_p"),
        F.col("d.cache.embedding_model").alias("embedding_model"),
        F.col("d.cache.similarity_threshold").alias("similarity_threshold"),
        F.col("d.cache.looseness_preset").alias("looseness_preset"),
        F.col("d.metrics.correctness").alias("correctness"),
        F.col("d.metrics.cache_hit_rate").alias("cache_hit_rate"),
        F.col("d.metrics.bad_cache_hit_rate").alias("bad_cache_hit_rate"),
        F.col("d.metrics.cache_accuracy").alias("cache_accuracy"),
        *[F.col(f"{st}.{c}").alias(c) for c in REQUIRED_STATS],
        F.col("d.metrics.latency_mean_sec").alias("latency_mean_sec"),
        F.col("d.metrics.latency_p95_sec").alias("latency_p95_sec"),
        F.col("d.metrics.throughput_qps").alias("throughput_qps"),
        rel.alias("result_file"))
    return reliability(flat).select(*SUMMARY_COLUMNS)


def aggregate_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entry 2: scan a folder of run documents -> (summary, rejects).

    Rejects carry the file and the first missing name (or ``<invalid json>``);
    the summary is ordered by file name.
    """
    checked = check_documents(read_documents(spark, path))
    summary = flatten_documents(checked, path).orderBy("result_file")
    rejects = checked.where(~F.col("valid")).select("result_file", "first_missing", "missing")
    return summary, rejects


# ---------------------------------------------------------------------------
# summary CSV
# ---------------------------------------------------------------------------

def write_summary_csv(summary: DataFrame, path: str) -> None:
    """A5: the summary with a header line (one file per partition)."""
    summary.write.mode("overwrite").option("header", "true").csv(path)


def read_summary_csv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Read the summary, check the required columns, coerce the numeric ones
    (a value that is not a number becomes NULL, like ``errors='coerce'``)."""
    df = spark.read.option("header", "true").csv(path)
    missing = [c for c in REQUIRED_SUMMARY_COLS if c not in df.columns]
    if missing and strict:
        raise ValueError(f"Missing required columns: {missing}")
    return df.select(*[F.col(c).try_cast("double").alias(c) if c in NUMERIC_SUMMARY_COLS else F.col(c)
                       for c in df.columns])
