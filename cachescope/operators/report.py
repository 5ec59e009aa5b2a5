"""Run comparison tables: B8, D9, E7-E11.

These read the per-run summary (one row per run), so they are small; they are
still plain grouped aggregates so that a summary of millions of runs works.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachescope.session import cut_lineage

def cached_runs(summary: DataFrame) -> DataFrame:
    """Runs with a cache."""
    return summary.where(F.col("cache_mode") != "none")


def nocache_runs(summary: DataFrame) -> DataFrame:
    """No-cache baseline runs."""
    return summary.where(F.col("cache_mode") == "none")


def vs_baseline(summary: DataFrame) -> DataFrame:
    """Each cached run beside the mean correctness / latency of the no-cache runs.

    The baseline is a scalar subquery (evaluated once, no join)."""
    base = nocache_runs(summary)
    c = base.select(F.avg("correctness")).scalar()
    lat = base.select(F.avg("latency_mean_sec")).scalar()
    return cached_runs(summary).select(
        "run_id", "embedding_model", "similarity_threshold", "correctness", "latency_mean_sec",
        c.alias("baseline_correctness"), lat.alias("baseline_latency_mean_sec"),
        (F.col("correctness") - c).alias("correctness_change"),
        (F.col("latency_mean_sec") / lat - 1.0).alias("latency_change"))


def subset_report(graded: DataFrame, by: str = "subset") -> DataFrame:
    """Correct, total, accuracy %, mean latency per subset plus an overall row."""
    r = graded.rollup(by).agg(
        F.count_if(F.col("correct")).alias("correct"),
        F.count(F.lit(1)).alias("total"),
        F.avg("latency_sec").alias("avg_latency_sec"),
        F.grouping_id().alias("_g"))
    return r.select(
        F.when(F.col("_g") == 1, F.lit("OVERALL")).otherwise(F.col(by)).alias(by),
        "correct", "total",
        F.when(F.col("total") > 0, 100.0 * F.col("correct") / F.col("total")).otherwise(0.0).alias("accuracy_pct"),
        "avg_latency_sec")


MODEL_THRESHOLD_METRICS = ["correctness", "latency_mean_sec", "cache_accuracy", "good_cache_hits",
                           "cache_hits", "bad_cache_hit_rate", "bad_cache_hits"]


def by_model_threshold(summary: DataFrame, metrics: Sequence[str] = MODEL_THRESHOLD_METRICS) -> DataFrame:
    """Metric means by encoder and threshold; cached runs, NULL keys dropped."""
    s = cached_runs(summary).where(F.col("embedding_model").isNotNull()
                                   & F.col("similarity_threshold").isNotNull())
    return s.groupBy("embedding_model", "similarity_threshold").agg(
        *[F.avg(m).alias(m) for m in metrics])


def _tag(v: float) -> str:
    return f"{v:g}".replace(".", "_").replace("-", "m")


def pivot_model_threshold(summary: DataFrame, thresholds: Sequence[float] | None = None) -> DataFrame:
    """Encoders x thresholds; hit counts truncated to int as in the chart labels.

    Without ``thresholds`` every threshold of the summary gets its columns (their
    number is checked by Spark's ``spark.sql.pivotMaxValues``); the means, a row for
    each encoder and threshold, are written first, so the summary is evaluated once.
    """
    g = by_model_threshold(summary)
    if thresholds is None:
        g = cut_lineage(g)
        limit = int(summary.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = g.select("similarity_threshold").distinct()
        thresholds = sorted(r[0] for r in found.limit(limit + 1).collect())
        if len(thresholds) > limit:
            raise ValueError(f"more than {limit} thresholds; use by_model_threshold instead")
    p = g.groupBy("embedding_model").pivot("similarity_threshold", list(thresholds)).agg(
        F.first("correctness").alias("correctness"),
        F.first("cache_accuracy").alias("cache_accuracy"),
        F.first("bad_cache_hit_rate").alias("bad_cache_hit_rate"),
        F.first(F.col("good_cache_hits").cast("long")).alias("good_hits"),
        F.first(F.col("bad_cache_hits").cast("long")).alias("bad_hits"),
        F.first(F.col("cache_hits").cast("long")).alias("total_hits"))
    ren = {}
    for t in thresholds:
        for c in p.columns:
            pre = f"{t}_"
            if c.startswith(pre):
                ren[c] = f"{c[len(pre):]}_{_tag(t)}"
    return p.select(*[F.col(f"`{c}`").alias(ren.get(c, c)) for c in p.columns])


def by_model(summary: DataFrame) -> DataFrame:
    """Four metric means by encoder (cached runs)."""
    s = cached_runs(summary).where(F.col("embedding_model").isNotNull())
    return s.groupBy("embedding_model").agg(
        F.avg("correctness").alias("correctness"), F.avg("latency_mean_sec").alias("latency_mean_sec"),
        F.avg("cache_hit_rate").alias("cache_hit_rate"), F.avg("cache_accuracy").alias("cache_accuracy"))


def run_inventory(summary: DataFrame, cols: Sequence[str] = ("cache_mode", "model_name", "embedding_model")) -> DataFrame:
    """Sorted distinct values (modes, models, encoders) as comma-joined text, of the columns that are there."""
    cols = [c for c in cols if c in summary.columns]
    return summary.agg(*[F.array_join(F.array_sort(F.collect_set(c)), ",").alias(f"{c}s") for c in cols])
