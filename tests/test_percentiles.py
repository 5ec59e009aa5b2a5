"""Exact percentiles by selection: any distribution, few rows in the last step."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cachescope.operators import metrics as M


def rank(values, p):
    v = sorted(x for x in values if x is not None)
    return v[min(len(v) - 1, max(0, math.ceil(p / 100 * len(v)) - 1))] if v else None


@pytest.mark.parametrize("percents", [(95.0, 99.0), (0.0, 0.001, 50.0, 50.0005, 100.0)])
def test_small_groups_equal_sorting(spark, percents):
    rng = np.random.default_rng(1)
    groups = {f"n{n}": rng.normal(size=n).round(2).tolist() for n in (1, 2, 3, 19, 20, 21, 100, 101, 400)}
    groups |= {"same": [0.5] * 300, "two": [0.0] * 95 + [1.0] * 5, "gaps": [1.0, None, 2.0, None], "none": [None],
               "wide": [10.0 ** k for k in range(-150, 150)], "signed": [-0.0, 0.0, -1.0, 1e308, -1e308]}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r["g"]: r for r in M.nearest_rank(df, ["g"], "v", percents).collect()}
    assert got.keys() == groups.keys() - {"none"}
    for g in got:
        assert [got[g][f"p{p:g}"] for p in percents] == [rank(groups[g], p) for p in percents], g


def test_crowded_values_and_one_outlier(spark):
    """A million distinct values within one percent, and one far away: the last step sees a thousandth of them."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("r").alias("g"), F.when(F.col("id") == 77, 1e9).otherwise(
        1 + F.pmod(F.col("id") * 7_919, F.lit(n)) / (100.0 * n)).alias("v"))
    values = sorted([1 + i * 7_919 % n / (100.0 * n) for i in range(n) if i != 77] + [1e9])
    r = M.nearest_rank(df, ["g"], "v", (50.0, 95.0, 99.0)).first()
    assert [r["p50"], r["p95"], r["p99"]] == [values[math.ceil(p / 100 * n) - 1] for p in (50, 95, 99)]
