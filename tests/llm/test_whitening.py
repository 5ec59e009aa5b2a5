"""Whitening against a plain numpy evaluation in exact integers."""

import math

import numpy as np
from pyspark.sql import functions as F

from cachescope.llm import whitening as W

SF01 = "/root/testdata/sf0.01"
TYPES = "vec_id long, embedding array<float>, label int"


def usable(vectors, d):
    return [(i, v) for i, v in vectors if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]


def check(rows, vectors, d, components=32):
    good = usable(vectors, d)
    n = len(good)
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in good], object)
    s = x.sum(0)
    t = n * x - s
    v = np.array((t.T @ t).tolist(), float) / n ** 3
    e = np.sort(np.linalg.eigvalsh(v))[::-1]
    k = min(components, int((e > 1e-11 * e[0]).sum()))
    assert len(rows) == n * k and {r["n"] for r in rows} == {n}
    assert sorted(set((r["vec_id"], r["deviation"]) for r in rows), key=str) == sorted(
        set((i, int(sum(c * c for c in row))) for (i, _), row in zip(good, t.tolist())), key=str)
    by = {(r["vec_id"], r["component"]): r for r in rows}
    ids = [i for i, _ in good]
    assert len(set(ids)) == n and sorted(c for i, c in by if i == ids[0]) == list(range(1, k + 1))
    z = np.array([[by[i, c]["whitened"] for c in range(1, k + 1)] for i in ids])
    assert np.abs(z.T @ z / n - np.outer(z.mean(0), z.mean(0)) - np.eye(k)).max() < 1e-6
    c = t.astype(float) / n
    for m in range(k):
        assert abs(by[ids[0], m + 1]["explained"] / (e[m] / e.sum()) - 1) < 1e-6
        u = c.T @ z[:, m] / n / np.sqrt(e[m])           # the component itself, if z is a projection on it
        assert abs(np.linalg.norm(u) - 1) < 1e-6
        assert np.linalg.norm(v @ u - e[m] * u) < 1e-6 * e[0]
        assert np.abs(c @ u / np.sqrt(e[m]) - z[:, m]).max() < 1e-6
    assert max(r["identity_error"] for r in rows) == min(r["identity_error"] for r in rows) < 1e-6


def test_planes_and_scatter():
    rng = np.random.default_rng(2)
    for bits, rows in ((1, 5), (7, 200), (33, 130)):
        y = rng.integers(0, 1 << bits, (rows, 4))
        acc = np.zeros(((2 * bits - 2) // W.LIMB + 1, 4, 4), np.int64)
        W.add_scatter(acc, y[:65], bits)
        W.add_scatter(acc, y[65:], bits)
        for i in range(4):
            for j in range(i, 4):
                got = sum(int(acc[m, i, j]) << (W.LIMB * m) for m in range(len(acc)))
                assert got == sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j]))


def test_whiten_table(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet").withColumn("n", F.lit("clash")).withColumn("component", F.lit("x"))
    check(W.whiten(df).collect(), [(r["vec_id"], r["embedding"]) for r in df.collect()], 64)


def test_awkward_rows(spark):
    rng = np.random.default_rng(4)
    good = [(k, rng.normal(size=3).astype(np.float32).tolist(), 0) for k in range(40)]
    bad = [(100, None, 0), (101, [], 0), (102, [1.0, None, 2.0], 0), (103, [1.0, float("nan"), 0.0], 0),
           (104, [float("inf"), 0.0, 0.0], 0), (105, [1.0, 2.0], 0), (None, [0.5, -0.25, 4.0], None), (107, [-3000.0, 9.0, 1.0], 0)]
    rows = good + bad
    check(W.whiten(spark.createDataFrame(rows, TYPES).repartition(5)).collect(), [(i, v) for i, v, _ in rows], 3)
    # repeated rows count and are returned one by one
    assert W.whiten(spark.createDataFrame(good + good, TYPES)).count() == 80 * 3
    # one dimension without variance and one that repeats another: two components are left
    flat = [(i, [v[0], 1.0, v[0], v[1]], 0) for i, v, _ in good]
    assert {r["component"] for r in W.whiten(spark.createDataFrame(flat, TYPES)).collect()} == {1, 2}


def test_nothing_to_whiten(spark):
    assert W.whiten(spark.createDataFrame([], TYPES)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None, 0), (2, [None], 0)], TYPES)).count() == 0
    assert W.whiten(spark.createDataFrame([(k, [1.0, 2.0], 0) for k in range(5)], TYPES)).count() == 0


def test_wide_entries(spark):
    rows = [(k, [float(k) * 1e12, 3e38 if k % 2 else -3e38], 0) for k in range(6)]
    out = W.whiten(spark.createDataFrame(rows, TYPES)).collect()
    assert len(out) == 12 and {r["deviation"] for r in out} == {None}
    assert max(r["identity_error"] for r in out) < 1e-6
