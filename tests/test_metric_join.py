"""Metric-space join and the warm store against loops over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cachescope.operators import metric_join as MJ
from cachescope.operators import vectors as V
from cachescope.sources import store as ST

TYPES = "scope string, id long, vec array<double>"


def clusters(n, dim=8, groups=20, noise=0.02, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    x = centres[rng.integers(0, groups, n)] + noise * rng.normal(size=(n, dim))
    return x * rng.uniform(0.5, 2.0, (n, 1))


def loop(rows, t, metric):
    out = {}
    for s in {r[0] for r in rows}:
        own = [(i, np.array(v, float)) for sc, i, v in rows if sc == s and v and None not in v and np.isfinite(v).all()]
        for i, x in own:
            for j, y in own:
                if j >= i or len(x) != len(y):
                    continue
                if metric == "cosine":
                    if not x.any() or not y.any():
                        continue
                    sim = float((x / np.linalg.norm(x)) @ (y / np.linalg.norm(y)))
                else:
                    sim = 1 - float(((x - y) ** 2).sum()) / 4
                if sim >= t:
                    out[s, i, j] = sim
    return out


@pytest.mark.parametrize("metric,t", [("cosine", 0.9), ("cosine", 0.2), ("distance", 0.9), ("distance", 0.3)])
def test_pairs_equal_loop(spark, metric, t):
    rows = [("a", k, v.tolist()) for k, v in enumerate(clusters(160))]
    rows += [("b", k, v.tolist()) for k, v in enumerate(clusters(50, seed=2))]
    rows += [("a", 900, None), ("a", 901, []), ("a", 902, [1.0, None]), ("a", 903, [0.0] * 8), ("a", 904, [float("nan")] * 8),
             (None, 1, [1.0, 0.0]), (None, 2, [1.0, 0.01]), (None, 3, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, TYPES).repartition(4)
    got = {(r.scope, r.i, r.j): r.sim for r in MJ.metric_pairs(df, t, metric, block_rows=7, cell_rows=10).collect()}
    want = loop(rows, t, metric)
    assert len(want) > 100
    sure = {k for k, v in want.items() if abs(v - t) > 1e-12}
    assert sure <= got.keys() <= want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_every_pair_meets_once_and_cells_prune(spark):
    n = 600
    df = spark.createDataFrame([("a", k, v.tolist()) for k, v in enumerate(clusters(n, groups=30))], TYPES)
    fresh = df.withColumn("fresh", F.lit(True))
    whole = MJ.routed_pairs(fresh, 0.9, block_rows=50, cell_rows=10 ** 6)
    assert whole == n * (n - 1) // 2                                # one cell: all pairs, each once
    assert MJ.routed_pairs(fresh, 0.9, block_rows=50, cell_rows=10) < whole / 5
    assert MJ.routed_pairs(fresh, -1.0, block_rows=50, cell_rows=10) == whole
    pairs = MJ.metric_pairs(df, -1.0, block_rows=50, cell_rows=10)
    assert pairs.count() == pairs.select("i", "j").distinct().count() == whole


def test_groups_are_bounded(spark):
    same = [("a", k, [1.0, 0.001 * k, 0.0]) for k in range(300)]
    d = MJ.routed(spark.createDataFrame(same, TYPES).withColumn("fresh", F.lit(True)), 0.9, block_rows=20, cell_rows=30)
    largest = d.groupBy("cell", "a", "b").count().agg(F.max("count")).first()[0]
    assert largest <= 100


@pytest.mark.parametrize("store,metric", [("misses", "cosine"), ("all", "distance")])
def test_two_halves_with_a_warm_store_equal_the_whole(spark, store, metric):
    x = clusters(200, noise=0.2, seed=3)
    x[150:160] = x[20:30]                                           # copies across the halves
    x[60:65] = x[10:15]
    reqs = spark.createDataFrame([("r", k, v.tolist()) for k, v in enumerate(x)] + [("s", k, x[0].tolist()) for k in range(3)],
                                 "run_id string, seq long, embedding array<double>")
    t = 0.95
    whole = {(r.scope, r.id): (r.reuse_hit, r.served_id, r.similarity and round(r.similarity, 9))
             for r in V.vector_reuse(reqs, t, store=store, metric=metric, block_rows=32).collect()}
    served, warm, got = None, None, {}
    for part in (reqs.where("seq < 100"), reqs.where("seq >= 100")):
        served, added = V.vector_reuse_step(part, t, store=store, metric=metric, block_rows=32, warm=warm)
        got |= {(r.scope, r.id): (r.reuse_hit, r.served_id, r.similarity and round(r.similarity, 9)) for r in served.collect()}
        warm = added if warm is None else warm.unionByName(added)
    assert got == whole and any(v[0] for v in whole.values())


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        V.vector_reuse(spark.createDataFrame([("r", 1, [1.0])], "run_id string, seq long, embedding array<double>"), 0.9, metric="l1")


def test_store_survives_a_second_run_of_a_batch(spark, tmp_path):
    x = clusters(60, groups=6, seed=5)
    reqs = spark.createDataFrame([("r", k, v.tolist()) for k, v in enumerate(x)], "run_id string, seq long, embedding array<double>")
    parts = [reqs.where("seq < 20"), reqs.where("seq between 20 and 39"), reqs.where("seq >= 40")]
    path = str(tmp_path / "store")
    once = [ST.serve_vectors(ST.MissStore(spark, path), k, p, 0.95).collect() for k, p in enumerate(parts)]
    kept = sorted(r.id for r in ST.MissStore(spark, path).entries().collect())
    again = ST.serve_vectors(ST.MissStore(spark, path), 1, parts[1], 0.95)      # a later session repeats a batch
    assert sorted(again.collect()) == sorted(once[1])
    assert sorted(r.id for r in ST.MissStore(spark, path).entries().collect()) == kept
    assert kept == sorted(r.id for rows in once for r in rows if not r.reuse_hit)
    assert ST.MissStore(spark, str(tmp_path / "none")).entries() is None


@pytest.mark.parametrize("metric,warm", [("cosine", False), ("distance", True)])
def test_turns_equal_the_whole(spark, metric, warm):
    x = clusters(240, noise=0.2, seed=4)
    x[100:110], x[200:206], x[207] = x[20:30], x[101:107], x[3]       # copies in other turns
    rows = [("r", 10 + k, v.tolist()) for k, v in enumerate(x)] + [("s", 10 + k, x[0].tolist()) for k in range(90)]
    rows += [("r", k, v) for k in (300, 400, 900) for v in ([0.0] * 8, None)] + [(None, 12, x[0].tolist()), ("r", None, x[1].tolist())]
    rows += [("r", 150, x[5].tolist()), ("r", 151, [1.0] * 8), ("r", 901, [float("nan")] * 8), ("r", 9, [float("nan")] * 8)]
    reqs = spark.createDataFrame(rows, "run_id string, seq long, embedding array<double>")
    old = spark.createDataFrame([("r", 1, x[7].tolist()), ("s", 2, x[8].tolist())],
                                "scope string, id long, embedding array<double>") if warm else None
    got = []
    for turn_rows in (10 ** 6, 40):
        served, added = V.vector_reuse_step(reqs, 0.95, metric=metric, block_rows=32, warm=old, turn_rows=turn_rows)
        got.append((sorted((str(r.scope), r.id or -1, r.reuse_hit, r.served_id or -1, round(r.similarity or 0, 9)) for r in served.collect()),
                    sorted((str(r.scope), r.id or -1, str(r.embedding)) for r in added.collect())))
    assert len(got[0][0]) == len(got[1][0]) >= len(rows)
    assert set(got[0][0]) == set(got[1][0]) and set(got[0][1]) == set(got[1][1])
    assert 20 < sum(r[2] for r in got[0][0]) < len(rows)


def test_vectors_without_clusters_are_sent_as_blocks(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([("a", k, v.tolist()) for k, v in enumerate(rng.normal(size=(600, 32)))], TYPES).withColumn(
        "fresh", F.lit(True))
    sent = MJ.routed(df, 0.3, block_rows=100, cell_rows=20)
    assert sent.count() <= 600 * 6                                    # not once for every cell within reach
    assert MJ.routed_pairs(df, 0.3, block_rows=100, cell_rows=20) == 600 * 599 // 2


def test_a_row_is_sent_as_often_at_any_size(spark):
    df = spark.createDataFrame([("a", k, [1.0, 0.01 * k]) for k in range(400)], TYPES).withColumn("fresh", F.lit(True))
    assert MJ.routed(df, 0.3, block_rows=2, cell_rows=10 ** 6).count() <= 400 * MJ.MAX_BLOCKS
