"""D1 / E1 / E2 against golden sequences and an independent sequential loop."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cachescope.functions.text import final_number, normalize_text
from cachescope.operators.hits import detect_hits, hit_sources
from cachescope.operators.metrics import hit_stats, latency_stats, run_metrics
from cachescope.sources.tables import request_log
from conftest import SF001

TRACKER_ROWS = [(0.05, "2+2", "4", "4"), (0.03, "3+3", "7", "6"), (0.2, "4+4", "8", "8"),
                (0.02, "5+5", "10", "10"), (0.01, "6+6", "13", "12"), (0.3, "7+7", "15", "14")]


def test_tracker_golden(spark):
    log = spark.createDataFrame(
        [("r", i, p, resp, lat, [gold]) for i, (lat, p, resp, gold) in enumerate(TRACKER_ROWS)],
        "run_id string, seq long, prompt string, response string, latency_sec double, expected array<string>")
    h = detect_hits(log).orderBy("seq").collect()
    assert [r.cache_hit for r in h] == [True, True, False, True, True, False]
    s = hit_stats(detect_hits(log)).first()
    assert (s.total_queries, s.cache_hits, s.cache_misses, s.bad_cache_hits, s.good_cache_hits) == (6, 4, 2, 2, 2)
    assert math.isclose(s.hit_rate, 4 / 6) and s.bad_hit_rate == 0.5 and s.cache_accuracy == 0.5


def test_latency_stats_golden(spark):
    log = spark.createDataFrame([("r", x) for x in (0.1, 0.2, 0.3, 0.4, 0.5)], "run_id string, latency_sec double")
    r = latency_stats(log).first()
    assert math.isclose(r.latency_mean_sec, 0.3) and r.latency_p95_sec == 0.5 and r.latency_p99_sec == 0.5


def _same(a, b):
    """Equal answers from (number, normalised text) pairs that the golden-tested columns produced."""
    if a[0] is not None and b[0] is not None:
        return abs(a[0] - b[0]) <= 1e-6
    return a[1] == b[1]


def test_detect_hits_equals_sequential_loop(spark):
    log = request_log(spark, SF001)
    rows = log.select("run_id", "seq", "prompt", "latency_sec", F.struct(
        final_number("response"), normalize_text("response")).alias("response")).collect()
    want = {}
    by_run = {}
    for r in sorted(rows, key=lambda r: (r.run_id, r.seq)):
        by_run.setdefault(r.run_id, []).append(r)
    for run, reqs in by_run.items():
        for i, r in enumerate(reqs):
            src = None
            for j, p in enumerate(reqs[:i]):
                if _same(r.response, p.response) and r.latency_sec < max(0.25, p.latency_sec * 0.7):
                    kind = "exact_match_query_" if r.prompt == p.prompt else "semantic_match_query_"
                    src = f"{kind}{j}"
                    break
            if src is None and r.latency_sec < 0.1:
                src = "timing_based"
            want[(run, r.seq)] = src
    got = {(r.run_id, r.seq): r.hit_source for r in detect_hits(log).select("run_id", "seq", "hit_source").collect()}
    assert got == want
    kinds = {(r.run_id, r.source_kind): r.hits for r in hit_sources(detect_hits(log)).collect()}
    assert sum(kinds.values()) == sum(v is not None for v in want.values())


def _loop(rows):
    """(run, seq) -> position of the source, or None: the sequential rule over (run, seq, prompt, answer, latency)."""
    want, runs = {}, {}
    for r in sorted(rows, key=lambda r: r[1]):
        earlier = runs.setdefault(r[0], [])
        want[r[0], r[1]] = next((k for k, p in enumerate(earlier) if r[3] is not None and p[3] is not None
                                 and r[4] is not None and p[4] is not None and abs(float(r[3]) - float(p[3])) <= 1e-6
                                 and r[4] < max(0.25, 0.7 * p[4])), None)
        earlier.append(r)
    return want


@pytest.mark.parametrize("direct,chunk_rows", [(64, 1 << 18), (64, 7), (0, 1 << 18), (0, 7), (3, 20)])
def test_long_classes_are_swept(spark, direct, chunk_rows):
    """Rising latencies make every row a possible source; crowded and equal ones, values 4e-7 apart, gaps in ``seq``."""
    rng = np.random.default_rng(5)
    lat = {"rising": [0.3 * 1.02 ** k for k in range(150)], "crowded": (1 + rng.random(150) * 1e-9).tolist(),
           "equal": [0.2, 2.0] * 75, "mixed": [None if k % 9 == 0 else float(x) for k, x in enumerate(rng.exponential(1.0, 150))]}
    rows = []
    for run, lats in lat.items():
        lats = lats[:120] + [x and x * 0.5 for x in lats[:30]]
        for k, x in enumerate(lats):
            answer = None if k % 17 == 16 else f"{7 + (k % 4) * 4e-7:.8f}" if k % 3 else "3"
            rows.append((run, k * k + (10 ** 12 if k > 140 else 0), f"p{k % 5}", answer, x))
    log = spark.createDataFrame(rows, "run_id string, seq long, prompt string, response string, latency_sec double")
    h = detect_hits(log.repartition(5), chunk_rows=chunk_rows, with_grade=False, carry=(), direct=direct)
    assert {(r.run_id, r.seq): r.src_pos for r in h.collect()} == _loop(rows)
    assert h.columns == ["run_id", "seq", "latency_sec", "pos", "cache_hit", "hit_source", "src_pos", "src_seq"]


def test_requests_without_a_run_form_one(spark):
    rows = [(run, k, "p", "4", x) for run in (None, "a") for k, x in enumerate([3.0, 1.0, 0.2])]
    h = detect_hits(spark.createDataFrame(
        rows, "run_id string, seq long, prompt string, response string, latency_sec double"), with_grade=False)
    assert sorted((r.run_id or "", r.seq, r.pos) for r in h.collect()) == [
        (g, k, k) for g in ("", "a") for k in range(3)]


def test_run_metrics_invariants(spark):
    m = run_metrics(detect_hits(request_log(spark, SF001))).collect()
    for r in m:
        assert r.cache_hits + r.cache_misses == r.total_queries
        assert r.good_cache_hits + r.bad_cache_hits == r.cache_hits
        assert 0 <= r.correctness <= 1 and r.latency_p95_sec <= r.latency_p99_sec
        assert math.isclose(r.reliability_degradation, r.bad_cache_hits / r.total_queries)


def test_summary_formulas_on_published_rows(spark):
    # Fixed values: (correctness, hit rate, accuracy, total, hits, bad) of three published runs and
    # their derived degradation, effectiveness, correctness without bad hits.
    rows = [(0.79, 0.395, 0.4936708860759494, 200, 79, 40, 0.2, 0.195, 0.99),
            (0.59, 0.72, 0.4375, 200, 144, 81, 0.405, 0.315, 0.995),
            (0.965, 0.105, 1.0, 200, 21, 0, 0.0, 0.105, 0.965)]
    from cachescope.operators.metrics import reliability
    df = spark.createDataFrame([r[:6] for r in rows], "correctness double, cache_hit_rate double, "
                               "cache_accuracy double, total_queries long, cache_hits long, bad_cache_hits long")
    got = reliability(df).collect()
    for g, r in zip(got, rows):
        assert math.isclose(g.reliability_degradation, r[6], abs_tol=1e-9)
        assert math.isclose(g.cache_effectiveness, r[7], abs_tol=1e-9)
        assert math.isclose(g.correctness_without_bad_hits, r[8], abs_tol=1e-9)


def test_prompts_go_through_shuffles_as_digest_bytes(spark, monkeypatch):
    from cachescope.operators import hits as H
    seen = []
    cut = H.cut_lineage
    monkeypatch.setattr(H, "cut_lineage", lambda df: seen.append(df.schema) or cut(df))
    log = spark.createDataFrame(
        [("r", 0, "p", "a", 0.5), ("r", 1, "p", "a", 0.2), ("r", 2, "q", "a", 0.2), ("r", 3, None, "a", 0.2)],
        "run_id string, seq long, prompt string, response string, latency_sec double")
    got = {r.seq: r.hit_source for r in detect_hits(log, with_grade=False).collect()}
    assert got == {0: None, 1: "exact_match_query_0", 2: "semantic_match_query_0", 3: "semantic_match_query_0"}
    kinds = {f.name: f.dataType.simpleString() for schema in seen for f in schema}
    assert kinds["prompt_h"] == kinds["src_prompt_h"] == "binary"
