"""U1 strategy registry, U2 encoder, U3 answer functions."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cachescope.operators import reuse as U
from cachescope.operators import vectors as V
from cachescope.operators.answers import answer_from_log, answer_with
from cachescope.operators.vectors import embed_text
from cachescope.plans.registry import apply_strategy, available_strategies, load_strategy


def test_load_strategy():
    assert set(available_strategies()) >= {"none", "vanilla_exact", "custom_semantic", "vanilla_approx", "extended"}
    assert load_strategy("vanilla-exact") is load_strategy("vanilla_exact")
    assert load_strategy(None) is load_strategy("none")
    with pytest.raises(ValueError, match="Available strategies: .*vanilla_exact"):
        load_strategy("missing_strategy")


def test_strategies_run(spark):
    reqs = spark.createDataFrame([("r", 1, "what is two plus two"), ("r", 2, "what is two plus two"),
                                  ("r", 3, "something else entirely")], "run_id string, seq long, prompt string")
    exact = {r.seq: r.reuse_hit for r in apply_strategy(reqs, {"mode": "vanilla_exact"}).collect()}
    assert exact == {1: False, 2: True, 3: False}
    sem = {r.seq: r.reuse_hit for r in apply_strategy(reqs, {"mode": "custom_semantic",
                                                             "similarity_threshold": 0.9}).collect()}
    assert sem == {1: False, 2: True, 3: False}
    with pytest.raises(ValueError, match="Unknown looseness preset 'x'"):
        apply_strategy(reqs, {"mode": "extended", "looseness_preset": "x"})


def test_answer_functions(spark):
    plan = spark.createDataFrame([("r", 0, 7, "What is 6 * 7?"), ("r", 1, 8, None)],
                                 "run_id string, seq long, item_idx long, question string")
    out = answer_with(plan, lambda q: "Answer: 42").orderBy("seq").collect()
    assert out[0].response == "Answer: 42" and out[0].latency_sec >= 0 and out[1].response is None
    logged = spark.createDataFrame([(7, "Answer: 42", 1.5)], "item_idx long, response string, latency_sec double")
    got = answer_from_log(plan, logged).orderBy("seq").collect()
    assert got[0].response == "Answer: 42" and got[1].response is None


def test_embed_text(spark):
    docs = spark.createDataFrame([("a b c",), ("a b d",), ("x y z",)], "prompt string")
    e = embed_text(docs, dim=32).collect()
    assert all(len(r.embedding) == 32 for r in e)
    assert abs(sum(x * x for x in e[0].embedding) - 1.0) < 1e-5


def test_vanilla_approx_is_semantic_reuse_at_its_default(spark):
    texts = ["red green blue", "red green blue", "red green black", "one two three", "red green blue four", "red green blue"]
    reqs = spark.createDataFrame([("r", k, t) for k, t in enumerate(texts)], "run_id string, seq long, prompt string")
    cols = ["seq", "reuse_hit", "served_seq"]
    got = sorted(map(tuple, apply_strategy(reqs, {"mode": "vanilla-approx"}).select(*cols).collect()))
    want = U.semantic_reuse(reqs, 0.75).selectExpr("id AS seq", "reuse_hit", "served_id AS served_seq")
    assert got == sorted(map(tuple, want.collect())) and (1, True, 0) in got


def test_encoders_by_name(spark, monkeypatch):
    reqs = spark.createDataFrame([("r", 0, "aaa"), ("r", 1, "bb"), ("r", 2, "aab"), ("r", 3, "zzzz")],
                                 "run_id string, seq long, prompt string")

    @F.pandas_udf("array<float>")
    def letters(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [float(t.count(c)) for c in "abz"])

    monkeypatch.setitem(V.ENCODERS, "letters", letters)
    cfg = {"mode": "custom_semantic", "similarity_threshold": 0.85, "embedding_model": "letters"}
    got = {r.seq: r.served_seq for r in apply_strategy(reqs, cfg).collect()}
    assert got == {0: None, 1: None, 2: 0, 3: None}
    with pytest.raises(ValueError, match="Unknown encoder 'nope'"):
        apply_strategy(reqs, {**cfg, "embedding_model": "nope"})
    runs = spark.createDataFrame([("a", "custom_semantic", "nope"), ("b", "custom_semantic", "mpnet"), ("c", "none", "nope")],
                                 "run_id string, cache_mode string, embedding_model string")
    assert [r.run_id for r in U.unknown_encoders(runs).collect()] == ["a"]
