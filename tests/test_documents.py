"""Run documents round trip and the summary contract."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cachescope.plans import catalog as C
from cachescope.sources import contract as K
from cachescope.sources import documents as D
from conftest import SF001


def test_documents_round_trip(spark, scratch):
    docs = C.run_documents(spark, SF001)
    raw = f"{scratch}/raw"
    D.write_documents(docs, raw)
    assert sorted(os.listdir(raw)) == sorted(["_temporary", *[f"{r.run_id}.json" for r in docs.collect()]])
    written = {r.run_id: json.loads(r.document) for r in docs.collect()}
    assert all(json.load(open(f"{raw}/{k}.json")) == d for k, d in written.items())
    assert all(("subset" in d["dataset"]) != ("subsets" in d["dataset"]) for d in written.values())
    os.makedirs(f"{raw}/below")
    for stray in ("below/other.json", "notes.txt"):                 # neither is a run document of this folder
        with open(f"{raw}/{stray}", "w") as f:
            f.write("{}")
    with open(f"{raw}/broken.json", "w") as f:
        f.write("{not json")
    with open(f"{raw}/partial.json", "w") as f:
        f.write('{"run_id": "x", "timestamp": null, "model": {"provider": "p", "name": "n"}, "dataset": {}, '
                '"cache": {"mode": "none"}, "metrics": {}, "items": []}')
    summary, rejects = D.aggregate_documents(spark, raw)
    assert summary.count() == docs.count() and len(summary.columns) == 31
    rej = {os.path.basename(r.result_file): r.first_missing for r in rejects.collect()}
    assert rej == {"broken.json": "<invalid json>", "partial.json": "model.params"}
    files = [r.result_file for r in summary.collect()]
    assert files == sorted(files)
    D.write_summary_csv(summary, f"{scratch}/summary")
    back = D.read_summary_csv(spark, f"{scratch}/summary")
    assert back.count() == summary.count()
    assert dict(back.dtypes)["correctness"] == "double"


def test_dataset_label(spark):
    df = spark.createDataFrame([(["a", "b"], None), (None, "c"), (None, None)],
                               "subsets array<string>, subset string")
    got = [r.l for r in df.select(D.dataset_label(F.col("subsets"), F.col("subset")).alias("l")).collect()]
    assert got == ["a,b", "c", "unknown"]


# one broken value for every rule kind, and the violation it must give, on an otherwise right document
GOOD = {"run_id": "a", "timestamp": None, "model": {"provider": "p", "name": "n", "params": {"stop": 1}},
        "dataset": {"name": "d"}, "cache": {"mode": "custom-semantic", "similarity_threshold": 0.5},
        "metrics": {"cache_hit_rate": 1, "bad_cache_hit_rate": 0.0, "cache_accuracy": 0.5, "correctness": 1.0, "latency_mean_sec": 2,
                    "cache_statistics": {"total_queries": 4.0, "cache_hits": 1, "cache_misses": 3, "bad_cache_hits": 0, "good_cache_hits": 1}},
        "items": [{"row_index": 0, "question": "q", "expected": [], "model_output": None, "latency_sec": 0, "cache_hit": True, "correct": False}]}
BREAKS = [
    (("run_id",), "", "run_id", "min_length"), (("run_id",), 5, "run_id", "type"), (("metrics",), None, "metrics", "type"),
    (("cache", "mode"), "weird", "cache.mode", "enum"), (("cache", "size"), 1, "cache.size", "additional"), (("more",), 1, "more", "additional"),
    (("metrics", "cache_hit_rate"), "0.5", "metrics.cache_hit_rate", "type"), (("metrics", "correctness"), None, "metrics.correctness", "type"),
    (("metrics", "latency_mean_sec"), -1, "metrics.latency_mean_sec", "minimum"), (("metrics", "cache_accuracy"), 1.5, "metrics.cache_accuracy", "maximum"),
    (("metrics", "cache_statistics", "hit_rate"), 7, "metrics.cache_statistics.hit_rate", "maximum"),
    (("metrics", "cache_statistics", "unknown"), 7, "metrics.cache_statistics.unknown", "additional"),
    (("metrics", "cache_statistics", "cache_hits"), 1.5, "metrics.cache_statistics.cache_hits", "type"),
    (("items",), "none", "items", "type"), (("items", 0, "cached"), True, "items[].cached", "additional"),
    (("items", 0, "correct"), "yes", "items[].correct", "type"), (("items", 0, "latency_sec"), -0.5, "items[].latency_sec", "minimum"),
    (("cache", "mode"), ..., "cache.mode", "required"), (("items", 0, "question"), ..., "items[].question", "required")]


def broken(path, value):
    doc = json.loads(json.dumps(GOOD))
    at = doc
    for p in path[:-1]:
        at = at[p]
    if value is ...:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return json.dumps(doc)


def test_each_contract_rule_fires(spark):
    docs = [(-1, json.dumps(GOOD)), (-2, "{"), (-3, "[]"), (-4, None)] + [(k, broken(p, v)) for k, (p, v, *_) in enumerate(BREAKS)]
    got = {}
    for r in K.contract_violations(spark.createDataFrame(docs, "k int, document string"), K.WRITTEN).collect():
        got.setdefault(r.k, []).append((r.path, r.kind))
    assert got.pop(-2) == got.pop(-4) == [("", "type")] and got.pop(-3) == [("", "type")]
    assert got == {k: [(path, kind)] for k, (_, _, path, kind) in enumerate(BREAKS)}


def test_contract_rules_are_a_table(spark):
    for layout in (K.DECLARED, K.WRITTEN):
        t = K.rule_table(spark, layout)
        assert t.columns == ["path", "kind", "argument"] and t.count() == len(K.rules(layout))
    assert ("metrics", "additional") in {(r.path, r.kind) for r in t.collect()}


def test_named_run_files(spark, scratch):
    docs = spark.createDataFrame([("002", 7, '{"é": 1}'), ("003", 8, None)], "run_id string, seed int, document string")
    D.write_documents(docs.repartition(2), f"{scratch}/out", "smoke-{run_id}-{seed}.json")
    assert open(f"{scratch}/out/smoke-002-7.json", encoding="utf-8").read() == '{"é": 1}'
    assert open(f"{scratch}/out/smoke-003-8.json").read() == ""
    D.write_documents(docs.where("run_id = '002'"), f"{scratch}/out", "smoke-{run_id}.json")
    assert sorted(os.listdir(f"{scratch}/out")) == ["_temporary", "smoke-002-7.json", "smoke-002.json", "smoke-003-8.json"]
    assert os.listdir(f"{scratch}/out/_temporary") == []


def test_run_files_of_one_name_fail_the_job(spark, scratch):
    docs = spark.createDataFrame([("a", "1"), ("a", "2")], "run_id string, document string")
    with pytest.raises(Exception, match="several documents"):
        D.write_documents(docs, f"{scratch}/out")
    with pytest.raises(Exception, match="not a file name"):
        D.write_documents(docs, f"{scratch}/out", "../{run_id}.json")
    assert not [f for f in os.listdir(f"{scratch}/out") if f.endswith(".json")]
