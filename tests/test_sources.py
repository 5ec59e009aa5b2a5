"""Item files and configuration documents: A1, A2, A7, E14."""

import json

from pyspark.sql import functions as F

from cachescope.functions.grading import grade
from cachescope.operators import items as I
from cachescope.operators import metrics as M
from cachescope.sources import configs as CF
from cachescope.sources import items as SI

# the three-row sample: ragged question and target fields
SAMPLE = [{"platinum_prompt": "What is 6 * 7?", "platinum_target": "42"},
          {"question": "If John has 42 apples, how many apples?", "answer": "42"},
          {"statement": "The answer is 42.", "target": "42"}]


def lay_out(tmp_path, subset, split, name, lines):
    folder = tmp_path / f"subset={subset}" / f"split={split}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_sample_rows_are_read_and_graded(spark, tmp_path):
    lay_out(tmp_path, "tiny", "test", "a.jsonl", [json.dumps(r) for r in SAMPLE])
    items, rejects = SI.read_json_items(spark, str(tmp_path), number_lines=True)
    assert items.columns == SI.ITEM_COLUMNS and rejects.count() == 0
    graded = items.select("item_idx", I.pick_question(items).alias("q"), grade(I.expected_answers(), F.lit("Answer: 42")).alias("ok"))
    assert [(r.item_idx, r.q, r.ok) for r in graded.orderBy("item_idx").collect()] == [
        (0, SAMPLE[0]["platinum_prompt"], True), (1, SAMPLE[1]["question"], True), (2, SAMPLE[2]["statement"], True)]


def test_ragged_fields_and_bad_lines(spark, tmp_path):
    lay_out(tmp_path, "x", "test", "b.jsonl", [
        '{"platinum_target": ["a", 7, null], "choices": ["p", "q"], "answer": 1}', '{"platinum_target": 3.5, "answers": {"text": ["t"]}}',
        "", '{"platinum_target": null, "label": true}', '{"platinum_target": []}', "{broken", "[1]", '"text"', "null"])
    lay_out(tmp_path, "x", "test", "a.jsonl", ['{"item_idx": 50, "answers": {"text": "one"}}', "{}"])
    lay_out(tmp_path, "x", "train", "a.jsonl", ['{"question": "other split"}'])
    items, rejects = SI.read_json_items(spark, str(tmp_path), number_lines=True)
    got = {r.item_idx: r for r in items.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 50]                       # places run over the files by name
    assert got[2].platinum_target == ["a", "7", None] and got[2].choices == ["p", "q"] and got[2].answer == "1"
    assert got[3].platinum_target == ["3.5"] and got[3].answers.text == ["t"]
    assert got[4].platinum_target is None and got[4].label == "true" and got[5].platinum_target == []
    assert got[50].answers.text == ["one"] and got[1].answers is None
    assert sorted((r.line, r.reason) for r in rejects.collect()) == [
        ('"text"', "not an object"), ("[1]", "not an object"), ("null", "not an object"), ("{broken", "not JSON")]


def test_folders_are_pruned(spark, tmp_path):
    for s in ("a", "b", "c"):
        for split in ("test", "train"):
            lay_out(tmp_path / "json", s, split, "f.jsonl", [json.dumps({"item_idx": 1, "question": f"{s} {split}"})])
    items, _ = SI.read_json_items(spark, str(tmp_path / "json"), ["b"])
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "subset" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.question for r in items.collect()] == ["b test"]
    every, _ = SI.read_json_items(spark, str(tmp_path / "json"), split=None)
    SI.write_items(every.drop("source_file"), str(tmp_path / "parquet"))
    runs = spark.createDataFrame([("r", ["c", "a"]), ("s", ["c"])], "run_id string, subsets array<string>")
    asked = SI.items_of_runs(SI.read_parquet_items(spark, str(tmp_path / "parquet"), split="train"), runs)
    assert sorted(r.question for r in asked.collect()) == ["a train", "c train"]
    assert "dynamicpruning" in asked._jdf.queryExecution().executedPlan().toString()


def test_parquet_of_other_types(spark, tmp_path):
    spark.createDataFrame([("a", "test", "3", 5), ("a", "test", None, 6)],
                          "subset string, split string, platinum_target string, label int").coalesce(1).write.partitionBy(
        "subset", "split").parquet(str(tmp_path / "items"))
    rows = SI.read_parquet_items(spark, str(tmp_path / "items")).orderBy("item_idx").collect()
    assert [(r.item_idx, r.platinum_target, r.label, r.options) for r in rows] == [(0, ["3"], "5", None), (1, None, "6", None)]


def test_configurations(spark, tmp_path):
    docs = {
        "a.json": {"run": {"id": "full", "seed": 7}, "model": {"name": "m", "params": {"temperature": 0.5, "stop": "x"}},
                   "dataset": {"subsets": ["p", "q"], "slice": {"start": 3, "limit": 40}},
                   "cache": {"mode": "custom-semantic", "similarity_threshold": 0.9, "embedding_model": "mpnet"}},
        "b.json": {"run": {"id": "empty"}, "dataset": {"subset": "squad"}},
        "c.json": {"run": {"id": "odd", "sed": 1}, "dataset": {"slice": 4, "subsets": []}, "cache": {"mode": "lru", "capacity": "many"},
                   "model": {"provider": "else"}, "zeta": 1}}
    for name, d in docs.items():
        (tmp_path / name).write_text(json.dumps(d))
    (tmp_path / "d.json").write_text("{")
    (tmp_path / "notes.txt").write_text("not a configuration")
    configs = CF.read_configs(spark, str(tmp_path))
    assert configs.count() == 4
    got = {r.run_id: r for r in CF.resolve_configs(configs).collect()}
    full = got["full"]
    assert (full.seed, full.subsets, full.slice_start, full.slice_limit, full.cache_mode, full.similarity_threshold) == (
        7, ["p", "q"], 3, 40, "custom_semantic", 0.9)
    assert full.params == {"temperature": "0.5", "stop": "x"} and full.split == "test" and full.output_dir == "results/raw"
    empty = got["empty"]
    assert (empty.model_provider, empty.dataset_name, empty.subsets, empty.slice_limit, empty.cache_mode, empty.params) == (
        "ollama", "platinum-bench", ["squad"], 10, "none", None)
    assert got["odd"].subsets == ["gsm8k"] and got["odd"].capacity is None
    problems = {(r.run_id, r.problem) for r in CF.config_problems(configs).collect()}
    assert problems == {("odd", "unknown:run.sed"), ("odd", "unknown:zeta"), ("odd", "type:dataset.slice"),
                        ("odd", "type:cache.capacity"), ("odd", "unsupported:cache.mode:lru"),
                        ("odd", "unsupported:model.provider:else"), (None, "not a JSON object")}


def test_configured_metrics_keeps_both_sides(spark):
    runs = spark.createDataFrame([("a", "none"), ("idle", "none")], "run_id string, cache_mode string")
    metrics = spark.createDataFrame([("a", 4, 0.5), ("stray", 2, 1.0)], "run_id string, total_queries long, correctness double")
    got = {r.run_id: tuple(r)[1:] for r in M.configured_metrics(runs, metrics).collect()}
    assert got == {"a": ("none", 4, 0.5, False, False), "idle": ("none", 0, 0.0, True, False),
                   "stray": (None, 2, 1.0, False, True)}
