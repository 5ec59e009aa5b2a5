"""Quality classifier: features and scores against a plain version, gradients against differences, held-out accuracy."""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cachescope.llm import classifier as C
from cachescope.llm.common import utf8

SF01 = "/root/testdata/sf0.01"
BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    """The features of one text as Python values, by kind."""
    w = BLANKS.findall(text or "")
    out = [("w", "=" if k and w[k - 1] == x else x) for k, x in enumerate(w)]
    out += [("p", "=" if a == b else (a, b)) for a, b in zip(w, w[1:])]
    line = " " + " ".join(w) + " " if w else ""
    out += [(2, line[k:k + 2]) for k in range(len(line) - 1)]
    out += [(3, line[k:k + 3]) for k in range(len(line) - 2) if line[k + 1] != " "]
    return out


TEXTS = ["a a b a", "Ünï\n\tcode  é中 𝒳 x", "", " \n ", None, "one", "x " * 2000, "ab\x00c ###  \x85y", "ab\x00c ###  \x85y"]


def test_features_match_a_plain_version():
    data, at = utf8(pa.array(TEXTS))
    rows, buckets = [], []
    for b, r in C.features(data, at):
        buckets += b.tolist()
        rows += r.tolist()
    for k, t in enumerate(TEXTS):
        own = sorted(b for b, r in zip(buckets, rows) if r == k)
        want = grams(t)
        assert len(own) == len(want)
        part, single = utf8(pa.array([t]))
        alone = sorted(b for bs, _ in C.features(part, single) for b in bs.tolist())
        assert alone == own                                    # rows do not touch each other
        assert len(set(own)) <= len(set(want))
    assert {b for b, r in zip(buckets, rows) if r == 7} == {b for b, r in zip(buckets, rows) if r == 8}


def test_gradient_step_descends():
    rng = np.random.default_rng(0)
    examples = []
    for k in range(300):
        y = k % 2
        own = rng.choice(np.arange(50) + 50 * y, 6, replace=False)
        common = rng.choice(np.arange(200, 400), 10, replace=False)
        i = np.sort(np.r_[own, common])
        examples.append((i, np.full(16, 1 / 16), y))
    v, soft, bias = C.sgd(examples[:200], 6)
    z = np.array([x @ v[i] @ (soft[1] - soft[0]) + bias[1] - bias[0] for i, x, _ in examples[200:]])
    assert (np.sign(z) == np.array([2 * y - 1 for *_, y in examples[200:]])).all()
    again = C.sgd(examples[:200], 6)
    assert all(np.array_equal(a, b) for a, b in zip((v, soft, bias), again))


def test_held_out_accuracy_and_scores(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    docs = docs.withColumn("quality", F.lit("clash")).withColumn("score", F.lit("clash"))
    rows = {r["doc_id"]: r for r in C.score_quality(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows.values())
    held = [(rows[x["doc_id"]], x["quality"]) for x in labels.collect() if x["doc_id"] in rows and rows[x["doc_id"]]["held_out"]]
    good, bad = [r for r, q in held if q == 1], [r for r, q in held if q == 0]
    assert sum(r["predicted"] for r in good) >= 0.98 * len(good)
    assert np.mean([a["score"] > b["score"] for a in good for b in bad]) > 0.97
    # a document's score is the softmax of the mean of its features' logits
    model = C.train(docs, labels)
    for d in docs.limit(20).collect():
        part, at = utf8(pa.array([d["text"]]))
        hit = np.concatenate([b for b, _ in C.features(part, at)] or [np.zeros(0, int)])
        z = (model.logit[hit].mean() if len(hit) else 0.0) + model.bias
        assert abs(1 / (1 + math.exp(-z)) - rows[d["doc_id"]]["score"]) < 1e-9


def test_held_out_labels_are_never_learned(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    turned = labels.withColumn("quality", F.when(C.remainder("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = C.train(docs, labels), C.train(docs.drop("lang", "source"), turned)
    assert np.array_equal(a.logit, b.logit) and a.bias == b.bias


def test_awkward_rows(spark, docs, labels):
    strange = labels.unionByName(spark.createDataFrame([(None, 1, 0), (7, None, 0), (8, 5, 0), (904, 0, 0), (904, 1, 0)], labels.schema))
    out = C.score_quality(docs, strange).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    blank = {r["score"] for r in out if r["doc_id"] in (900, 901, 902)}
    assert len(blank) == 1
    assert len({r["score"] for r in out if r["doc_id"] == 904}) == 1
    one = C.score_quality(docs, labels.where("quality = 1"))
    n = C.learnable(labels.where("quality = 1")).count()
    assert {round(r["score"], 9) for r in one.collect()} == {round((n + 1) / (n + 2), 9)}
    assert {r["score"] for r in C.score_quality(docs, labels.where("false")).collect()} == {0.5}
    assert C.score_quality(docs.where("false"), labels).count() == 0


def test_sample_is_bounded(spark, docs, labels):
    many = docs.where("doc_id = 904").crossJoin(spark.range(50).select(F.col("id").alias("k"))).drop("k")
    lab = spark.createDataFrame([(904, 1, 0)], labels.schema).unionByName(labels)
    sample = C.labelled_sample(docs.unionByName(many), C.learnable(lab), 10)
    assert sample.count() <= 10 and sample.select("doc_id").distinct().count() == sample.count()
