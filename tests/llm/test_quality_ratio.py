"""The n-gram ratio and the verdict against a dictionary model; the memo of common words changes nothing."""

import math
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from cachescope.llm import quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def buckets(text):
    for w in WORDS.findall(text or ""):
        edged = f" {w} "
        for k in range(len(w)):
            yield xxhash.xxh64_intdigest(edged[k:k + 3].encode(), 42) % quality.BUCKETS


def model(rows, good):
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(buckets(r["text"]))
        if r["doc_id"] in good:
            target.update(buckets(r["text"]))
    nr, nt = sum(raw.values()) + quality.BUCKETS, sum(target.values()) + quality.BUCKETS
    return lambda b: math.log((target[b] + 1) / nt) - math.log((raw[b] + 1) / nr)


@pytest.mark.parametrize("memo", [1, 16, 1 << 12])
def test_ratio_and_verdict(spark, docs, labels, memo, monkeypatch):
    monkeypatch.setattr(quality, "MEMO", memo)
    docs = docs.withColumn("raw", F.lit("clash")).withColumn("target", F.lit("clash"))
    rows = docs.collect()
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    weight = model(rows, good)
    got = {(r["doc_id"], r["text"]): r for r in quality.score_quality(docs, labels).collect()}
    assert sum(1 for r in got.values() if r["llr"]) > 50
    for r in rows:
        chars = sum(map(len, WORDS.findall(r["text"] or "")))
        want = 3 * math.fsum(map(weight, buckets(r["text"]))) / chars if chars else 0.0
        out = got[r["doc_id"], r["text"]]
        assert abs(out["llr"] - want) < 1e-9 * max(1, chars)
        if abs(want - quality.THRESHOLD) > 1e-6:
            assert out["kept"] == (not out["base_failed"] and want >= quality.THRESHOLD)


@pytest.mark.parametrize("broadcast", [10 ** 6, 0])
def test_every_document_labelled_good_is_counted(spark, broadcast, monkeypatch):
    monkeypatch.setattr(quality, "BROADCAST_IDS", broadcast)
    n = 25_000                                               # more than the sample that once stood for them
    docs = spark.range(n + 10).select(F.col("id").alias("doc_id"), F.concat(F.lit("word w"), F.col("id") % 7).alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")).unionByName(
        spark.createDataFrame([(n + 1, 0), (None, 1), (3, 1)], "doc_id long, quality int"))
    got = {r["w"]: (r["raw"], r["target"]) for r in quality.vocabulary(docs, labels).collect()}
    assert got["word"] == (n + 10, n)
    assert sum(t for _, t in got.values()) == 2 * n
