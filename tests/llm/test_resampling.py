"""Importance resampling against brute force on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cachescope.llm import resampling as R

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {65 + i: 97 + i for i in range(26)}


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])], len(w)


def counts(texts):
    c = [0] * R.BUCKETS
    for t in texts:
        for f in features(t)[0]:
            c[zlib.crc32(f.encode()) % R.BUCKETS] += 1
    return c


def brute(rows, target):
    s, t = counts(r["text"] for r in rows), counts(target)
    total_s, total_t = sum(s) + R.BUCKETS, sum(t) + R.BUCKETS
    gain = [math.floor(1000 * math.log((b + 1) * total_s / ((a + 1) * total_t))) for a, b in zip(s, t)]
    out = []
    for r in rows:
        f, n = features(r["text"])
        w = sum(gain[zlib.crc32(x.encode()) % R.BUCKETS] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:8], 16)
        out.append([r["doc_id"], len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    drawn = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    drawn = drawn[:25 * len(drawn) // 100]
    rank = Counter()
    for k, r in enumerate(drawn, 1):
        rank[(*r[:4], k)] += 1
    none = Counter(tuple(r[:4]) for r in out)
    none.subtract(Counter(tuple(r[:4]) for r in drawn))
    for r, n in none.items():
        rank[(*r, None)] += n
    return +rank


def test_codes():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    at, size = rng.integers(0, 4000, 300), np.r_[rng.integers(0, 900, 100), rng.integers(0, 12, 200)]
    code = R.crc_spans(data, at, size)
    spans = [data[a:a + n].tobytes() for a, n in zip(at, size)]
    assert code.tolist() == [zlib.crc32(x) for x in spans]
    both = R.join_codes(code, code[::-1], size[::-1])
    assert both.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(spans, spans[::-1])]


def test_lines_fold():
    texts = pa.array(["a b\nc\na b", None, "", "\n\n", "a b"])
    lines, place, row = R.fold_lines(texts)
    assert sorted(lines.to_pylist()) == ["", "a b", "c"]
    assert [lines.to_pylist()[p] for p in place] == ["a b", "c", "a b", "", "", "", "", "", "a b"]
    assert row.tolist() == [0, 0, 0, 1, 2, 3, 3, 3, 4]


def test_resample(spark, docs):
    more = spark.createDataFrame(
        [(950 + k, t, None, None, 0) for k, t in enumerate([
            "Ünï ONE\n\n  two\r\nthree é中 " * 9, "\n".join("same line here" for _ in range(30)), "-- \x00 ..", "x" * 300 + " " + "y" * 200])],
        "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars", "size").unionByName(
        more.withColumn("size", F.lit("clash")))
    target = spark.read.parquet(f"{SF001}/benchmark.parquet")
    rows, texts = docs.collect(), [r["text"] for r in target.collect()]
    assert R.bucket_counts(docs).tolist() == counts(r["text"] for r in rows)
    want = brute(rows, texts)
    got = R.resample(docs, target)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == want
    drawn = R.resample_documents(docs, target)
    assert drawn.columns == docs.columns
    assert Counter(r["doc_id"] for r in drawn.collect()) == Counter(
        {k: v for k, v in Counter(r[0] for r in want.elements() if r[4] is not None).items()})


def test_resample_empty(spark, docs):
    target = spark.read.parquet(f"{SF001}/benchmark.parquet")
    assert R.resample(docs.where("false"), target).count() == 0
    assert R.resample_documents(docs.where("false"), target).count() == 0
    rows = R.resample(docs.where("doc_id is null or doc_id >= 900"), target.where("false")).collect()
    assert len(rows) == docs.where("doc_id is null or doc_id >= 900").count()
    blank = R.resample(spark.createDataFrame([(1, None), (1, None), (None, "")], "doc_id long, text string"), target)
    assert sorted((r["n_features"], r["weight"], r["rank"]) for r in blank.collect()) == [(0, 0, None)] * 3
