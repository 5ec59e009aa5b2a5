"""Awkward rows through the operators and stages, and two methods against plain versions."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cachescope.llm import bpe, covertree, htmltext, langid, toxicity, urlfilter
from conftest import SF001


def clashing(df):
    """Columns that the operators use themselves, in the input."""
    names = ("_fp", "_keep_id", "_mix_rate", "_mix_source", "_source", "key", "id", "n", "score", "host", "kept", "fp", "line")
    return df.select("*", *[F.lit(-1).alias(c) for c in names if c not in df.columns])


def in_and_out(given, found, key):
    """Every input row has its row, and equal rows (they share an id here) have equal results."""
    rows = found.collect()
    counts = {}
    for r in given.select(key).collect():
        counts[r[0]] = counts.get(r[0], 0) + 1
    got = {}
    for r in rows:
        got.setdefault(r[key], []).append(tuple(r))
    assert {k: len(v) for k, v in got.items()} == counts
    assert all(len(set(v)) == 1 for v in got.values())
    return {k: v[0] for k, v in got.items()}


@pytest.mark.parametrize("name", ["language", "toxicity", "bpe"])
def test_documents_of_any_shape(spark, docs, labels, name):
    given = clashing(docs)
    twice = labels.unionByName(labels.where("doc_id % 3 = 0"))
    found = {"language": lambda: langid.identify(given),
             "toxicity": lambda: toxicity.score_toxicity(given, twice),
             "bpe": lambda: bpe.encode_documents(given, corpus_pipeline.public_tokenizers.path(corpus_pipeline.RANKS))}[name]()
    found = found.drop(*[c for c in found.columns if c == "token_ids"])
    got = in_and_out(given, found, "doc_id")
    cols = found.columns
    empty = [dict(zip(cols, got[d])) for d in (900, 901)]
    if name == "language":
        assert [e["lang_pred"] for e in empty] == ["und", "und"]
    elif name == "toxicity":
        assert empty[0]["score"] == empty[1]["score"] and 0 <= empty[0]["score"] <= 1
    else:
        assert [e["n_tokens"] for e in empty] == [0, 0]


@pytest.mark.parametrize("name", ["urls", "html"])
def test_pages_of_any_shape(spark, name):
    base = spark.read.parquet(f"{SF001}/pages.parquet")
    base = base.where("page_id < 40")
    fields = [f.name for f in base.schema]
    at = {"page_id": 9000, "url": None, "html": None}
    odd = [{**at}, {**at, "page_id": 9001, "url": "no host", "html": ""}, {**at, "page_id": 9002, "url": "https://A.org", "html": "<p>"},
           {**at, "page_id": 9002, "url": "https://A.org", "html": "<p>"}, {**at, "page_id": None, "url": "https://b.com/fr/x", "html": "<p>x</p>" * 20000}]
    extra = spark.createDataFrame([tuple(r.get(f) for f in fields) for r in odd], base.schema)
    given = clashing(base.unionByName(extra))
    found = urlfilter.judge_urls(given) if name == "urls" else htmltext.extract(given)
    got = in_and_out(given, found, "page_id")
    row = dict(zip(found.columns, got[9000]))
    assert (row["host"], row["path"]) == ("", "") if name == "urls" else (row["text"], row["n_chars"]) == ("", 0)


def test_repeated_vector_ids(spark):
    """Rows of one id have the links and the component of their own vectors."""
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(1, a, 0), (2, a, 0), (2, b, 0), (3, b, 0), (4, c, 0), (4, c, 0), (5, c, None), (6, None, 0), (6, [0.0] * 3, 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("key", F.lit(0))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in covertree.near_duplicates(vectors).collect())
    assert [g[0] for g in got] == sorted(r[0] for r in rows)
    assert got[:4] == [(1, 1, 1), (2, 1, 1), (2, 1, 2), (3, 1, 2)]
    assert [g for g in got if g[0] > 3] == [(4, 1, 4), (4, 1, 4), (5, 0, 5), (6, 0, 6), (6, 0, 6)]


def test_stages_on_awkward_tables(spark, docs):
    """Every stage but the last keeps the columns, on null ids, empty texts, repeated rows, clashing names and no rows."""
    given = clashing(docs)
    for table in (given, given.limit(0)):
        step = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            step = stage(spark, step, SF001)
            assert sorted(step.columns) == sorted(given.columns), name
            step = spark.createDataFrame(step.collect(), given.select(*step.columns).schema)
        last = corpus_pipeline.STAGES[-1][1](spark, step, SF001)
        assert last.count() == step.count()
        assert {r.doc_id for r in last.select("doc_id").collect()} <= {r.doc_id for r in given.select("doc_id").collect()}


def test_ftrl_equals_a_plain_loop(monkeypatch):
    monkeypatch.setattr(langid, "BUCKETS", 12)
    rng = np.random.default_rng(2)
    examples = [(np.sort(rng.choice(12, 4, replace=False)), rng.random(4) * 3, int(rng.integers(3))) for _ in range(40)]
    z, n = {}, {}

    def weight(i, c):
        zi, ni = z.get((i, c), 0.0), n.get((i, c), 0.0)
        if abs(zi) <= langid.L1:
            return 0.0
        return -(zi - math.copysign(langid.L1, zi)) / ((langid.BETA + math.sqrt(ni)) / langid.ALPHA + langid.L2)

    for epoch in range(langid.EPOCHS):
        for e in np.random.default_rng(epoch).permutation(len(examples)):
            buckets, values, y = examples[e]
            x = [*zip(buckets.tolist(), values.tolist()), (12, 1.0)]
            w = {(i, c): weight(i, c) for i, _ in x for c in range(3)}
            s = [sum(w[i, c] * v for i, v in x) for c in range(3)]
            total = sum(math.exp(v) for v in s)
            for i, v in x:
                for c in range(3):
                    g = v * (math.exp(s[c]) / total - (c == y))
                    before = n.get((i, c), 0.0)
                    n[i, c] = before + g * g
                    z[i, c] = z.get((i, c), 0.0) + g - (math.sqrt(n[i, c]) - math.sqrt(before)) / langid.ALPHA * w[i, c]
    w, bias = langid.ftrl(examples, 3)
    assert np.allclose(w, [[weight(i, c) for c in range(3)] for i in range(12)])
    assert np.allclose(bias, [weight(12, c) for c in range(3)])


def test_kernel_equals_enumerated_subsequences():
    rng = random.Random(6)
    strings = [tuple(rng.randint(1, 3) for _ in range(6)) for _ in range(5)]
    codes = np.array(sorted({c for s in strings for c in toxicity.profile(s)}), np.int64)
    at = {int(c): k for k, c in enumerate(codes)}
    text = [rng.randint(1, 4) for _ in range(60)]
    position, feature, weight = toxicity.Features(codes).find(np.array(text, np.uint16))
    got = sorted(zip(position.tolist(), feature.tolist(), np.round(weight, 12).tolist()))
    want = []
    for i in range(len(text) - toxicity.SPAN + 1):
        for rest in combinations(range(i + 1, i + toxicity.SPAN), toxicity.P - 1):
            code = 0
            for k in (i, *rest):
                code = code << toxicity.BITS | text[k]
            if code in at:
                want.append((i, at[code], round(toxicity.DECAY ** (rest[-1] - i - toxicity.P + 1), 12)))
    assert got == sorted(want)
