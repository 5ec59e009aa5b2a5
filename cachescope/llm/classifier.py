"""Operator 12: quality classifier by supervised subword embeddings.

A document is the bag of its words, of the pairs of consecutive words and of the character 2- and 3-grams of the
words with their edges (case kept); a word that repeats the one before it, and their pair, are one common feature each,
whatever the word.
Every feature is hashed to one of ``BUCKETS`` learned vectors of ``DIM`` numbers; a document is the average of its
features' vectors, and a softmax over two classes reads it.  Vectors and softmax are trained together by stochastic
gradient descent in numpy (one document a step, rates by the past gradients of a vector, falling to zero).

* The fit runs on the driver over at most ``SAMPLE_ROWS`` labelled documents, half of each class (a documented bound): the ids
  of smallest hash in each class, one text an id.  A document arrives as its hashed shares, ``BUCKETS`` numbers
  at most, however long its text.  The classes' shares among all labels are put back into the bias.
* A score is the softmax of an average, which is linear up to the softmax, so a task holds one number a bucket
  (the difference of the classes' logits), not the vectors; texts are read whole, in slices.

Defined results: an empty, blank or null text has no feature and gets the classes' bias alone; labels other than 0 and 1 are not
read, an id that is labelled twice is good if one of its labels is; rows that repeat a ``doc_id`` are scored one by one, and
learned once, by the smallest text; a null ``doc_id`` is scored, not held out, and never learned; without labels of both
classes every score is (good + 1) / (labelled + 2); an empty table gives an empty result.  Columns other than ``doc_id`` and ``text``
are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachescope.llm.common import map_batches, materialise, mix64, row_slices, span_hashes, utf8, word_bounds

BUCKETS = 1 << 15
DIM = 16
SAMPLE_ROWS = 4000
EPOCHS = 6
RATE = 1.0
THRESHOLD = 0.3
HELD_OUT = 5
BLANK = np.uint32(0x20)
_BLANKS = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], np.uint32)
_SAME = np.uint64(0x5E3F)                                    # the pair of a word with itself
_KIND = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return (mix64(h ^ _KIND[kind]) & np.uint64(BUCKETS - 1)).astype(np.int64)


def edged_letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the rows, one blank for every run of blanks and at both ends of a row; the row of each."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), offsets)
    seq = np.insert(np.where(np.isin(points, _BLANKS), BLANK, points), np.r_[at[:-1], at[1:]], BLANK)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at) + 2)
    keep = seq != BLANK
    keep[1:] |= (seq[:-1] != BLANK) | (row[1:] != row[:-1])
    keep[:1] = True
    return seq[keep], row[keep]


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every feature of the rows, a kind of feature at a time."""
    first, last = word_bounds(data, offsets)
    if not len(first):
        return
    h = span_hashes(data, first, last)
    row = np.searchsorted(offsets, first, "right") - 1
    near = np.flatnonzero(row[1:] == row[:-1])
    a, b = h[near], h[near + 1]
    same = a == b
    yield _bucket(np.where(same, _SAME, a * np.uint64(3) + mix64(b)), 1), row[near]
    h[near[same] + 1] = _SAME
    yield _bucket(h, 0), row
    seq, owner = edged_letters(data, offsets)
    wide = seq.astype(np.uint64)
    pair = wide[:-1] << np.uint64(21) | wide[1:]
    ok = owner[1:] == owner[:-1]
    yield _bucket(pair[ok], 2), owner[:-1][ok]
    three = pair[:-1] << np.uint64(21) | wide[2:]
    ok = (owner[2:] == owner[:-2]) & (seq[1:-1] != BLANK)
    yield _bucket(three[ok], 3), owner[:-2][ok]


@dataclass
class QualityModel:
    logit: np.ndarray        # a bucket: class 1 minus class 0
    bias: float

    def score(self, total: np.ndarray, count: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -500, 500)))


# ---------------------------------------------------------------------------
# sample
# ---------------------------------------------------------------------------

def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of`` (null id: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of


def learnable(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of the labelled ids that are not held out, one row an id."""
    lab = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("quality").alias("quality"))
    return lab.where(remainder("doc_id", HELD_OUT) != 0)


def labelled_sample(docs: DataFrame, lab: DataFrame, rows: int) -> DataFrame:
    """(doc_id, quality, text) of at most ``rows`` labelled documents, half of each class."""
    key = F.xxhash64(F.lit("quality"), F.col("doc_id").cast("string"))
    half = [lab.where(F.col("quality") == q).orderBy(key, "doc_id").limit(rows // 2) for q in (0, 1)]
    ids = half[0].unionByName(half[1])               # at most ``rows`` ids: a bounded broadcast
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "quality").agg(
        F.min("text").alias("text"))


def hashed_shares(sample: DataFrame) -> DataFrame:
    """(doc_id, quality, buckets, shares) of the sample rows."""
    kind = sample.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            buckets, shares = [], []
            for r in range(batch.num_rows):
                part = data[offsets[r]:offsets[r + 1]]
                n = np.zeros(BUCKETS, np.int64)
                for bucket, _ in features(part, np.array([0, len(part)])):
                    n += np.bincount(bucket, minlength=BUCKETS)
                hit = np.flatnonzero(n)
                buckets.append(hit.astype(np.int16))
                shares.append((n[hit] / max(1, n.sum())).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(buckets, pa.list_(pa.int16())),
                 pa.array(shares, pa.list_(pa.float32()))], ["doc_id", "quality", "buckets", "shares"])

    return map_batches(sample.select("doc_id", "quality", "text"), run,
                       f"doc_id {kind}, quality int, buckets array<smallint>, shares array<float>")


# ---------------------------------------------------------------------------
# fit
# ---------------------------------------------------------------------------

def sgd(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors (BUCKETS x DIM), softmax weights (2 x DIM) and bias over (buckets, shares, class) examples."""
    rng = np.random.default_rng(12)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    past = np.full(BUCKETS, 1e-8)                    # summed squared gradients of each vector
    soft, soft_past = np.zeros((2, DIM)), np.full((2, 1), 1e-8)
    bias = np.zeros(2)
    step, steps = 0, max(1, epochs * len(examples))
    for _ in range(epochs):
        for e in rng.permutation(len(examples)):
            i, x, y = examples[e]
            rate = RATE * (1 - step / steps)
            step += 1
            h = x @ vectors[i]
            z = soft @ h + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1.0
            back = p @ soft
            soft_past += (p * p)[:, None] * (h @ h)
            soft -= rate * np.outer(p, h) / np.sqrt(soft_past)
            bias -= 0.1 * rate * p
            past[i] += x * x * (back @ back)
            vectors[i] -= np.outer(rate * x / np.sqrt(past[i]), back)
    return vectors, soft, bias


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> QualityModel:
    """Model from the labels that are not held out."""
    lab = materialise(learnable(labels), "quality-labels")
    n = {r["quality"]: r["count"] for r in lab.groupBy("quality").count().collect()}
    bad, good = n.get(0, 0), n.get(1, 0)
    prior = np.log((good + 1) / (bad + 1))
    sample = hashed_shares(labelled_sample(docs, lab, rows)).toArrow().sort_by("doc_id")
    classes = sample["quality"].to_pylist()
    if len(set(classes)) < 2:
        return QualityModel(np.zeros(BUCKETS), float(prior))
    buckets, shares = sample["buckets"].combine_chunks(), sample["shares"].combine_chunks()
    at = buckets.offsets.to_numpy()
    index, share = buckets.values.to_numpy(), shares.values.to_numpy().astype(np.float64)
    vectors, soft, bias = sgd([(index[a:b], share[a:b], y) for a, b, y in zip(at[:-1], at[1:], classes)])
    seen = np.log((classes.count(1) + 1) / (classes.count(0) + 1))
    return QualityModel(vectors @ (soft[1] - soft[0]), float(bias[1] - bias[0] + prior - seen))


def predict(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_slices(offsets):
                for bucket, row in features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]):
                    total[lo:hi] += np.bincount(row, m.logit[bucket], hi - lo)
                    count[lo:hi] += np.bincount(row, minlength=hi - lo)
            score = m.score(total, count)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double, predicted int")


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the labels that are not held out."""
    held = F.coalesce(remainder("doc_id", HELD_OUT) == 0, F.lit(False))
    return predict(docs, train(docs, labels)).select("doc_id", held.alias("held_out"), "score", "predicted")
