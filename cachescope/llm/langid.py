"""Operator 2: language identification.

Features: hashed character n-grams (``ORDERS``) over lower-cased letters, everything
else one blank; term frequency (share of the document's n-grams) times inverse
document frequency.  Model: sparse multinomial logistic regression, trained
with follow-the-regularised-leader (per-coordinate rates, elastic net), then one
temperature fitted on a held-back part of the training rows.

* Document frequencies are counted over all training documents (one Arrow pass,
  a sum per bucket, ``BUCKETS`` rows to the driver).
* The classifier is fitted on the driver from a documented sample of about
  ``SAMPLE_ROWS`` training rows, spread evenly over languages by a hash of
  ``doc_id``; the sample arrives as hashed counts, ``BUCKETS`` a row at most.
* Prediction is one Arrow pass over whole texts: a document's logits are the mean
  of its n-grams' rows in a BUCKETS x languages table (the broadcast; bounded by
  ``MAX_LANGS`` languages), so long texts need no per-document state.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or if there is nothing to learn from; rows with a null ``lang`` are never learned
from; a null ``doc_id`` counts as not held out; repeated rows are
repeated; ties between languages go to the smaller name; an empty table gives an
empty result.  Other columns are never read by a prediction.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachescope.llm.common import map_batches, mix64, row_slices, utf8

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
SAMPLE_ROWS = 4000
MAX_LANGS = 256
SCALE = 30.0             # of the features, so that the rates below suit them
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
EPOCHS = 3
BLANK = np.uint32(0x20)


@lru_cache(1)
def letter_table() -> np.ndarray:
    """Lower-case code point of each letter, blank for everything else."""
    t = np.full(sys.maxunicode + 1, BLANK, np.uint32)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalpha():
            t[c] = ord(ch.lower()[0])
    return t


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the rows with one blank for each run of others and one before each row; row offsets."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    rows = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), offsets)
    seq = np.insert(letter_table()[points], rows[:-1], BLANK)
    rows = rows + np.arange(len(rows))
    keep = seq != BLANK
    keep[1:] |= seq[:-1] != BLANK
    keep[rows[:-1]] = True
    after = np.r_[0, np.cumsum(keep)]
    return seq[keep], after[rows]


def ngram_buckets(seq: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: bucket of the n-gram at each position, and row offsets into these."""
    wide = seq.astype(np.uint64)
    h = np.zeros(len(seq), np.uint64)
    sizes = np.diff(rows)
    for n in range(1, max(ORDERS) + 1):
        if len(seq) < n:
            return
        h = h[:len(seq) - n + 1] * np.uint64(0x100000001B3) + wide[n - 1:] + np.uint64(1)
        if n not in ORDERS:
            continue
        left = np.maximum(sizes - (n - 1), 0)
        at = np.r_[0, np.cumsum(left)]
        if n == 1:
            inside = h
        else:
            ok = np.ones(len(seq), bool)
            for k in range(1, n):
                cut = rows[1:] - k
                ok[cut[cut >= rows[:-1]]] = False
            inside = h[ok[:len(h)]]
        yield (mix64(inside) >> np.uint64(48)).astype(np.int64), at


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets; empty rows are zero."""
    out = np.zeros((len(at) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(at[1:] > at[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, at[:-1][full], axis=0, dtype=np.float64)
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray        # BUCKETS x languages: idf * weight * scale
    bias: np.ndarray
    temperature: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


# ---------------------------------------------------------------------------
# statistics and sample, on the executors
# ---------------------------------------------------------------------------

def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, and the number of documents, over all of ``texts`` (column text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            docs += batch.num_rows
            for lo, hi in row_slices(offsets):
                seq, rows = letters(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                for a in range(0, hi - lo, 256):
                    b = min(a + 256, hi - lo)
                    part, at = seq[rows[a]:rows[b]], rows[a:b + 1] - rows[a]
                    seen = np.zeros((b - a) * BUCKETS, bool)
                    for bucket, pos in ngram_buckets(part, at):
                        seen[np.repeat(np.arange(b - a) * BUCKETS, np.diff(pos)) + bucket] = True
                    df += seen.reshape(b - a, BUCKETS).sum(0)
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[hit, -1]), pa.array(np.r_[df[hit], docs])], ["bucket", "n"])

    rows = map_batches(texts.select("text"), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS + 1, np.int64)
    got = rows.toArrow()
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out[:BUCKETS], int(out[BUCKETS])


def hashed_counts(rows: DataFrame) -> DataFrame:
    """(lang, key, buckets, shares) from (lang, key, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            buckets, shares = [], []
            for r in range(batch.num_rows):
                part = data[offsets[r]:offsets[r + 1]]
                seq, at = letters(part, np.array([0, len(part)]))
                n = np.bincount(np.concatenate([b for b, _ in ngram_buckets(seq, at)]), minlength=BUCKETS)
                hit = np.flatnonzero(n)
                buckets.append(hit.astype(np.int32))
                shares.append((n[hit] / n.sum()).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(buckets, pa.list_(pa.int32())),
                 pa.array(shares, pa.list_(pa.float32()))], ["lang", "key", "buckets", "shares"])

    return map_batches(rows, run, "lang string, key long, buckets array<int>, shares array<float>")


# ---------------------------------------------------------------------------
# fit
# ---------------------------------------------------------------------------

def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS x k) and bias by FTRL-proximal over (buckets, values, class) examples."""
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))
    l1 = np.full(1, L1)

    def weights(i):
        zi, ni = z[i], n[i]
        w = -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for epoch in range(EPOCHS):
        order = np.random.default_rng(epoch).permutation(len(examples))
        for e in order:
            i, x, y = examples[e]
            i, x = np.r_[i, BUCKETS], np.r_[x, 1.0]
            w = weights(i)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1.0
            g = np.outer(x, p)
            root = np.sqrt(n[i])
            n[i] += g * g
            z[i] += g - (np.sqrt(n[i]) - root) / ALPHA * w
    w = weights(np.arange(BUCKETS + 1))
    return w[:BUCKETS], w[BUCKETS]


def fit_temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """Temperature of least log loss, by a grid and its refinement."""
    if not len(classes):
        return 1.0

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), classes]))

    lo, hi = np.log(0.05), np.log(20.0)
    for _ in range(4):
        grid = np.exp(np.linspace(lo, hi, 25))
        k = int(np.argmin([loss(t) for t in grid]))
        lo, hi = np.log(grid[max(k - 1, 0)]), np.log(grid[min(k + 1, 24)])
    return float(grid[k])


def train(train_rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Model from rows (doc_id, text, lang) with non-null lang; None without any."""
    rows = train_rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang")
              .limit(MAX_LANGS).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    df, docs = document_frequencies(rows)
    idf = np.log((1 + docs) / (1 + df)) + 1.0
    per = max(1, sample_rows // len(languages))
    key = F.xxhash64(F.lit("langid"), F.col("doc_id").cast("string"))
    part = F.pmod(key, F.lit(1_000_003)) / F.lit(1_000_003)
    rate = F.lit(0.0)
    for lang, n in counts.items():
        rate = F.when(F.col("lang") == lang, min(1.0, per / n)).otherwise(rate)
    sample = hashed_counts(rows.where(part < rate).select("lang", key.alias("key"), "text")).toArrow()
    order = np.argsort(sample["key"].to_numpy(), kind="stable")
    lang, keys = sample["lang"].to_pylist(), sample["key"].to_numpy()
    buckets, shares = sample["buckets"], sample["shares"]
    fit, hold = [], []
    for r in order:
        i, x = buckets[int(r)].values.to_numpy(), shares[int(r)].values.to_numpy().astype(np.float64)
        one = (i, x * idf[i] * SCALE, languages.index(lang[r]))
        (hold if keys[r] % 5 == 0 else fit).append(one)
    w, bias = ftrl(fit, len(languages))
    logits = np.array([x @ w[i] + bias for i, x, _ in hold]).reshape(len(hold), len(languages))
    t = fit_temperature(logits, np.array([y for *_, y in hold], np.int64))
    return LanguageModel(languages, (idf[:, None] * w * SCALE).astype(np.float32), bias, t)


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            names, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            limit = max(1 << 16, (1 << 22) // max(4, len(m.languages) if m else 4))
            for lo, hi in row_slices(offsets, limit) if m else ():
                seq, rows = letters(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                total, count = np.zeros((hi - lo, len(m.languages))), np.zeros(hi - lo)
                for bucket, at in ngram_buckets(seq, rows):
                    total += row_sums(m.table[bucket], at)
                    count += np.diff(at)
                logits = total / np.maximum(count, 1)[:, None] + m.bias
                p = m.probabilities(logits)
                best = p.argmax(1)
                has = row_sums((seq != BLANK).astype(np.float64), rows) > 0
                for r in np.flatnonzero(has).tolist():
                    names[lo + r] = m.languages[best[r]]
                    scores[lo + r] = min(1.0, float(p[r, best[r]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names), pa.array(scores)],
                                             ["doc_id", "lang_pred", "score"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")


def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of`` (null id: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; trained on the rows that are not held out."""
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = train(docs.where(~held).select("doc_id", "text", "lang"))
    return predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
