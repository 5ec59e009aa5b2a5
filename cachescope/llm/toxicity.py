"""Operator 5: toxicity by a subsequence string-kernel SVM with Nyström landmarks.

Kernel: gap-weighted common subsequences of ``P`` symbols; an occurrence that skips ``g``
symbols weighs ``DECAY ** g``, ``MAX_GAP`` skipped at most.  Symbols are lower-case
letters (a-z, accents folded; letters and vowel signs of other scripts by a hash of 10 bits) and one edge for each run of anything else;
an edge can be matched (start and end of a word) or skipped, and edges between single letters
("i-d-i-o-t") are dropped.  So an insult with gaps or inserted characters keeps much of its
kernel value.  ``k(s, z) = sum_v f_v(s) f_v(z) / |f(z)|``.

Landmarks: the ``LANDMARKS`` strings of 5 or 6 symbols within a word of a labelled
document that best tell toxic from clean documents in the sample.  Nyström
features ``K_mm^(-1/2) k_m(x)`` feed a linear SVM (squared hinge).  An instance is a
piece of a sentence, ``WINDOW`` symbols; labels mark documents, so a toxic document counts by
its strongest piece and those at least half as strong, and a clean one by its ``KEEP`` strongest as counterexamples; later
rounds leave out pieces far on the wrong side (ramp loss: labels may be wrong).  A
document's score is a sigmoid (Platt) of its strongest piece.

The SVM is linear in the subsequence features of its landmarks, so scoring is one
Arrow pass over whole texts: a hashed table of 2^20 flags finds the places where the first
four symbols of a feature may stand, all five are looked up there, and a running
sum gives every window.  No shuffle, a broadcast below 2 MB, bounded memory a slice.

Training reads a documented sample of about ``SAMPLE_ROWS`` labelled rows, half
toxic where there are enough, chosen by a hash of ``doc_id``; at most ``KEEP`` windows a
row reach the driver.

Defined results: an empty, null or letter-less text scores like a text without
any landmark (near 0); without both classes in the labels every score is 0; repeated label rows count
once (toxic if any is), rows that repeat a ``doc_id`` are scored one by one; a null
``doc_id`` is never learned from; an empty table gives an empty result.  Only
``doc_id`` and ``text`` of the documents are read.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachescope.llm.common import map_batches, materialise, row_slices, utf8
from cachescope.llm.langid import remainder

P = 5
MAX_GAP = 3
DECAY = 0.85
WINDOW = 14
LANDMARKS = 192
LENGTHS = (5, 6)
SAMPLE_ROWS = 4000
KEEP = 6
MIN_DOCS = 3             # toxic sample documents that must hold a landmark
MIN_Z = 4.5              # standard errors by which their shares must differ
COST = 10.0
ROUNDS = 3
RAMP = -0.5
SPAN = P + MAX_GAP
BITS = 10                # of a symbol
OTHERS = (1 << BITS) - 27
FLAG_BITS = 20           # of the hashed table of the first four symbols
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
ACCENTS = range(0x300, 0x370)


@lru_cache(1)
def symbol_table() -> np.ndarray:
    """Symbol of each code point: 1-26 Latin base letters, 27-1023 other letters by a hash, 0 the rest."""
    t = np.zeros(sys.maxunicode + 1, np.uint16)
    for c in range(128, sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalpha() or (c not in ACCENTS and unicodedata.category(ch) in ("Mn", "Mc")):
            low = ch.lower()[0]
            base = unicodedata.normalize("NFD", low)[0]
            # Latin and Greek letters lose their accents; marks of other scripts make another letter
            low = ord(base if base < "\u0400" else low)
            t[c] = low - 96 if 97 <= low <= 122 else 27 + (low * 0x9E3779B1 >> 7) % OTHERS
    for c in range(97, 123):
        t[c] = t[c - 32] = c - 96
    return t


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the rows, each between edges so that no window spans two rows; row offsets.

    Runs of non-letters are one edge symbol, none between two single letters.
    """
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    rows = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), offsets)
    accent = (points >= ACCENTS.start) & (points < ACCENTS.stop)
    if accent.any():                                           # belongs to the letter before it
        points, rows = points[~accent], np.r_[0, np.cumsum(~accent)][rows]
    sym = np.insert(symbol_table()[points], rows[:-1], 0)      # an edge before each row
    rows = rows + np.arange(len(rows))
    keep = sym != 0
    keep[1:] |= sym[:-1] != 0
    keep[rows[:-1]] = True
    sym, rows = sym[keep], np.r_[0, np.cumsum(keep)][rows]
    edge = np.flatnonzero(sym == 0)
    single = np.diff(np.r_[edge, len(sym)]) == 2               # the word behind the edge has one letter
    drop = np.zeros(len(sym), bool)
    drop[edge[1:][single[1:] & single[:-1]]] = True
    drop[rows[:-1][rows[:-1] < len(sym)]] = False
    sym, rows = sym[~drop], np.r_[0, np.cumsum(~drop)][rows]
    pad = WINDOW + SPAN
    n = len(rows) - 1
    out = np.zeros(len(sym) + pad * (n + 1), np.uint16)
    out[np.arange(len(sym)) + pad * np.repeat(np.arange(1, n + 1), np.diff(rows))] = sym
    return out, rows + pad * np.arange(1, n + 2) - pad


def profile(string: tuple[int, ...]) -> dict[int, float]:
    """Subsequence features of one short string: code -> summed weight."""
    out: dict[int, float] = {}
    for spread in combinations(range(len(string)), P):
        gaps = spread[-1] - spread[0] - (P - 1)
        if gaps <= MAX_GAP:
            code = 0
            for i in spread:
                code = code << BITS | string[i]
            out[code] = out.get(code, 0.0) + DECAY ** gaps
    return out


class Features:
    """The subsequences in use, and where they occur in a sequence of symbols."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes                       # sorted, 50 bits each
        self.open = np.zeros(1 << FLAG_BITS, bool)      # may the first four symbols be these?
        four = sum((codes >> BITS * (4 - k) & ((1 << BITS) - 1)).astype(np.uint32) * m for k, m in enumerate(MULTIPLIERS))
        self.open[four >> np.uint32(32 - FLAG_BITS)] = True

    def find(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, feature, weight) of every occurrence with ``MAX_GAP`` skipped symbols at most."""
        wide, short = sym.astype(np.int64), sym.astype(np.uint32)
        a, b, c, d = (short * x for x in MULTIPLIERS)          # wrapping
        shift = np.uint32(32 - FLAG_BITS)
        m = len(sym) - SPAN + 1
        position, feature, weight = [], [], []
        for i in range(1, MAX_GAP + 2):
            two = a[:m] + b[i:i + m]
            for j in range(i + 1, MAX_GAP + 3):
                three = two + c[j:j + m]
                for k in range(j + 1, MAX_GAP + 4):
                    p = np.flatnonzero(self.open[(three + d[k:k + m]) >> shift])
                    head = wide[p] << 4 * BITS | wide[p + i] << 3 * BITS | wide[p + j] << 2 * BITS | wide[p + k] << BITS
                    for last in range(k + 1, SPAN):
                        five = head | wide[p + last]
                        at = np.minimum(np.searchsorted(self.codes, five), len(self.codes) - 1)
                        ok = self.codes[at] == five
                        position.append(p[ok]), feature.append(at[ok])
                        weight.append(np.full(int(ok.sum()), DECAY ** (last - (P - 1))))
        return np.concatenate(position), np.concatenate(feature), np.concatenate(weight)


@dataclass
class ToxicityModel:
    codes: np.ndarray
    weight: np.ndarray       # of each code
    bias: float
    slope: float
    shift: float

    def score(self, decision: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * decision + self.shift, -40, 40)))


def windows(position: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values in the ``WINDOW`` symbols from each position."""
    run = np.r_[0.0, np.cumsum(np.bincount(position, value, minlength=n))]
    return run[WINDOW:] - run[:-WINDOW]


def strongest(sym: np.ndarray, rows: np.ndarray, features: Features, weight: np.ndarray) -> np.ndarray:
    """Largest window sum of each row, at least 0 (a piece without any feature)."""
    position, feature, w = features.find(sym)
    window = windows(position, weight[feature] * w, len(sym))
    return np.maximum(np.maximum.reduceat(window, rows[:-1]), 0.0)


# ---------------------------------------------------------------------------
# training
# ---------------------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text, toxic) of about ``rows`` labelled documents, half of each class where there are enough."""
    lab = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    lab = lab.where(remainder("doc_id", 5) != 0)
    n = {r["toxic"]: r["count"] for r in lab.groupBy("toxic").count().collect()}
    part = F.pmod(F.xxhash64(F.lit("toxic"), F.col("doc_id").cast("string")), F.lit(1_000_003)) / F.lit(1_000_003)
    rate = F.when(F.col("toxic") == 1, rows / 2 / max(1, n.get(1, 0))).otherwise(rows / 2 / max(1, n.get(0, 0)))
    chosen = lab.where(part < rate).select("doc_id", "toxic").limit(2 * rows)
    # at most 2 * rows ids: a bounded broadcast, so the texts are not shuffled
    return docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")


def _strings(sample: DataFrame) -> DataFrame:
    """(code, pos, neg): documents of each class that hold each string within a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for r in range(batch.num_rows):
                part = data[offsets[r]:offsets[r + 1]]
                sym, _ = symbols(part, np.array([0, len(part)]))
                w = sym.astype(np.int64)
                for n in LENGTHS:
                    m = len(w) - n + 1
                    code, inside = np.zeros(m, np.int64), np.ones(m, bool)
                    for k in range(n):
                        code = code << BITS | w[k:k + m]
                        if 0 < k < n - 1:
                            inside &= w[k:k + m] != 0
                    code = np.unique(code[inside]) | n << 60
                    toxic = np.full(len(code), batch.column(1)[r].as_py(), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(toxic)], ["code", "toxic"])

    return map_batches(sample.select("text", "toxic"), run, "code long, toxic long").groupBy("code").agg(
        F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))


def choose_landmarks(sample: DataFrame, pos: int, neg: int) -> list[tuple[int, ...]]:
    """Strings with the largest weighted log odds for the toxic class, if the classes differ beyond chance."""
    p, q = (F.col("pos") + 0.5) / (pos + 1), (F.col("neg") + 0.5) / (neg + 1)
    share = (F.col("pos") + F.col("neg") + 1) / (pos + neg + 2)
    z = (p - q) / F.sqrt(share * (1 - share) * (1 / pos + 1 / neg))
    top = (_strings(sample).where(F.col("pos") >= min(MIN_DOCS, pos))
           .where(z >= MIN_Z).withColumn("gain", p * F.log(p / q))
           .orderBy(F.desc("gain"), "code").limit(LANDMARKS).select("code").collect())
    return [tuple((r["code"] >> BITS * k) & ((1 << BITS) - 1) for k in reversed(range(r["code"] >> 60))) for r in top]


def _pieces(sample: DataFrame, codes: np.ndarray, guide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature sums of the ``KEEP`` strongest disjoint windows of each sample row under ``guide``.

    Returns (row key, toxic, sums), one entry a window.
    """
    shared = sample.sparkSession.sparkContext.broadcast((codes, guide))
    width = len(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_, weight = shared.value
        features = Features(codes_)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            out = []
            for r in range(batch.num_rows):
                part = data[offsets[r]:offsets[r + 1]]
                sym, _ = symbols(part, np.array([0, len(part)]))
                pos, feat, val = features.find(sym)
                window = windows(pos, weight[feat] * val, len(sym))
                sums = []
                for _ in range(KEEP):
                    k = int(window.argmax())
                    if window[k] <= 1e-12:
                        break
                    here = (pos >= k) & (pos < k + WINDOW)
                    sums.append(np.bincount(feat[here], val[here], minlength=width).astype(np.float32))
                    window[max(0, k - WINDOW + 1):k + WINDOW] = 0
                sums = sums or [np.zeros(width, np.float32)]
                out += [(batch.column(2)[r].as_py(), batch.column(1)[r].as_py(), s) for s in sums]
            ids, toxic, sums = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(toxic, pa.int64()),
                                              pa.array(list(sums), pa.list_(pa.float32()))], ["key", "toxic", "sums"])

    rows = sample.select("text", "toxic", F.xxhash64(F.col("doc_id").cast("string")).alias("key"))
    got = map_batches(rows, run, "key long, toxic long, sums array<float>").toArrow().combine_chunks()
    key, toxic = got["key"].to_numpy(), got["toxic"].to_numpy()
    flat = got["sums"].combine_chunks().flatten().to_numpy() if len(key) else np.zeros(0)
    sums = flat.astype(np.float64).reshape(len(key), width)
    order = np.lexsort((sums @ guide, key))
    return key[order], toxic[order], sums[order]


def svm(x: np.ndarray, y: np.ndarray, steps: int = 600) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge by accelerated gradient descent; classes weigh alike."""
    n, d = x.shape
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * COST
    z = np.c_[x, np.ones(n)]
    reg = np.r_[np.full(d, 1e-2), 0.0]
    step = 1.0 / (2 * float(np.linalg.norm((z * weight[:, None]).T @ z, 2)) + 2e-2)
    w = v = np.zeros(d + 1)
    for t in range(steps):
        m = np.maximum(0.0, 1 - y * (z @ v))
        new = v - step * (-2 * z.T @ (weight * y * m) + 2 * reg * v)
        v = new + t / (t + 3) * (new - w)
        w = new
    return w[:d], float(w[d])


def platt(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid, by Newton steps on smoothed targets."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    theta = np.array([1.0, 0.0])
    z = np.c_[f, np.ones(len(f))]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -40, 40)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        theta = theta + np.linalg.solve(h, z.T @ (t - p) - 1e-3 * theta)
    return float(theta[0]), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel | None:
    """Model from the labelled rows that are not held out; None without both classes."""
    sample = materialise(labelled_sample(docs, labels, rows), "toxic-sample")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    marks = choose_landmarks(sample, pos, neg) if pos and neg else []
    if not marks:
        return None
    profiles = [profile(z) for z in marks]
    codes = np.array(sorted({c for f in profiles for c in f}), np.int64)
    f = np.zeros((len(marks), len(codes)))
    for i, one in enumerate(profiles):
        f[i, np.searchsorted(codes, list(one))] = list(one.values())
    f /= np.linalg.norm(f, axis=1, keepdims=True)
    values, vectors = np.linalg.eigh(f @ f.T)
    good = values > 1e-6 * values[-1]
    lift = f.T @ ((vectors[:, good] / np.sqrt(values[good])) @ vectors[:, good].T)
    guide, bias = f.sum(0), 0.0
    for turn in range(ROUNDS):
        key, toxic, sums = _pieces(sample, codes, guide)
        y = np.where(toxic == 1, 1.0, -1.0)
        strength = sums @ guide
        order = np.lexsort((-strength, key))
        first = np.r_[True, key[order][1:] != key[order][:-1]]
        top = np.repeat(strength[order][first], np.diff(np.r_[np.flatnonzero(first), len(order)]))
        use = order[first | (y[order] < 0) | (strength[order] >= top / 2)]
        if turn:
            use = use[y[use] * (strength[use] + bias) > RAMP]
        w, bias = svm(sums[use] @ lift, y[use])
        guide = lift @ w
    decision = np.maximum(sums @ guide, 0.0) + bias
    order = np.lexsort((-decision, key))
    best = order[np.r_[True, key[order][1:] != key[order][:-1]]]
    best = best[y[best] * decision[best] > RAMP]
    slope, shift = platt(decision[best], y[best])
    return ToxicityModel(codes, guide, bias, slope, shift)


def predict(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        features = Features(m.codes) if m else None
        for batch in batches:
            score = np.zeros(batch.num_rows)
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_slices(offsets) if m else ():
                sym, rows = symbols(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                score[lo:hi] = m.score(strongest(sym, rows, features, m.weight) + m.bias)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double, predicted int")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the labels that are not held out."""
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return predict(docs, train(docs, labels)).select("doc_id", held.alias("held_out"), "score", "predicted")
