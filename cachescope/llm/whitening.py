"""Operator 13: embedding whitening by bit-sliced scatter.

Entries become integers, ``x = floor(64 * c) + 1000000``.  The covariance is built from exact integers:

1. one pass: rows, per-dimension sums and ranges;
2. one pass: every dimension is shifted by its minimum, its bits are packed across the rows into 64-bit words (a
   plane per dimension and bit), and the ones of every AND of two planes, weighted by
   their powers of two, are the cross-products of the shifted columns.  A task emits one row a pair of dimensions
   (and 30-bit limb, for wide ranges), whatever its rows;
3. ``n * sum(y_i y_j) - sum(y_i) sum(y_j)`` in unbounded integers is n^2 times the covariance, centred without
   rounding; ``eigh`` of the d x d matrix runs on the driver;
4. one pass measures the covariance of the whitened rows, one returns them.

The driver and a task hold d x d numbers (d: the vectors' length) and one chunk of rows.

Defined results: vectors that are null, empty, or hold null or non-finite entries are dropped; of several lengths the
commonest counts (ties: the longer), rows of another length are dropped as well; ``floor(64 * c)`` saturates at
2^60; components whose eigenvalue is not above rounding (``RANK`` of the largest) cannot be whitened and are left
out, so a table of equal vectors, or an empty one, gives no row; an eigenvector's largest entry is positive;
``deviation`` is null where the exact number exceeds a long; rows that repeat a ``vec_id``, or have none, count and
are returned one by one.  Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachescope.llm.common import map_batches

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
TOP = float(1 << 60)
LIMB = 30
RANK = 1e-11
CHUNK_BYTES = 1 << 22
SCHEMA = "n long, deviation long, whitened double, explained double, identity_error double"


def finite_rows(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, integers x) of the usable vectors of each length."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)     # nulls become NaN
    owner = np.repeat(size, size)
    for d in np.unique(size[size > 0]).tolist():
        row, c = np.flatnonzero(size == d), flat[owner == d].reshape(-1, d)
        ok = np.isfinite(c).all(1)
        if ok.any():
            x = np.clip(np.floor(SCALE * c[ok]), -TOP, TOP).astype(np.int64) + SHIFT
            yield d, row[ok], x


def _record(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in columns.values()], list(columns))


@dataclass
class Columns:
    """Rows, sum, smallest and largest integer of each dimension."""
    n: int
    total: list[int]
    low: np.ndarray
    high: np.ndarray

    @property
    def shifted(self) -> list[int]:
        return [s - self.n * int(m) for s, m in zip(self.total, self.low)]


def column_facts(vectors: DataFrame) -> Columns | None:
    """``Columns`` of the commonest length of ``vectors`` (column embedding); None without any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            for d, _, x in finite_rows(batch.column(0)):
                f = [len(x), (x & ((1 << LIMB) - 1)).sum(0), (x >> LIMB).sum(0), x.min(0), x.max(0)]
                o = seen.get(d, [0, 0, 0, f[3], f[4]])
                seen[d] = [o[0] + f[0], o[1] + f[1], o[2] + f[2], np.minimum(o[3], f[3]), np.maximum(o[4], f[4])]
        for d, (n, lo, hi, low, high) in seen.items():
            yield _record(d=np.full(d, d), dim=np.arange(d), n=np.full(d, n), lo=lo, hi=hi, low=low, high=high)

    names = ("d", "dim", "n", "lo", "hi", "low", "high")
    exact = "decimal(38,0)"
    facts = map_batches(vectors.select("embedding"), run, ", ".join(f"{c} long" for c in names)).groupBy("d", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("lo").cast(exact)).alias("lo"), F.sum(F.col("hi").cast(exact)).alias("hi"),
        F.min("low").alias("low"), F.max("high").alias("high")).persist()
    top = facts.where("dim = 0").orderBy(F.desc("n"), F.desc("d")).first()
    rows = facts.where(F.col("d") == top["d"]).orderBy("dim").collect() if top else []
    facts.unpersist()
    if not rows:
        return None
    return Columns(rows[0]["n"], [int(r["lo"]) + (int(r["hi"]) << LIMB) for r in rows],
                   np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows]))


def bit_planes(y: np.ndarray, bits: int) -> np.ndarray:
    """(bits, dimensions, words): bit k of each column of ``y``, packed across its rows."""
    pad = -len(y) % 64
    out = np.empty((bits, y.shape[1], (len(y) + pad) // 64), np.uint64)
    for k in range(bits):
        ones = np.pad(((y >> k) & 1).astype(np.uint8), ((0, pad), (0, 0)))
        out[k] = np.ascontiguousarray(np.packbits(ones, axis=0).T).view(np.uint64)
    return out


def add_scatter(acc: np.ndarray, y: np.ndarray, bits: int) -> None:
    """Add the cross-products of the columns of ``y`` (0 <= y < 2^bits) to ``acc`` (limb, i, j >= i)."""
    planes = bit_planes(y, bits)
    for i in range(y.shape[1]):
        for k in range(bits):
            ones = np.bitwise_count(planes[:, i:] & planes[k, i]).sum(-1, dtype=np.int64)
            for m in range(bits):
                acc[(k + m) // LIMB, i, i:] += ones[m] << ((k + m) % LIMB)


def scatter(vectors: DataFrame, facts: Columns) -> np.ndarray:
    """Exact sums over all rows of products of shifted columns, a d x d matrix of Python integers."""
    d = len(facts.low)
    bits = max(1, int((facts.high - facts.low).max()).bit_length())
    limbs = (2 * bits - 2) // LIMB + 1
    rows = max(64, CHUNK_BYTES // (8 * d * bits) * 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((limbs, d, d), np.int64)
        held: list[np.ndarray] = []
        for batch in batches:
            held += [x - facts.low for size, _, x in finite_rows(batch.column(0)) if size == d]
            if sum(map(len, held)) >= rows:
                y, held = np.concatenate(held), []
                for a in range(0, len(y), rows):
                    add_scatter(acc, y[a:a + rows], bits)
        if held:
            y = np.concatenate(held)
            for a in range(0, len(y), rows):
                add_scatter(acc, y[a:a + rows], bits)
        limb, i, j = np.nonzero(acc)
        yield _record(limb=limb, i=i, j=j, v=acc[limb, i, j])

    got = map_batches(vectors.select("embedding"), run, "limb long, i long, j long, v long").groupBy("limb", "i", "j").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    out = np.zeros((d, d), object)
    for r in got:
        out[r["i"], r["j"]] += int(r["v"]) << (LIMB * r["limb"])
    return out + np.triu(out, 1).T


@dataclass
class Whitening:
    """Projection of shifted integers on unit-variance components."""
    facts: Columns
    mean: np.ndarray         # of the shifted columns
    project: np.ndarray      # d x components, divided by the deviation along each
    explained: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.facts.low) - self.mean) @ self.project


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of all usable rows of ``vectors``; None if nothing varies."""
    facts = column_facts(vectors)
    if facts is None:
        return None
    s = np.array(facts.shifted, object)
    centred = facts.n * scatter(vectors, facts) - np.outer(s, s)
    v = np.array([[c / facts.n ** 2 for c in row] for row in centred.tolist()], np.float64)
    e, u = np.linalg.eigh(v)
    order = [k for k in np.argsort(-e, kind="stable")[:components] if e[k] > RANK * e.max()]
    if e.max() <= 0 or not order:
        return None
    e, u = e[order], u[:, order]
    u = u * np.sign(u[np.abs(u).argmax(0), np.arange(len(order))])
    mean = np.array([t / facts.n for t in facts.shifted])
    return Whitening(facts, mean, u / np.sqrt(e), e / np.trace(v))


def identity_error(vectors: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured on all rows."""
    d, k = w.project.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for size, _, x in finite_rows(batch.column(0)):
                if size == d:
                    z = w(x)
                    total[0] += z.sum(0)
                    total[1:] += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "v"])

    # decimal sums do not depend on the order in which tasks end
    got = map_batches(vectors.select("embedding"), run, "at long, v double").groupBy("at").agg(
        F.sum(F.col("v").cast("decimal(38,15)")).cast("double").alias("v")).collect()
    total = np.zeros((k + 1) * k)
    for r in got:
        total[r["at"]] = r["v"]
    total = total.reshape(k + 1, k) / w.facts.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def deviations(x: np.ndarray, facts: Columns) -> pa.Array:
    """Sum over dimensions of (n * x - S)^2, exact; null beyond a long."""
    s = facts.shifted
    if facts.n * int((facts.high - facts.low).max()) >= 1 << 62:
        t = (x - facts.low).astype(object) * facts.n - np.array(s, object)
    else:
        t = (x - facts.low) * facts.n - np.array(s, np.int64)
    near = (t.astype(np.float64) ** 2).sum(1)
    if t.dtype != object and near.max(initial=0) < 1 << 62:
        return pa.array((t * t).sum(1))
    out: list[int | None] = [None] * len(t)
    for r in np.flatnonzero(near < 1e19):
        value = sum(int(c) ** 2 for c in t[r])
        out[r] = value if value < 1 << 63 else None
    return pa.array(out, pa.int64())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, {SCHEMA}"
    w = fit(vectors, components)
    if w is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, w)
    d, k = w.project.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, row, x in finite_rows(batch.column(1)):
                if size != d:
                    continue
                at = pa.array(np.repeat(np.arange(len(row)), k))
                rows = len(row) * k
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)).take(at),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(row))),
                     pa.array(np.full(rows, w.facts.n)), deviations(x, w.facts).take(at), pa.array(w(x).ravel()),
                     pa.array(np.tile(w.explained, len(row))), pa.array(np.full(rows, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_batches(vectors.select("vec_id", "embedding"), run, schema)
