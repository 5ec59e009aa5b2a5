"""Helpers shared by the training-data operators.

* ``materialise``: cut a plan by writing a table in the cluster's shared folder.
* ``connected_components``: smallest reachable id over an edge table.
* numpy views of Arrow text columns, and vectorised word splitting and hashing,
  used inside ``mapInArrow`` tasks.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cachescope.session import ensure_checkpoint_dir

#: Java regex of a word: a run of code points other than blank, tab ... carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at once inside a task (whole documents; one longer document is a slice of its own).
SLICE_BYTES = 1 << 20
#: The same for kernels that hold several numbers a byte: their arrays stay in a core's cache.
FINE_BYTES = 1 << 18
BATCH_ROWS = 2000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package (a small zip, once a Spark application), for Python tasks."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="cachescope-"), f"{top.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with this package at hand on the executors.

    ``run`` sees batches of at most ``BATCH_ROWS`` rows, so that what it holds of a batch stays small,
    and memory that a task has freed goes back to the system at its end.  Neither side of the pipe holds a larger
    batch: the session's limit of rows (10,000 by default, unlimited where it is not positive) is brought down to
    ``BATCH_ROWS``, a lower one stays.
    """
    ship_package(df.sparkSession)
    if not 0 < int(df.sparkSession.conf.get(ARROW_ROWS)) <= BATCH_ROWS:
        df.sparkSession.conf.set(ARROW_ROWS, BATCH_ROWS)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(b.slice(k, BATCH_ROWS) for b in batches for k in range(0, b.num_rows, BATCH_ROWS))
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(bounded, schema)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    The table outlives executors, cuts the lineage and is column-pruned by its
    readers.  Its folder name is unique, so reruns never meet.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id of ``edges``: the smallest id reachable.

    Alternating large-star and small-star rounds (Kiveris et al., 2014).  Each
    round is two aggregations, whose state is written to the shared folder; the
    driver receives two counters a round.  Runs until no edge changes.
    """
    def compact(e: DataFrame) -> DataFrame:
        return (e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct())

    def state(e: DataFrame):
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    cur = materialise(compact(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "cc")
    seen = state(cur)
    while True:
        # large star: neighbours above a node hang on the smallest of its neighbourhood
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        large = compact(large)
        # small star: neighbours below a node, and the node, hang on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        cur = materialise(compact(small), "cc")
        now = state(cur)
        if now == seen:
            break
        seen = now
    roots = cur.groupBy("u").agg(F.min("v").alias("component"))
    own = roots.select(F.col("component").alias("id")).distinct()
    return (roots.select(F.col("u").alias("id"), "component")
            .unionByName(own.select("id", F.col("id").alias("component"))))


def stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Root (smallest index) of each of ``n`` nodes under the links, by hooking and pointer jumping."""
    root = np.arange(n)
    while len(i):
        a, b = root[i], root[j]
        open_ = a != b
        if not open_.any():
            break
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


# ---------------------------------------------------------------------------
# text columns as numpy arrays, inside tasks
# ---------------------------------------------------------------------------

def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (a single longer row stands alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_bounds(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; ``breaks`` are positions no word may span."""
    word = ~IS_BLANK[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cut = breaks[(breaks > 0) & (breaks < len(data))]
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[key] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (wrapping 64-bit arithmetic)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: differences of one running polynomial."""
    up, down = _powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=run[1:])
    return mix64((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64))
