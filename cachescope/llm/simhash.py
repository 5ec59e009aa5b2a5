"""Operator 6: SimHash near-duplicates by a binary trie self-join.

1. Fingerprints: one Arrow pass over whole texts.  A-Z are lower-cased, words
   are shingled, every shingle occurrence is hashed (XXH64, seed 42) and a bit is
   1 if more than half of the hashes have it.
2. Equal fingerprints fold into one class (partial aggregation, so a large group
   of copies is one row before the shuffle).
3. Link search over distinct fingerprints.  64 bits are cut into ``max_bits + 1``
   blocks; two fingerprints within ``max_bits`` agree on one block at least, so every
   link is found inside a group of equal (block, value).  Groups of more than
   ``GROUP_ROWS`` are cut into chunks and joined chunk by chunk, so a task holds two
   chunks at most, whatever the group.  Inside, a binary trie over the sorted
   fingerprints is joined with itself: pairs of nodes descend together, the
   number of differing bits is carried along and a pair beyond the budget is
   dropped.  Tasks return a spanning star of each component they found, not pairs.
4. Components over those stars (``connected_components``).

Defined results: a null or word-less text has fingerprint zero and links like any
other; a null ``doc_id`` never is the smallest id unless its whole component has
none, then the component's id is null; rows that repeat a ``doc_id`` each
get a result row; an empty table gives an empty result.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachescope.llm.common import (
    FINE_BYTES, IS_BLANK, connected_components, map_batches, materialise, row_slices, stars, utf8, word_bounds,
)

SHINGLE = 4
MAX_BITS = 4
SEED = 42
GROUP_ROWS = 8192

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


# ---------------------------------------------------------------------------
# fingerprints
# ---------------------------------------------------------------------------

def fingerprint_rows(data: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    """Unsigned fingerprints of the rows."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(data):
        return out
    data = _LOWER[data]
    starts, ends = word_bounds(data, offsets)
    if not len(starts):
        return out
    # words of the slice with one space behind each
    width = ends - starts + 1
    new_end = np.cumsum(width) - 1
    new_start = new_end - (width - 1)
    text = np.full(int(new_end[-1]) + 1, 0x20, np.uint8)
    body = np.ones(len(text), bool)
    body[new_end] = False
    text[body] = data[~IS_BLANK[data]]
    first = np.searchsorted(starts, offsets)            # first word of each row
    words = np.diff(first)
    shingles = np.where(words >= shingle, words - shingle + 1, (words > 0).astype(np.int64))
    rows = np.flatnonzero(shingles)
    count = shingles[rows]
    at = np.cumsum(count) - count
    k = np.arange(int(count.sum())) - np.repeat(at, count) + np.repeat(first[:-1][rows], count)
    last = k + np.repeat(np.minimum(words[rows], shingle), count) - 1
    view, digest = memoryview(text.tobytes()), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(view[a:b], SEED) for a, b in zip(new_start[k].tolist(), new_end[last].tolist())),
                         np.uint64, len(k))
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.add.reduceat(bits, at, axis=0, dtype=np.int64)
    set_ = (2 * ones > count[:, None]).astype(np.uint8)
    out[rows] = np.packbits(set_, axis=1).reshape(-1).view(">u8").astype(np.uint64)
    return out


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", into: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed long in ``into``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", `{into}` long"
    names = [*docs.columns, into]
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            fp = np.zeros(batch.num_rows, np.uint64)
            for lo, hi in row_slices(offsets, FINE_BYTES):
                fp[lo:hi] = fingerprint_rows(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], shingle)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp.view(np.int64))], names)

    return map_batches(docs, run, schema)


# ---------------------------------------------------------------------------
# trie self-join
# ---------------------------------------------------------------------------

def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def trie_links(keys: np.ndarray, fps: np.ndarray, budget: int, small: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of equal key whose fingerprints differ in ``budget`` bits at most.

    Rows are sorted by (key, fingerprint); a trie node is a range of rows that
    share a prefix.  The frontier starts with (root, root) of each key and
    descends a bit a step; small node pairs are compared row by row.
    """
    n = len(fps)
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    a_lo, a_hi = heads, np.r_[heads[1:], n]
    b_lo, b_hi, err = a_lo, a_hi, np.zeros(len(heads), np.int64)
    left, right = [], []

    def compare(al, ah, bl, bh):
        wide, high = ah - al, bh - bl
        size = wide * high
        step = 1_000_000
        part = np.cumsum(size) // step
        for p in np.unique(part):
            m = part == p
            s, w = size[m], high[m]
            k = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
            i = np.repeat(al[m], s) + k // np.repeat(w, s)
            j = np.repeat(bl[m], s) + k % np.repeat(w, s)
            ok = i < j
            i, j = i[ok], j[ok]
            ok = _popcount(fps[i] ^ fps[j]) <= budget
            left.append(i[ok]), right.append(j[ok])

    for depth in range(64):
        few = (a_hi - a_lo) * (b_hi - b_lo) <= small * small
        if few.any():
            compare(a_lo[few], a_hi[few], b_lo[few], b_hi[few])
            go = ~few
            a_lo, a_hi, b_lo, b_hi, err = a_lo[go], a_hi[go], b_lo[go], b_hi[go], err[go]
        if not len(a_lo):
            break
        ones = np.r_[0, np.cumsum((fps >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64)]
        a_mid = a_hi - (ones[a_hi] - ones[a_lo])
        b_mid = b_hi - (ones[b_hi] - ones[b_lo])
        same = (a_lo == b_lo) & (a_hi == b_hi)
        frontier = [(a_lo, a_mid, b_lo, b_mid, err), (a_mid, a_hi, b_mid, b_hi, err),
                    (a_lo, a_mid, b_mid, b_hi, err + 1),
                    tuple(x[~same] for x in (a_mid, a_hi, b_lo, b_mid, err + 1))]
        a_lo, a_hi, b_lo, b_hi, err = (np.concatenate(x) for x in zip(*frontier))
        live = (a_lo < a_hi) & (b_lo < b_hi) & (err <= budget)
        a_lo, a_hi, b_lo, b_hi, err = a_lo[live], a_hi[live], b_lo[live], b_hi[live], err[live]
    if len(a_lo):
        compare(a_lo, a_hi, b_lo, b_hi)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links that connect exactly the components of the ``max_bits`` graph over column ``fp``."""
    blocks = max_bits + 1
    cuts = [round(64 * k / blocks) for k in range(blocks + 1)]
    values = F.array(*[
        F.struct(F.lit(k).cast("byte").alias("block"),
                 F.shiftrightunsigned(F.shiftleft("fp", cuts[k]), 64 - (cuts[k + 1] - cuts[k])).alias("value"))
        for k in range(blocks)])
    rows = distinct.select("fp", F.explode(values).alias("g")).select("fp", "g.block", "g.value")
    large = (rows.groupBy("block", "value").count().where(F.col("count") > group_rows)
             .select("block", "value", F.ceil(F.col("count") / group_rows).cast("int").alias("chunks")))
    large = materialise(large, "simhash-large")
    rows = rows.join(large, ["block", "value"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    key = F.xxhash64("block", "value", F.least("own", "other"), F.greatest("own", "other"))
    rows = rows.select(key.alias("key"), "fp", "block", "value")
    # the key is a hash: rows of different groups that share one are still compared rightly
    rows = rows.select("key", "fp").repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            fps = fps.view(np.uint64)
            order = np.lexsort((fps, keys))
            keys, fps = keys[order], fps[order]
            i, j = trie_links(keys, fps, max_bits)
            # a spanning star of each component found
            root = stars(len(fps), i, j)
            node = np.flatnonzero(root != np.arange(len(fps)))
            return pa.RecordBatch.from_arrays([pa.array(fps[root[node]].view(np.int64)),
                                               pa.array(fps[node].view(np.int64))], ["a", "b"])

        held_k, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            k = np.r_[held_k, batch.column(0).to_numpy(zero_copy_only=False)]
            f = np.r_[held_f, batch.column(1).to_numpy(zero_copy_only=False)]
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1], "left"))     # the last group may go on
            if cut:
                yield links(k[:cut], f[:cut])
            held_k, held_f = k[cut:], f[cut:]
        if len(held_k):
            yield links(held_k, held_f)

    return map_batches(rows, run, "a long, b long").where("a <> b").distinct()


def fingerprint_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """From (doc_id, fp): one row a distinct fingerprint with its component's id and keeper.

    ``component_id`` is the smallest doc_id of the component, ``keep_fp`` the
    fingerprint of the row that carries it.
    """
    classes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    links = materialise(fingerprint_links(classes.select("fp"), max_bits), "simhash-links")
    comp = connected_components(links)
    joined = classes.join(comp, F.col("fp") == F.col("id"), "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component"))
    joined = materialise(joined, "simhash-joined")
    heads = joined.groupBy("component").agg(
        F.min("rep").alias("component_id"),
        F.min(F.struct(F.col("rep").isNull().alias("n"), "rep", "fp")).getField("fp").alias("keep_fp"))
    return joined.join(heads, "component").select("fp", "component_id", "keep_fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, kept (the component's one representative)."""
    fps = materialise(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "simhash-fp")
    out = fps.join(fingerprint_components(fps, max_bits), "fp")
    return out.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("keep_fp"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id (one row of it)."""
    names = docs.columns
    fps = materialise(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "simhash-fp")
    keep = fingerprint_components(fps, max_bits).where(F.col("fp") == F.col("keep_fp"))
    keep = materialise(keep.select(F.col("fp").alias("_fp"), F.col("component_id").alias("_keep_id")), "simhash-keep")
    # columns of any name travel under a number
    inner = docs.select(*[docs[f"`{c}`"].alias(f"c{k}") for k, c in enumerate(names)])
    at_id, at_text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    marked = with_fingerprint(inner, shingle, at_text, "_fp")
    rows = marked.join(keep, "_fp").where(F.col(at_id).eqNullSafe(F.col("_keep_id"))).dropDuplicates(["_fp"])
    return rows.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
