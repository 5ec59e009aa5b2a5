"""Operator 11: importance resampling towards a target distribution, by segments.

Words are runs of ASCII letters and digits and of code points above 127, A-Z lower-cased; features are all
runs of one and two consecutive words, joined by one blank, hashed to ``BUCKETS`` buckets by
the CRC-32 of their UTF-8 bytes.  A bucket's gain is a thousand times the log ratio of its smoothed
shares in the target texts and in the corpus; a document's weight is the floored mean of the
gains of its features; a Gumbel key by the hash of its id makes the highest scores a draw without
replacement.

Segments: newlines are separators, so they cut a text into lines.

* Corpus counts: each task folds the equal lines of a batch, the lines meet by text (summed
  before the shuffle, so a line that fills a third of the corpus is one row a task), the features of a
  distinct line are counted once and multiplied by its occurrences.  A two-word feature across a line end is
  the last word of a line and the first of the next line with a word: those are counted apart, and
  reach the shuffle as one row a bucket and task.
* Scores: the same folding inside a batch; the gains of a distinct line are summed once, a document adds
  those of its lines and of its line ends.  CRC-32 is linear, so the code of "a b" comes from the codes of
  "a " and "b" and the length of "b": no feature is ever a string.
* Ranks: rows are range-partitioned by the order and numbered inside a partition; the partitions'
  row counts (one row each) give the offsets.  No window over the whole table, no cap.

State: ``BUCKETS`` longs on the driver and on each task; nothing else grows there.

Defined results: a null or word-less text has no feature, weight 0 and is never drawn (fewer than
``MIN_WORDS`` words); a null ``doc_id`` is hashed as the empty text and comes last among ties; repeated rows are
judged one by one and rank one after the other; an empty corpus gives an empty result, an empty target
counts zero in every bucket.  Columns beside ``doc_id`` and ``text`` are carried by ``resample_documents`` and never
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachescope.llm.common import map_batches, materialise, row_slices, utf8

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
SHORT = 64               # longer words take zlib's code one by one

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


# ---------------------------------------------------------------------------
# CRC-32 of spans, and of two spans joined
# ---------------------------------------------------------------------------

def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c.astype(np.uint32)


_T = _byte_table()


def _apply(op: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map of codes, given as four tables of 256."""
    return (op[0][c & 255] ^ op[1][(c >> 8) & 255] ^ op[2][(c >> 16) & 255] ^ op[3][c >> 24])


def _one_zero() -> np.ndarray:
    """The map of one more zero byte behind a span."""
    unit = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    return _T[unit & 255] ^ (unit >> 8)


def _zeros_up_to(n: int) -> np.ndarray:
    ops = np.zeros((n + 1, 4, 256), np.uint32)
    ops[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    one = _one_zero()
    for k in range(1, n + 1):
        ops[k] = _apply(one, ops[k - 1])
    return ops


_ZEROS = _zeros_up_to(SHORT)


def crc_shift(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Codes ``c`` after ``n`` more zero bytes each."""
    flat, at = _ZEROS.reshape(-1), np.minimum(n, SHORT) * 1024
    out = flat[at + (c & 255)] ^ flat[at + 256 + ((c >> 8) & 255)] ^ flat[at + 512 + ((c >> 16) & 255)] \
        ^ flat[at + 768 + (c >> 24)]
    left, op = np.maximum(n - SHORT, 0), _ZEROS[1]
    while left.any():
        odd = np.flatnonzero(left & 1)
        out[odd] = _apply(op, out[odd])
        left, op = left >> 1, _apply(op, op)
    return out


def crc_spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte span."""
    order = np.argsort(-np.minimum(sizes, SHORT + 1).astype(np.int16), kind="stable")
    s, n = starts[order], sizes[order]
    c = np.full(len(s), 0xFFFFFFFF, np.uint32)
    many = int((n > SHORT).sum())
    live = np.searchsorted(-n[many:], -np.arange(SHORT)) + many      # spans longer than k
    for k in range(SHORT):
        m = int(live[k])
        if m == many:
            break
        part = c[many:m]
        c[many:m] = _T[(part ^ data[s[many:m] + k]) & 255] ^ (part >> 8)
    c ^= np.uint32(0xFFFFFFFF)
    for k in range(many):
        c[k] = zlib.crc32(data[s[k]:s[k] + n[k]])
    out = np.empty_like(c)
    out[order] = c
    return out


def join_codes(first: np.ndarray, second: np.ndarray, second_size: np.ndarray) -> np.ndarray:
    """Code of "a b" from the codes of a and of b."""
    c = first ^ np.uint32(0xFFFFFFFF)
    blank = (_T[(c ^ 0x20) & 255] ^ (c >> 8)) ^ np.uint32(0xFFFFFFFF)
    return crc_shift(blank, second_size) ^ second


# ---------------------------------------------------------------------------
# lines
# ---------------------------------------------------------------------------

def fold_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lines of a text column, the line of each place, and the row of each place."""
    parts = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
    flat = parts.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    return flat.dictionary, flat.indices.to_numpy(zero_copy_only=False), row


def line_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, size and line of every word of lower-cased ``data``."""
    word = _IS_WORD[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(offsets, starts, "right") - 1


class Lines:
    """What the features need of each distinct line; ``gains`` adds the sum of a line's gains."""

    def __init__(self, lines: pa.Array, gains: np.ndarray | None = None):
        data, offsets = utf8(lines)
        n = len(lines)
        self.words = np.zeros(n, np.int64)
        self.first, self.last = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        self.first_size = np.zeros(n, np.int64)
        self.gain = np.zeros(n, np.int64)
        for lo, hi in row_slices(offsets):
            part = _LOWER[data[offsets[lo]:offsets[hi]]]
            s, z, line = line_words(part, offsets[lo:hi + 1] - offsets[lo])
            if not len(s):
                continue
            ends = np.r_[np.flatnonzero(np.diff(line)), len(line) - 1]
            begins = np.r_[0, ends[:-1] + 1]
            at = lo + line[begins]
            self.words[at], self.first_size[at] = ends - begins + 1, z[begins]
            if gains is None:
                self.first[at] = crc_spans(part, s[begins], z[begins])
                self.last[at] = crc_spans(part, s[ends], z[ends])
            else:
                code = crc_spans(part, s, z)
                self.first[at], self.last[at] = code[begins], code[ends]
                value = gains[code % BUCKETS]
                pair = np.flatnonzero(line[1:] == line[:-1])
                value[pair] += gains[join_codes(code[pair], code[pair + 1], z[pair + 1]) % BUCKETS]
                self.gain[at] = np.add.reduceat(value, begins)

    def across(self, place: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and bucket of each two-word feature across line ends."""
        full = np.flatnonzero(self.words[place] > 0)
        a, b = full[:-1], full[1:]
        same = row[a] == row[b]
        a, b = place[a[same]], place[b[same]]
        return row[full[:-1][same]], join_codes(self.last[a], self.first[b], self.first_size[b]) % BUCKETS


def _batch(line: pa.Array, bucket: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([line, pa.array(bucket, pa.int32()), pa.array(n, pa.int64())],
                                      ["line", "bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features in each bucket over all rows of ``texts`` (column text)."""
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            lines, place, row = fold_lines(batch.column(0))
            facts = Lines(lines)
            ends += np.bincount(facts.across(place, row)[1], minlength=BUCKETS)
            full = np.flatnonzero(facts.words)
            times = np.bincount(place, minlength=len(lines))[full]
            if len(full):
                yield _batch(lines.take(pa.array(full)).cast(pa.string()), np.full(len(full), -1), times)
        hit = np.flatnonzero(ends)
        yield _batch(pa.nulls(len(hit), pa.string()), hit, ends[hit])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            bucket, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            end = bucket >= 0
            np.add.at(total, bucket[end], n[end])
            for lo, hi in row_slices(offsets):
                part = _LOWER[data[offsets[lo]:offsets[hi]]]
                s, z, line = line_words(part, offsets[lo:hi + 1] - offsets[lo])
                code, times = crc_spans(part, s, z), n[lo + line]
                np.add.at(total, code % BUCKETS, times)
                pair = np.flatnonzero(line[1:] == line[:-1])
                np.add.at(total, join_codes(code[pair], code[pair + 1], z[pair + 1]) % BUCKETS, times[pair])
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit])], ["bucket", "n"])

    lines = map_batches(texts.select("text"), segments, "line string, bucket int, n long")
    lines = lines.groupBy("line", "bucket").agg(F.sum("n").alias("n"))
    got = map_batches(lines, features, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """A thousand times the log ratio of the smoothed shares, floored, by bucket."""
    s, t = bucket_counts(docs).astype(np.float64), bucket_counts(target).astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of ``docs`` with n_features and weight."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            lines, place, row = fold_lines(batch.column(len(keep)))
            facts, rows = Lines(lines, gain), batch.num_rows
            words = np.zeros(rows, np.int64)
            total = np.zeros(rows, np.int64)
            np.add.at(words, row, facts.words[place])
            np.add.at(total, row, facts.gain[place])
            at, bucket = facts.across(place, row)
            np.add.at(total, at, gain[bucket])
            n = np.maximum(2 * words - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(n), pa.array(total // np.maximum(n, 1))],
                [*keep, "n_features", "weight"])

    return map_batches(docs.select(*keep, "text"), run, f"{schema}, n_features long, weight long")


def gumbel(doc_id: str, seed: int = SEED) -> Column:
    """A thousand times a standard Gumbel draw by the hash of the id, floored."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``_place``, 1, 2, 3 ... in the given order, in as many partitions as a shuffle has.

    ``df`` is best a written table: the sampled range bounds and the numbers then rest on fixed rows.
    """
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = materialise(parts.withColumn("_part", F.spark_partition_id()).withColumn("_at", in_part), "numbered")
    sizes = parts.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    before = np.cumsum([0] + [r["n"] for r in sizes]).tolist()
    # one row a partition
    offsets = df.sparkSession.createDataFrame([(r["_part"], b) for r, b in zip(sizes, before)], "_part int, _base long")
    return parts.join(F.broadcast(offsets), "_part").withColumn("_place", F.col("_base") + F.col("_at") + 1).drop(
        "_part", "_at", "_base")


def scored(docs: DataFrame, target: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with n_features, weight and score."""
    return weigh(docs, bucket_gains(docs, target), keep).withColumn("score", F.col("weight") + gumbel("doc_id"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row; ``percent`` of the long enough rows have a rank."""
    d = scored(docs, target).withColumn("_row", F.monotonically_increasing_id())
    d = d.withColumn("_long", F.col("n_features") >= 2 * min_words - 1)
    d = materialise(d, "resample-scores")
    drawn = d.where("_long").count() * percent // 100
    # equal rows differ by their number only, so that ranges can cut among them
    d = numbered(d, F.col("_long").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
                 F.col("weight"), F.col("n_features"), F.col("_row"))
    rank = F.when(F.col("_long") & (F.col("_place") <= drawn), F.col("_place"))
    return d.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def resample_documents(docs: DataFrame, target: DataFrame, percent: int = PERCENT,
                       min_words: int = MIN_WORDS) -> DataFrame:
    """The drawn rows of ``docs``, same columns."""
    names = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias(f"_in_{c}") for c in names], F.col("doc_id"), F.col("text"))
    inner = materialise(inner.withColumn("_row", F.monotonically_increasing_id()), "resample-rows")
    d = materialise(scored(inner, target, ("doc_id", "_row")), "resample-scores")
    d = d.where(F.col("n_features") >= 2 * min_words - 1)
    drawn = d.count() * percent // 100
    d = numbered(d, F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")).where(
        F.col("_place") <= drawn).select("_row")
    return inner.join(d, "_row", "left_semi").select(*[F.col(f"`_in_{c}`").alias(c) for c in names])
