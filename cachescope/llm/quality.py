"""Operator 9 [native]: quality rules by a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams (every ``N`` code points in a row of every word, with a
blank on both sides of it: a word gives as many as it has code points): the trusted target, from documents that a labels table
marks as good, and the raw corpus, from all documents.  A document's score is the
sum over its n-grams of ``log(p_target / p_raw)`` with additive smoothing, by ``N`` code points
of its words (n-grams overlap; so many hold one without overlap); it is kept at
``score >= threshold``.  Countable base rules (length, repetition) go first.

Only DataFrame functions.  One pass counts: an explode that is summed per bucket
before the shuffle, per word first (a row a distinct word of a task), then per bucket.  Words above ``LONG`` code points are cut by
a regular expression, in linear time.  The weights are one array of
``BUCKETS`` doubles, read as a scalar subquery, so scoring is a map
without shuffle or join.  The scores of the commonest word of each of ``MEMO`` hash slots are a second
such array: a word whose 64-bit hash stands there is looked up, every other word is summed over its n-grams,
with the same result.  Every document labelled good is trusted, however many there are: up to
``BROADCAST_IDS`` ids are broadcast, more of them meet the documents in a shuffle join.

Defined results: a null text has no words, symbols or lines and fails the base
rules; a text without words scores 0; without trusted documents every score is 0
and only base rules decide; rows that repeat a ``doc_id`` count and are
judged one by one; a null ``doc_id`` is never trusted; an empty table gives an empty
result.  Columns beside ``doc_id`` and ``text`` are carried through by ``keep_good`` and
never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachescope.llm.common import WORD, materialise

N = 3
LONG = 64
BUCKETS = 1 << 16
SMOOTHING = 1.0
THRESHOLD = -1.0
BROADCAST_IDS = 1_000_000    # ids that are broadcast, 8 bytes and their slots each
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
MEMO = 1 << 17           # slots of common words whose score is kept


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _slot(h: Column) -> Column:
    return h.bitwiseAND(F.lit(MEMO - 1)).cast("int")


def _buckets(word: Column) -> Column:
    """Buckets of all n-grams of a word between blanks, in order."""
    def short(edged: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(edged) - (N - 1)), lambda i: _bucket(F.substring(edged, i, F.lit(N))))

    def long(edged: Column) -> Column:           # a code point at a time, with those behind it
        return F.transform(F.regexp_extract_all(edged, F.lit(f"(?s)(?=(.{{{N}}}))."), F.lit(1)), _bucket)

    # inside the lambda the word with its edges is a value, not an expression of every n-gram
    edged = F.array(F.concat(F.lit(" "), word, F.lit(" ")))
    return F.get(F.transform(edged, lambda e: F.when(F.length(e) <= LONG + 2, short(e)).otherwise(long(e))), F.lit(0))


def _word_score(word: Column, weights: Column) -> Column:
    return F.aggregate(_buckets(word), F.lit(0.0), lambda a, g: a + F.get(weights, g))


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_words``, their hashes ``_h`` and the countable base columns, whole texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.withColumn("_words", F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)))
    d = d.withColumn("n_words", F.size("_words").cast("long"))
    d = d.withColumn("word_chars", F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)))
    d = d.withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
    d = d.withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)))
    d = d.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    # windows of three words by the hashes of the words; only texts with a repeated window sort them
    d = d.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    none = F.array().cast("array<bigint>")
    d = d.withColumn("_w", F.when(F.size("_h") >= 3, F.transform(
        F.slice("_h", 3, F.size("_h")),
        lambda h, i: F.xxhash64(F.get("_h", i), F.get("_h", i + 1), h))).otherwise(none))
    pairs = F.when(F.size(F.array_distinct("_w")) < F.size("_w"), F.sort_array(
        F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    d = d.withColumn("_pairs", pairs)
    near = F.filter("_pairs", lambda x, i: (x["h"] == F.get("_pairs", i - 1)["h"])
                    | (x["h"] == F.get("_pairs", i + 1)["h"]))
    d = d.withColumn("_starts", F.sort_array(F.transform(near, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_starts", lambda s, i: F.least(F.lit(3), F.coalesce(F.get("_starts", i + 1) - s, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "_lines", "_w", "_pairs", "_starts")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good."""
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def vocabulary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(w, raw, target): how often each word stands in the corpus and in the trusted documents."""
    ids = materialise(trusted_ids(labels).select(F.col("doc_id").alias("_good")), "trusted-ids")
    small = ids.count() <= BROADCAST_IDS
    d = docs.select("doc_id", "text").join(F.broadcast(ids) if small else ids, F.col("doc_id") == F.col("_good"), "left")
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1))
    words = d.select(F.col("_good").isNotNull().cast("long").alias("t"), F.explode(words).alias("w"))
    return words.select("w", "t").groupBy("w").agg(F.count("*").alias("raw"), F.sum("t").alias("target"))


def ngram_weights(words: DataFrame) -> DataFrame:
    """One row: ``weights`` array of BUCKETS log ratios target against raw corpus, from a ``vocabulary``."""
    grams = words.select("raw", "target", F.explode(_buckets(F.col("w"))).alias("b"))
    counts = materialise(grams.groupBy("b").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")), "ngrams")
    totals = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("nr"),
                        F.coalesce(F.sum("target"), F.lit(0)).alias("nt")).first()
    nr, nt = float(totals["nr"]), float(totals["nt"])
    every = words.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(counts, "b", "left").select(
        "b", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    ratio = (F.log((F.col("target") + SMOOTHING) / (nt + SMOOTHING * BUCKETS))
             - F.log((F.col("raw") + SMOOTHING) / (nr + SMOOTHING * BUCKETS)))
    value = ratio if nt else F.lit(0.0)
    packed = F.sort_array(F.collect_list(F.struct("b", value.alias("v"))))
    return every.agg(F.transform(packed, lambda x: x["v"]).alias("weights"))


def word_memo(words: DataFrame, weights: DataFrame) -> DataFrame:
    """One row: ``keys`` and ``scores``, the hash and summed weight of the commonest word of each of MEMO slots."""
    h = F.xxhash64("w")
    top = words.select(_slot(h).alias("slot"), "w", "raw", h.alias("h")).groupBy("slot").agg(
        F.max_by(F.struct("w", "h"), F.struct("raw", "h")).alias("top"))
    top = top.withColumn("_weights", weights.select("weights").scalar()).select(
        "slot", F.col("top.h").alias("h"), _word_score(F.col("top.w"), F.col("_weights")).alias("s"))
    every = words.sparkSession.range(MEMO).select(F.col("id").cast("int").alias("slot")).join(top, "slot", "left")
    packed = every.agg(F.sort_array(F.collect_list(F.struct("slot", "h", "s"))).alias("m"))
    return packed.select(F.transform("m", lambda x: x["h"]).alias("keys"), F.transform("m", lambda x: x["s"]).alias("scores"))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr, base_failed, kept."""
    words = materialise(vocabulary(docs, labels), "vocabulary")
    weights = materialise(ngram_weights(words), "ngram-weights")
    memo = materialise(word_memo(words, weights), "word-memo")
    d = base_counts(docs)
    for name, table in (("weights", weights), ("keys", memo), ("scores", memo)):
        d = d.withColumn(f"_{name}", table.select(name).scalar())
    # a common word is looked up, any other is summed
    score = F.transform("_h", lambda h, i: F.when(F.get("_keys", _slot(h)) == h, F.get("_scores", _slot(h))).otherwise(
        _word_score(F.get("_words", i), F.col("_weights"))))
    total = F.aggregate(score, F.lit(0.0), lambda a, x: a + x)
    # a word has as many n-grams as code points, and a code point lies in N of them
    d = d.withColumn("llr", F.when(F.col("n_words") > 0, N * total / F.col("word_chars")).otherwise(F.lit(0.0)))
    d = d.withColumn("base_failed", base_failed())
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)).drop(
        "_words", "_h", "_weights", "_keys", "_scores")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the rules keep, same columns."""
    names = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias(f"_in_{c}") for c in names], F.col("doc_id"), F.col("text"))
    # a filter would be pushed below the projections, and their arrays would be computed again in
    # every place that names them; one that reads a generator's output is not
    kept = score_quality(inner, labels, threshold).withColumn("_keep", F.explode(F.array("kept"))).where("_keep")
    return kept.select(*[F.col(f"`_in_{c}`").alias(c) for c in names])
