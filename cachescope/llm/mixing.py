"""Operator 1: mix sources to target weights.

Sizes (word counts) are summed per source, a target is shared out by weight
with a repetition cap, and every document is emitted ``floor(rate)`` times plus
one more with probability ``rate - floor(rate)``, decided by a seeded hash of
its id.  Everything is DataFrame code: one text scan writes a narrow table of
sizes, the per-source table has one row a source, and the join back needs no
shuffle of the texts while that table is below the session's broadcast limit
(measured, since it is a written table); beyond it Spark merges and AQE splits
a hot source.

Defined results: a null text has size 0 (as an empty one); a null source is a
source of its own, last in order; a null ``doc_id`` is decided by its text;
rows that repeat a ``doc_id`` share one decision; an empty table gives an empty
result.  Other columns are carried through and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cachescope.llm.common import WORD, materialise

CAP = 3          # no source is repeated more than this often
WEIGHTS = (1, 2, 3)
SEED = "mix-1"


def word_count(text: str | Column = "text") -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """Weights by code-point order of the source (null last), repeating; one row a source."""
    pos = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (pos % len(weights)) + 1)
    return sources.withColumn("weight", w)


def share_targets(sources: DataFrame, cap: float = CAP, total: float = 1.0) -> DataFrame:
    """(source, source_size, target, rate) from (source, source_size, weight).

    ``total`` of all sizes is shared by weight; a target stops at ``cap`` times
    its source's size and the excess is reshared by weight among the others
    until none is above.  That is one water level: with sources in order of
    ``cap * size / weight``, the level is what is left after capping a prefix,
    over the weight of the rest, at the first source whose ratio it does not exceed
    (from there on it only falls, so it is the largest such value).
    One row a source, so the ordered window stays small.
    """
    ratio = F.when(F.col("weight") > 0, F.lit(float(cap)) * F.col("source_size") / F.col("weight")).otherwise(
        F.lit(float("inf")))
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = sources.withColumn("_ratio", ratio)
    s = s.withColumn("_capped", F.coalesce(F.sum(F.col("source_size") * float(cap)).over(before), F.lit(0.0)))
    s = s.withColumn("_all", F.sum("source_size").over(everything) * float(total))
    s = s.withColumn("_level", (F.col("_all") - F.col("_capped")) / F.sum("weight").over(after))
    s = s.withColumn("_water", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(everything))
    full = F.col("source_size") * float(cap)
    target = F.when(F.col("_water").isNull(), full).otherwise(F.least(full, F.col("_water") * F.col("weight")))
    return s.select("source", "source_size", target.cast("double").alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))


def uniform(seed: str, doc_id: str = "doc_id", text: Column | None = None) -> Column:
    """Number in [0, 1) from a seeded hash of the id (of the text where the id is null)."""
    key = F.col(doc_id).cast("string")
    if text is not None:
        key = F.coalesce(key, F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plan_mix(docs: DataFrame, weights=cyclic_weights, cap: float = CAP, total: float = 1.0,
             seed: str = SEED) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, rate, copies, taken."""
    u = F.when(F.col("doc_id").isNull(), uniform(seed, text=F.col("text"))).otherwise(uniform(seed))
    sizes = materialise(docs.select("doc_id", "source", word_count().alias("size"), u.alias("_u")), "mix-sizes")
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(share_targets(weights(per), cap, total), "mix-targets")
    t = targets.select(F.col("source").alias("_s"), "source_size", "target", "rate")
    out = sizes.join(t, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    copies = F.floor("rate") + (F.col("_u") < F.col("rate") - F.floor("rate")).cast("long")
    return out.withColumn("copies", copies.cast("long")).withColumn(
        "taken", (F.col("size") * F.col("copies")).cast("long")).drop("_u")


def mix_documents(docs: DataFrame, weights=cyclic_weights, cap: float = CAP, total: float = 1.0,
                  seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the plan says, same columns."""
    names = docs.columns
    per = materialise(docs.select("source", word_count().alias("size")).groupBy("source").agg(
        F.sum("size").alias("source_size")), "mix-sources")
    t = materialise(share_targets(weights(per), cap, total), "mix-targets").select(
        F.col("source").alias("_mix_source"), F.col("rate").alias("_mix_rate"))
    u = F.when(F.col("doc_id").isNull(), uniform(seed, text=F.col("text"))).otherwise(uniform(seed))
    # columns of any name travel under a number
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)], u.alias("_u"))
    rows = rows.join(t, F.col(f"c{names.index('source')}").eqNullSafe(F.col("_mix_source")), "left")
    rate = F.col("_mix_rate")
    copies = (F.floor(rate) + (F.col("_u") < rate - F.floor(rate)).cast("long")).cast("int")
    rows = rows.withColumn("_copies", copies).where("_copies > 0").withColumn(
        "_i", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return rows.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
