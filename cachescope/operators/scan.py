"""Skew-safe ordered scans: positions and running aggregates inside huge groups.

A plain ``Window.partitionBy(run_id)`` puts a whole run (which may hold a third
of all rows) into one task.  These helpers split every group into chunks along
the order column, run the window inside ``(group, chunk)`` only, and add a
carry computed from a small per-chunk table (one row per chunk).  This is the
classic two-pass prefix scan, written with DataFrame operators only.

Chunks are a function of the data and of cuts written once (no partition ids),
so a recomputed task after executor loss lands in the same chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cachescope.session import cut_lineage

CHUNK_ROWS = 1 << 18  # rows per chunk, the unit of work of one window task
FAN = 64  # chunks that one round of splitting makes of one, a power of two
SKETCH_ACCURACY = 4096  # relative rank error of a cut is one part in so many


def _keys(part: Sequence[str]) -> list[Column]:
    """Two columns a group key that equal each other for NULL keys too, so a window and a join share them."""
    return [c for i, p in enumerate(part)
            for c in (F.coalesce(F.col(p).cast("string"), F.lit("")).alias(f"_g{i}"), F.col(p).isNull().alias(f"_n{i}"))]


def _key_names(part: Sequence[str]) -> list[str]:
    return [f"_{k}{i}" for i in range(len(part)) for k in "gn"]


def _chunk_levels(keyed: DataFrame, keys: Sequence[str], chunk_rows: int) -> int:
    """How often groups are split ``FAN`` ways until the largest one is down to ``chunk_rows`` (one small job)."""
    largest = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c")).first()[0] or 0
    levels, size = 0, chunk_rows
    while size < largest:
        levels, size = levels + 1, size * FAN
    return levels


def _split(df: DataFrame, keys: Sequence[str], chunk: str, order: Column, chunk_rows: int) -> DataFrame:
    """Split every (group, chunk) of more than ``chunk_rows`` rows into at most ``FAN`` chunks of equal depth."""
    keys = [*keys, chunk]
    cuts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_c"),
        F.percentile_approx(order, [k / FAN for k in range(1, FAN)], SKETCH_ACCURACY).alias("_cuts"))
    # Sketches depend on the order in which partial ones are merged, so the cuts are written once:
    # every branch and every retried task sees the same ones.
    cuts = cut_lineage(cuts.where(F.col("_c") > chunk_rows).select(*keys, "_cuts"))
    # A row for more than chunk_rows rows of df, so the table is small for any input.  It has as few keys as there
    # are large groups: a shuffle by them would bring a whole group into one task.
    x = df.join(F.broadcast(cuts), keys, "left").withColumn("_at", F.lit(0))
    step = FAN // 2
    while step:  # binary search: how many cuts lie below the value
        x = x.withColumn("_at", F.when(F.get("_cuts", F.col("_at") + (step - 1)) < order, F.col("_at") + step)
                         .otherwise(F.col("_at")))
        step //= 2
    return x.withColumn(chunk, F.col(chunk) * FAN + F.col("_at")).drop("_cuts", "_at")


def value_chunks(df: DataFrame, part: Sequence[str], order_col: str,
                 chunk_rows: int = CHUNK_ROWS, name: str = "_chunk") -> DataFrame:
    """Add ``name``: a chunk id along ``order_col`` (numeric) inside each group.

    Chunks are of equal depth, not of equal width: cuts come from quantile sketches, and a chunk that is
    still too large is cut again by its own quantiles, so gaps and outliers of ``order_col`` do not matter.
    With different values a chunk holds less than twice ``chunk_rows`` rows; equal values share a chunk.
    Rows with a NULL value come first.  A group key may be NULL.
    """
    part = list(part)
    keys = _key_names(part)
    x = df.select("*", *_keys(part), F.lit(0).cast("long").alias(name))
    for _ in range(_chunk_levels(x, keys, chunk_rows)):
        x = _split(x, keys, name, F.col(order_col).cast("double"), chunk_rows)
    return x.drop(*keys)


def _combine(kind: str, carry: Column, local: Column) -> Column:
    if kind in ("sum", "count"):
        return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
    if kind == "max":
        return F.greatest(carry, local)
    if kind == "min":
        return F.least(carry, local)
    raise ValueError(f"unsupported running aggregate {kind!r}")


def _agg(kind: str, c: Column) -> Column:
    return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[kind](c)


def running(df: DataFrame, part: Sequence[str], order: Sequence[str], chunk: Column | str,
            specs: Sequence[tuple[str, str, Column]], inclusive: bool = True) -> DataFrame:
    """Running aggregates over ``order`` within ``part``, chunked by ``chunk``.

    ``specs``: (output name, kind in sum/count/max/min, column).  With
    ``inclusive=False`` the current row is excluded (strictly earlier rows).
    ``chunk`` must be non-decreasing along ``order`` inside a group.  Group keys may be NULL.
    """
    part, order = list(part), list(order)
    keys = _key_names(part)
    base = df.select("*", *_keys(part), (F.col(chunk) if isinstance(chunk, str) else chunk).alias("_chunk"))
    hi = 0 if inclusive else -1
    w_local = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, hi)
    x = base.select("*", *[_agg(kind, c).over(w_local).alias(f"_l_{name}") for name, kind, c in specs])
    totals = base.groupBy(*keys, "_chunk").agg(*[_agg(kind, c).alias(f"_t_{name}") for name, kind, c in specs])
    w_carry = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, "_chunk", *[
        _agg("sum" if kind == "count" else kind, F.col(f"_t_{name}")).over(w_carry).alias(f"_c_{name}")
        for name, kind, _ in specs])
    x = x.join(carry, [*keys, "_chunk"], "left")
    for name, kind, _ in specs:
        x = x.withColumn(name, _combine(kind, F.col(f"_c_{name}"), F.col(f"_l_{name}")))
    return x.drop("_chunk", *keys, *[f"_l_{n}" for n, _, _ in specs], *[f"_c_{n}" for n, _, _ in specs])


def positions(df: DataFrame, part: Sequence[str], order_col: str, name: str = "pos",
              chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """0-based position of each row inside its group by a unique numeric ``order_col``.

    Where no group is larger than a chunk, a chunk is a group and needs no carry."""
    if _chunk_levels(df, part, chunk_rows) == 0:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(order_col)).cast("long") - 1)
    x = value_chunks(df, part, order_col, chunk_rows, "_pchunk")
    x = running(x, part, [order_col], "_pchunk", [("_rank", "count", F.lit(1))], inclusive=True)
    return x.withColumn(name, (F.col("_rank") - 1).cast("long")).drop("_rank", "_pchunk")


def pos_chunk(pos_col: str = "pos", chunk_rows: int = CHUNK_ROWS) -> Column:
    """Chunk id from a dense position: at most ``chunk_rows`` rows per chunk."""
    return F.floor(F.col(pos_col) / F.lit(chunk_rows)).cast("long")
