"""Exact similarity self-join of dense vectors by metric-space partitions.

Both metrics are a distance bound: cosine >= t is Euclidean distance <= sqrt(2 - 2t) between unit vectors, and
``1 - d^2 / 4 >= t`` (``metric='distance'``) is d <= 2 sqrt(1 - t) between the vectors as they are.  With that
reach r:

1. Pivots: a deterministic sample of each scope (rows of smallest id hash), one for about ``CELL_ROWS`` rows; more only
   where that stays within ``MAX_PIVOTS`` for all scopes, so what is broadcast is bounded.
2. Every row goes home to its nearest pivot.  Each cell then has its covering radius.
3. A row is routed to another cell with a higher number only if a partner can be there: it lies within radius + r of that
   cell's pivot, and at most 2r further from it than from its own pivot (whoever is at home there is
   nearer to that pivot).  So every pair meets in exactly one cell, and cells beyond reach never see the row.
4. A cell is cut into blocks of ``block_rows`` rows by the hash of the id, larger ones where that made more than
   ``MAX_BLOCKS``, up to ``LONG_BLOCK_ROWS``; a group is one block against one
   other, so no task holds more than two blocks, however many rows share a cell, and a row is sent
   ``MAX_BLOCKS`` times at most, up to that block length.
5. Where routing to cells would send more rows than the blocks of a whole scope, the scope is one cell.

How much is pruned depends on the data: clusters narrower than the reach are compared inside only, whereas
vectors without any cluster structure in many dimensions all lie within reach of all pivots, and every exact
metric method compares them all.  ``routed_pairs`` counts what a join would compare.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cachescope.session import cut_lineage

CELL_ROWS = 4096
MAX_PIVOTS = 4096
BLOCK_ROWS = 8192
MAX_BLOCKS = 32
LONG_BLOCK_ROWS = 1 << 18
FEW_CELLS = 100_000      # cells of all scopes whose sizes are broadcast
TILE_ROWS = 512          # rows of a block that meet the other block at once
SLACK = 1e-6             # of the distances that decide routing, far above their rounding
METRICS = ("cosine", "distance")


def reach(threshold: float, metric: str) -> float:
    """Largest Euclidean distance of a pair with ``threshold``."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    return float(np.sqrt(max(0.0, 2 - 2 * threshold if metric == "cosine" else 4 * (1 - threshold))))


def prepared(vecs: DataFrame, metric: str) -> DataFrame:
    """``vecs`` (scope, id, vec, fresh) with double vectors, of length one for the cosine; rows without a usable
    vector (null, empty, null or non-finite entries, zero for the cosine) are dropped."""
    v = F.transform("vec", lambda x: x.cast("double"))
    d = vecs.withColumn("vec", v).where(
        (F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))
    if metric == "cosine":
        norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
        d = d.withColumn("_norm", norm).where(F.col("_norm") > 0).withColumn(
            "vec", F.transform("vec", lambda x: x / F.col("_norm"))).drop("_norm")
    return d


@dataclass
class Cells:
    """Pivots and covering radii of the scopes that have more than one cell."""
    pivots: dict[str | None, np.ndarray]
    radii: dict[str | None, np.ndarray]


def choose_pivots(d: DataFrame, cell_rows: int = CELL_ROWS) -> Cells:
    """At most about ``MAX_PIVOTS`` pivots, shared out by the scopes' rows."""
    sizes = d.groupBy("scope", F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    per = max(cell_rows, -(-total // MAX_PIVOTS))
    # vectors of several lengths in one scope are not cut
    wide = sizes.groupBy("scope").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("_dims")).where(
        (F.col("n") >= 2 * per) & (F.col("_dims") == 1)).select(F.col("scope").alias("_s"), F.floor(F.col("n") / per).alias("_k"))
    order = Window.partitionBy("scope").orderBy(F.xxhash64(F.lit("pivot"), "id"), "id")
    drawn = d.join(wide, F.col("scope").eqNullSafe(F.col("_s"))).withColumn("_r", F.row_number().over(order)).where(
        (F.col("_r") <= MAX_PIVOTS) & (F.col("_r") <= F.col("_k"))).select("scope", "_r", "vec")
    pivots: dict[str | None, list] = {}
    for r in sorted(drawn.collect(), key=lambda r: r["_r"]):
        pivots.setdefault(r["scope"], []).append(r["vec"])
    return Cells({s: np.array(p) for s, p in pivots.items()}, {})


def _by_scope_rows(cells: Cells, r: float, home_only: bool):
    """Arrow task: the cells of each row, home first; with ``home_only`` just the home and its distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scopes = np.array(batch.column(0).to_pylist(), object)
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            at = np.r_[0, np.cumsum(np.diff(batch.column(2).offsets.to_numpy()))]
            home, dist = np.zeros(len(scopes), np.int64), np.zeros(len(scopes))
            extra: list[tuple[np.ndarray, np.ndarray]] = []
            for s in set(scopes.tolist()) & set(cells.pivots):
                p = cells.pivots[s]
                rows = np.flatnonzero(scopes == s) if s is not None else np.flatnonzero([x is None for x in scopes])
                for a in range(0, len(rows), 512):
                    some = rows[a:a + 512]
                    x = np.stack([flat[at[k]:at[k + 1]] for k in some])
                    sq = (x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * x @ p.T
                    gap = np.sqrt(np.maximum(sq, 0.0))
                    home[some] = gap.argmin(1)
                    dist[some] = gap.min(1)
                    if not home_only:
                        near = (gap - dist[some][:, None] <= 2 * r + slack) & (gap <= cells.radii[s][None, :] + r + slack)
                        near &= np.arange(len(p))[None, :] > home[some][:, None]
                        i, c = np.nonzero(near)
                        extra.append((some[i], c))
            if home_only:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home), pa.array(dist)],
                                                 [*batch.schema.names, "cell", "gap"])
                continue
            row = np.concatenate([np.arange(len(scopes)), *[i for i, _ in extra]])
            cell = np.concatenate([home, *[c for _, c in extra]])
            guest = np.arange(len(row)) >= len(scopes)
            for a in range(0, len(row), 4096):
                part = pa.array(row[a:a + 4096])
                yield pa.RecordBatch.from_arrays(
                    [*[col.take(part) for col in batch.columns], pa.array(cell[a:a + 4096]), pa.array(guest[a:a + 4096])],
                    [*batch.schema.names, "cell", "guest"])

    slack = SLACK
    return run


def _blocks(n: Column, block_rows: int) -> Column:
    many = F.greatest(F.lit(MAX_BLOCKS), F.ceil(n / F.lit(LONG_BLOCK_ROWS)))
    return F.greatest(F.lit(1), F.least(F.ceil(n / F.lit(block_rows)), many)).cast("int")


def _cell_sizes(d: DataFrame, block_rows: int) -> DataFrame:
    """(_s, _c, _n, _homes, _guests): rows at home and blocks of both kinds of every cell, with what the cell sends."""
    sizes = d.groupBy(F.col("scope").alias("_s"), F.col("cell").alias("_c")).agg(
        F.count_if(~F.col("guest")).alias("_n"), F.count_if("guest").alias("_m"))
    sizes = sizes.select("*", _blocks(F.col("_n"), block_rows).alias("_homes"), F.when(
        F.col("_m") > 0, _blocks(F.col("_m"), block_rows)).otherwise(F.lit(0)).alias("_guests"))
    return cut_lineage(sizes.withColumn(
        "_sent", F.col("_n") * (F.col("_homes") + F.col("_guests")) + F.col("_m") * F.col("_homes")))


def routed(vecs: DataFrame, threshold: float, metric: str = "cosine", block_rows: int = BLOCK_ROWS,
           cell_rows: int = CELL_ROWS) -> DataFrame:
    """(scope, id, vec, fresh, cell, a, b, side): the rows of every group of the join.

    ``side`` 0 rows of a group meet its side 1 rows; where a = b both sides are one block, given once (side 2)."""
    kind = vecs.schema["id"].dataType.simpleString()
    base = f"scope string, id {kind}, vec array<double>, fresh boolean"
    d = cut_lineage(prepared(vecs, metric).select("scope", "id", "vec", "fresh"))
    cells = choose_pivots(d, cell_rows)
    r = reach(threshold, metric)
    if cells.pivots:
        homes = cut_lineage(d.mapInArrow(_by_scope_rows(cells, r, True), f"{base}, cell long, gap double"))
        cells.radii = {s: np.zeros(len(p)) for s, p in cells.pivots.items()}
        # one row a cell; rows of scopes that are not cut have gap 0
        for row in homes.where(F.col("gap") > 0).groupBy("scope", "cell").agg(F.max("gap").alias("r")).collect():
            cells.radii[row["scope"]][row["cell"]] = row["r"]
        rows = homes.drop("cell", "gap")
        d = rows.mapInArrow(_by_scope_rows(cells, r, False), f"{base}, cell long, guest boolean")
        sizes = _cell_sizes(d, block_rows)
        sent = sizes.groupBy("_s").agg(F.sum("_sent").alias("sent"), F.sum("_n").alias("n"))
        lost = [row["_s"] for row in sent.where(F.col("sent") > F.col("n") * _blocks(F.col("n"), block_rows)).collect()]
        if lost:
            cells = Cells({s: p for s, p in cells.pivots.items() if s not in lost}, cells.radii)
            d = rows.mapInArrow(_by_scope_rows(cells, r, False), f"{base}, cell long, guest boolean")
            sizes = _cell_sizes(d, block_rows)
    else:
        d = d.select("*", F.lit(0).cast("long").alias("cell"), F.lit(False).alias("guest"))
        sizes = _cell_sizes(d, block_rows)
    sizes = sizes.select("_s", "_c", "_homes", "_guests")
    if sizes.count() <= FEW_CELLS:
        # a shuffle by the cell would bring the rows of a large one into one task
        sizes = F.broadcast(sizes)
    d = d.join(sizes, F.col("scope").eqNullSafe(F.col("_s")) & (F.col("cell") == F.col("_c"))).drop("_s", "_c")
    d = d.withColumn("_b", F.pmod(F.xxhash64("id"), F.when(F.col("guest"), F.col("_guests")).otherwise(F.col("_homes"))).cast("int"))
    keep = ["scope", "id", "vec", "fresh", "cell"]
    # home blocks meet each other once: (a, b) with a <= b
    first = d.where(~F.col("guest")).select(*keep, F.col("_b").alias("a"), F.explode(
        F.sequence(F.col("_b"), F.col("_homes") - 1)).alias("b"))
    first = first.select(*keep, "a", "b", F.when(F.col("a") == F.col("b"), 2).otherwise(0).alias("side"))
    last = d.where(~F.col("guest") & (F.col("_b") > 0)).select(*keep, F.explode(
        F.sequence(F.lit(0), F.col("_b") - 1)).alias("a"), F.col("_b").alias("b"), F.lit(1).alias("side"))
    # guest blocks, numbered below zero, meet every home block
    guests = d.where("guest").select(*keep, (-1 - F.col("_b")).alias("a"), F.explode(
        F.sequence(F.lit(0), F.col("_homes") - 1)).alias("b"), F.lit(0).alias("side"))
    hosts = d.where(~F.col("guest") & (F.col("_guests") > 0)).select(*keep, F.explode(F.sequence(F.lit(0), F.col("_guests") - 1)).alias("_g"),
                                            F.col("_b").alias("b")).select(*keep, (-1 - F.col("_g")).alias("a"), "b",
                                                                           F.lit(1).alias("side"))
    return first.unionByName(last).unionByName(guests).unionByName(hosts)


def routed_pairs(vecs: DataFrame, threshold: float, metric: str = "cosine", block_rows: int = BLOCK_ROWS,
                 cell_rows: int = CELL_ROWS) -> int:
    """Pairs of rows that the join compares."""
    n = routed(vecs, threshold, metric, block_rows, cell_rows).groupBy("scope", "cell", "a", "b").agg(
        F.count_if(F.col("side") == 0).alias("l"), F.count_if(F.col("side") == 1).alias("r"),
        F.count_if(F.col("side") == 2).alias("s"))
    pairs = F.col("l") * F.col("r") + (F.col("s") * (F.col("s") - 1) / 2).cast("long")
    return n.agg(F.coalesce(F.sum(pairs), F.lit(0)).alias("n")).first()["n"]


def _compare(threshold: float, metric: str, best_only: bool):
    """Arrow group task: pairs of one group with the similarity, the later row first."""
    def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        if metric == "cosine":
            return np.einsum("ij,ij->i", x, y)
        return 1 - ((x - y) ** 2).sum(1) / 4

    def best(i: np.ndarray, j: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((j, -np.round(sim, 9), i))
        order = order[np.r_[True, i[order][1:] != i[order][:-1]]] if len(order) else order
        return i[order], j[order], sim[order]

    def run(key, table):
        side = table["side"].to_numpy()
        ids = table["id"].to_numpy()
        fresh = table["fresh"].to_numpy(zero_copy_only=False).astype(bool)
        column = table["vec"].combine_chunks()
        size = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False)
        start = np.r_[0, np.cumsum(size)]
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for dim in np.unique(size).tolist():           # vectors of another length are never similar
            left = np.flatnonzero((size == dim) & (side != 1))
            right = np.flatnonzero((size == dim) & (side != 0))
            if not len(left) or not len(right):
                continue
            y = flat[start[right][:, None] + np.arange(dim)]
            for at in range(0, len(left), TILE_ROWS):
                some = left[at:at + TILE_ROWS]
                x = flat[start[some][:, None] + np.arange(dim)]
                sims = x @ y.T
                if metric == "distance":
                    sims = 1 - ((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * sims) / 4
                r, c = np.nonzero(sims >= threshold - 1e-9 * max(1.0, float(np.abs(sims).max())))
                once = (ids[some[r]] != ids[right[c]]) & ((side[some[r]] != 2) | (ids[some[r]] > ids[right[c]]))
                r, c = r[once], c[once]
                value = exact(x[r], y[c])
                hit = value >= threshold
                a, b, value = some[r[hit]], right[c[hit]], value[hit]
                # a stored row is before every fresh one; two stored rows are never compared
                swap = np.where(fresh[a] == fresh[b], ids[a] < ids[b], fresh[b])
                a, b = np.where(swap, b, a), np.where(swap, a, b)
                use = fresh[a]
                tile = ids[a[use]], ids[b[use]], value[use]
                got.append(best(*tile) if best_only else tile)
        i, j, sim = (np.concatenate([g[k] for g in got]) if got else np.zeros(0, t)
                     for k, t in ((0, ids.dtype), (1, ids.dtype), (2, np.float64)))
        if best_only:
            i, j, sim = best(i, j, sim)
        return pa.table({"scope": pa.array([key[0].as_py()] * len(i), pa.string()), "i": i, "j": j, "sim": sim})

    return run


def metric_pairs(vecs: DataFrame, threshold: float, metric: str = "cosine", block_rows: int = BLOCK_ROWS,
                 cell_rows: int = CELL_ROWS, best_only: bool = False) -> DataFrame:
    """Pairs (scope, i, j, sim) of ``vecs`` (scope, id, vec, and ``fresh`` where there are stored rows), sim >= threshold.

    j is before i: a stored row (``fresh`` false) is before every fresh one, else the smaller id; i is always fresh.
    ``best_only`` keeps, of each i in a group, its most similar j only (for the top-1 over all groups)."""
    d = vecs if "fresh" in vecs.columns else vecs.withColumn("fresh", F.lit(True))
    kind = d.schema["id"].dataType.simpleString()
    groups = routed(d, threshold, metric, block_rows, cell_rows)
    return groups.groupBy("scope", "cell", "a", "b").applyInArrow(
        _compare(threshold, metric, best_only), f"scope string, i {kind}, j {kind}, sim double")
