"""Operator 3: embedding near-duplicates by cover trees and dual traversal.

Only vectors of one label (and length) are compared, by cosine in double
precision.

1. Equal vectors fold into one class before the shuffle (a large group of copies
   is one row).
2. The classes of a label are dealt by a hash into blocks of about ``BLOCK`` rows; every pair
   of blocks of a label is one group, so a task holds two blocks at most, whatever the
   label's size, and every pair of vectors meets once.
3. In a group each block becomes a cover tree: levels with halving radii, each node
   a centre with the actual covering radius of its members.  Two trees are descended
   together: a pair of nodes is dropped if its centres are further apart than the two
   radii and the threshold distance allow, taken whole if they are
   so near that every pair of members is within, and split otherwise; single points are
   compared exactly.  Tasks return the number of links of each class and a spanning star of
   each component, never the pairs.
4. Components over the stars (``connected_components``).

For data without any cluster structure the traversal still has to look at all
pairs of centres of a label (as matrix products); that is the method's nature.

Defined results: a vector that is null, empty, zero or has null or non-finite
components, a null label or a null ``vec_id`` links with nothing and is its own
component; rows that repeat a ``vec_id`` get a row each, with the links and the component of
their own vector (only vectors whose copies have the same smallest ``vec_id`` count as one node); copies
link with each other; an empty table gives an empty result.
Only vec_id, embedding and label are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachescope.llm.common import connected_components, materialise, ship_package, stars

THRESHOLD = 0.93
BLOCK = 2048
SLACK = 1e-9             # radius of a node of equal points
ROUNDING = 1e-7          # of a distance: sqrt(2 - 2 cos) near cos = 1 is off by up to 2e-8


class CoverTree:
    """Nodes of a cover tree over unit vectors: centre, radius, members and children of each."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.members: list[np.ndarray] = []
        self.children: list[np.ndarray] = []
        root = np.arange(len(x))
        todo = [(self._node(0, root), 1.0)]
        while todo:
            node, reach = todo.pop()
            if len(self.members[node]) == 1 or self.radius[node] <= SLACK:
                continue
            while reach >= self.radius[node] > 0:        # levels that would not split the node
                reach /= 2
            kids, rest = [], self.members[node]
            while len(rest):                             # greedy cover at this level's radius
                d = self._distance(rest, rest[0])
                near = d <= reach
                near[0] = True
                kids.append(self._node(int(rest[0]), rest[near], float(d[near].max())))
                rest = rest[~near]
            self.children[node] = np.array(kids)
            todo += [(k, reach / 2) for k in kids]
        self.centre_ = np.array(self.centre)
        self.radius_ = np.array(self.radius)

    def _distance(self, rows: np.ndarray, to: int) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.x[rows] @ self.x[to])))

    def _node(self, centre: int, members: np.ndarray, radius: float | None = None) -> int:
        if radius is None:
            radius = float(self._distance(members, centre).max())
        if len(members) == 1:
            radius = 0.0
        self.centre.append(centre)
        self.radius.append(radius)
        self.members.append(members)
        self.children.append(np.zeros(0, np.int64))
        return len(self.centre) - 1

    def parts(self, node: int) -> np.ndarray:
        """Children of a node, or the node itself."""
        kids = self.children[node]
        return kids if len(kids) else np.array([node])


def dual_links(a: CoverTree, b: CoverTree, threshold: float = THRESHOLD):
    """Index pairs (row of a, row of b) with cosine >= threshold, in chunks of arrays."""
    far = np.sqrt(2.0 - 2.0 * threshold)
    todo = [(np.array([0]), np.array([0]))]
    while todo:
        na, nb = todo.pop()
        cos = a.x[a.centre_[na]] @ b.x[b.centre_[nb]].T
        d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cos))
        reach = a.radius_[na][:, None] + b.radius_[nb][None, :]
        live = d <= reach + far + ROUNDING
        single = np.array([len(a.members[n]) == 1 for n in na])[:, None] & np.array(
            [len(b.members[n]) == 1 for n in nb])[None, :]
        i, j = np.nonzero(single & (cos >= threshold))
        if len(i):
            yield a.centre_[na[i]], b.centre_[nb[j]]
        for i, j in zip(*np.nonzero(live & ~single)):
            ma, mb = a.members[na[i]], b.members[nb[j]]
            if d[i, j] + reach[i, j] <= far - ROUNDING:
                yield np.repeat(ma, len(mb)), np.tile(mb, len(ma))
                continue
            pa_, pb_ = a.parts(na[i]), b.parts(nb[j])
            if len(pa_) == 1 and len(pb_) == 1 and pa_[0] == na[i] and pb_[0] == nb[j]:
                # equal points within rounding: nothing left to split
                p, q = np.nonzero(a.x[ma] @ b.x[mb].T >= threshold)
                yield ma[p], mb[q]
            else:
                todo.append((pa_, pb_))


def unit_rows(vectors) -> np.ndarray:
    """Unit vectors in double precision (scaled first, so that no square overflows)."""
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid_vector() -> Column:
    e = F.col("embedding")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists(e, lambda v: v != 0)
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & some, F.lit(False))


def block_links(classes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(id, links, root) a class and group: links found there and a star edge (root, id)."""
    sizes = classes.groupBy("label", "dim").count().select(
        "label", "dim", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    sizes = materialise(sizes, "cover-blocks")
    rows = classes.join(sizes, ["label", "dim"])
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("label", "dim", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                       "own", "id", "copies", "embedding")
    ship_package(classes.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("own", "ascending"), ("id", "ascending")]).combine_chunks()
        n = len(table)
        ids, copies = table["id"].to_numpy(), table["copies"].to_numpy()
        x = unit_rows(table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1))
        own = table["own"].to_numpy()
        same = bool((table["lo"].to_numpy()[0] == table["hi"].to_numpy()[0]))
        cut = n if same else int(np.searchsorted(own, own[0], "right"))
        links, pairs = np.zeros(n, np.int64), []
        if same or cut < n:
            a = CoverTree(x[:cut])
            b = a if same else CoverTree(x[cut:])
            shift = 0 if same else cut
            for i, j in dual_links(a, b, threshold):
                j = j + shift
                ok = ids[i] != ids[j]
                i, j = i[ok], j[ok]
                np.add.at(links, i, copies[j])
                if not same:
                    np.add.at(links, j, copies[i])
                pairs.append((i, j))
        i, j = (np.concatenate(p) for p in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        root = stars(n, i, j)
        found = np.flatnonzero((links > 0) | (root != np.arange(n)))
        return pa.table({"id": ids[found], "links": links[found], "root": ids[root[found]]})

    return rows.groupBy("label", "dim", "lo", "hi").applyInArrow(run, "id long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows = vectors.select("vec_id", "embedding", "label", valid_vector().alias("ok"))
    classes = materialise(
        rows.where("ok").groupBy("label", "embedding").agg(
            F.min("vec_id").alias("id"), F.count("*").alias("copies"))
        .withColumn("dim", F.size("embedding")).withColumn("key", F.xxhash64("label", "embedding")), "cover-classes")
    found = materialise(block_links(classes.select("label", "dim", "id", "copies", "embedding"), threshold),
                        "cover-links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    # classes of the same smallest vec_id (repeated ids) are one node
    comp = connected_components(found.where("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b")))
    done = classes.select("key", "label", "embedding", "id", "copies").join(counts, "id", "left").join(comp, "id", "left")
    done = done.select(F.col("key").alias("k"), F.col("label").alias("l"), F.col("embedding").alias("e"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                       F.coalesce("component", "id").alias("component"))
    keyed = rows.withColumn("key", F.when(F.col("ok"), F.xxhash64("label", "embedding")))
    out = keyed.join(done, (F.col("key") == F.col("k")) & (F.col("label") == F.col("l"))
                     & (F.col("embedding") == F.col("e")), "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                     F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
