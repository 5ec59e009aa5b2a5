"""Dense-vector reuse: U2 encoders, D3 over embeddings, G2 nearest earlier entry.

The similarity join is exact (``operators.metric_join``): cells around pivots, cell pairs beyond reach never
routed, blocks of bounded size inside a cell.  ``warm`` entries come from earlier requests (``sources.store``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachescope.operators.metric_join import BLOCK_ROWS, metric_pairs
from cachescope.operators.reuse import _serve, first_come
from cachescope.session import cut_lineage

TURN_ROWS = 1 << 16  # requests that are resolved at once against what is stored before them


def fold_vectors(vecs: DataFrame) -> DataFrame:
    """(scope, id, rid): identical vectors of a scope share the first id."""
    k = vecs.select("scope", "id", F.sha2(F.to_json("vec"), 256).alias("_vk"))
    firsts = k.groupBy("scope", "_vk").agg(F.min("id").alias("rid"))
    return k.join(firsts, ["scope", "_vk"]).select("scope", "id", "rid")


def vector_reuse(reqs: DataFrame, threshold: float, scope: Column | str = "run_id", id_col: str = "seq",
                 vec_col: str = "embedding", store: str = "misses", metric: str = "cosine",
                 block_rows: int = BLOCK_ROWS, warm: DataFrame | None = None, turn_rows: int = TURN_ROWS) -> DataFrame:
    """D3 over embeddings: scope, id, reuse_hit, served_id, similarity.

    ``metric``: 'cosine', or 'distance' (1 - d^2 / 4 of the vectors as they are).  ``warm`` (scope, id,
    embedding): entries stored before the first request; their ids are below all requests'."""
    return vector_reuse_step(reqs, threshold, scope, id_col, vec_col, store, metric, block_rows, warm, turn_rows)[0]


def vector_reuse_step(reqs: DataFrame, threshold: float, scope: Column | str = "run_id", id_col: str = "seq",
                      vec_col: str = "embedding", store: str = "misses", metric: str = "cosine",
                      block_rows: int = BLOCK_ROWS, warm: DataFrame | None = None,
                      turn_rows: int = TURN_ROWS) -> tuple[DataFrame, DataFrame]:
    """``vector_reuse`` and the entries (scope, id, embedding) that these requests add to the store.

    Requests meet stored entries and each other; stored entries are never paired again.  Where only misses are
    stored, requests take turns of about ``turn_rows`` in the order of their ids: a turn meets itself and the misses
    before it, never the requests that were served, so the pairs grow with the requests and not with their square."""
    if store not in ("misses", "all"):
        raise ValueError("store must be 'misses' or 'all'")
    scope_c = F.col(scope) if isinstance(scope, str) else scope
    reqs = reqs.select(scope_c.cast("string").alias("scope"), F.col(id_col).alias("id"), F.col(vec_col).alias("embedding"))
    turns = -(-reqs.count() // turn_rows) if store == "misses" else 1
    if turns <= 1:
        return _turn(reqs, threshold, store, metric, block_rows, warm)
    cuts = reqs.agg(F.percentile_approx("id", [k / turns for k in range(1, turns)], 10_000)).first()[0]
    bounds = sorted(set(cuts or []))
    reqs = cut_lineage(reqs.withColumn("turn", sum((F.coalesce(F.col("id") > c, F.lit(False)).cast("int") for c in bounds), F.lit(0))))
    copies = cut_lineage(fold_vectors(reqs.withColumnRenamed("embedding", "vec")).where(F.col("rid") < F.col("id")))
    served, added = [], []
    for k in range(len(bounds) + 1):
        mine, own = reqs.where(F.col("turn") == k).drop("turn"), []
        if added:
            # a copy of an entry that an earlier turn stored needs no comparison
            have = reduce(DataFrame.unionByName, added).select("scope", F.col("id").alias("rid")).distinct()
            same = copies.join(have, ["scope", "rid"], "left_semi").groupBy("scope", "id").agg(F.min("rid").alias("rid"))
            same = cut_lineage(mine.select("scope", "id").join(same, ["scope", "id"]))
            own = [same.select("scope", "id", F.lit(True).alias("reuse_hit"), F.col("rid").alias("served_id"),
                               F.lit(1.0).alias("similarity"))]
            mine = mine.join(same, ["scope", "id"], "left_anti")
        before = [*([warm] if warm is not None else []), *added]
        got, new = _turn(mine, threshold, store, metric, block_rows, reduce(DataFrame.unionByName, before) if before else None)
        served += [*own, cut_lineage(got)]
        added.append(cut_lineage(new))
    return reduce(DataFrame.unionByName, served), reduce(DataFrame.unionByName, added)


def _turn(reqs: DataFrame, threshold: float, store: str, metric: str, block_rows: int,
          warm: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """``vector_reuse_step`` of requests (scope, id, embedding) that are paired at once."""
    scope_c, id_col, vec_col = F.col("scope"), "id", "embedding"
    vecs = reqs.select(scope_c.cast("string").alias("scope"), F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    members = cut_lineage(fold_vectors(vecs))
    rep_ids = members.where(F.col("id") == F.col("rid")).select("scope", "id")
    reps = vecs.join(rep_ids, ["scope", "id"], "left_semi")
    both = reps.withColumn("fresh", F.lit(True))
    nodes = rep_ids
    if warm is not None:
        old = warm.select(F.col("scope").cast("string").alias("scope"), F.col("id").cast(vecs.schema["id"].dataType).alias("id"),
                          F.col("embedding").alias("vec"))
        both = both.unionByName(old.withColumn("fresh", F.lit(False)))
        nodes = rep_ids.unionByName(old.select("scope", "id"))
    # of a request that everything stored may answer only the best entry matters
    pairs = cut_lineage(metric_pairs(both, threshold, metric, block_rows, best_only=store == "all"))
    stored = nodes.withColumn("is_miss", F.lit(True)) if store == "all" else first_come(nodes, pairs)
    served = _serve(reqs, "scope", id_col, pairs, members, stored, store)
    added = reps.join(stored.where("is_miss"), ["scope", "id"], "left_semi").select(
        "scope", "id", F.col("vec").alias("embedding"))
    return served, added


# --------------------------------------------------------------------------
# encoders (U2)
# --------------------------------------------------------------------------

ENCODERS: dict[str, Callable[..., Column]] = {}


def register_encoder(name: str, fn: Callable[..., Column]) -> None:
    """Register a text -> ARRAY<FLOAT> encoder, typically a ``pandas_udf``
    wrapping the user's model (loaded once per Python worker)."""
    ENCODERS[name] = fn


def embed_text(docs: DataFrame, text_col: str = "prompt", encoder: str = "hashed_tfidf",
               dim: int = 256, out_col: str = "embedding") -> DataFrame:
    """Add an embedding column.

    The built-in ``hashed_tfidf`` encoder is a Spark ML pipeline
    (RegexTokenizer -> HashingTF -> IDF -> Normalizer), JVM-side and fitted on
    the data itself; the result is a unit ARRAY<FLOAT> of ``dim`` entries.
    Other names are looked up in the encoder registry.
    """
    if encoder == "hashed_tfidf":
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
        from pyspark.ml.functions import vector_to_array
        pipe = Pipeline(stages=[
            RegexTokenizer(inputCol="_text", outputCol="_tok", pattern=r"\p{L}+|[0-9]+", gaps=False),
            HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dim),
            IDF(inputCol="_tf", outputCol="_idf"),
            Normalizer(inputCol="_idf", outputCol="_n", p=2.0)])
        docs = docs.withColumn("_text", F.coalesce(text_col, F.lit("")))
        out = pipe.fit(docs).transform(docs)
        return out.withColumn(out_col, vector_to_array("_n", "float32")).drop("_text", "_tok", "_tf", "_idf", "_n")
    if encoder not in ENCODERS:
        raise ValueError(f"Unknown encoder '{encoder}'. Available: {sorted(['hashed_tfidf', *ENCODERS])}")
    return docs.withColumn(out_col, ENCODERS[encoder](F.col(text_col)))
