"""Reuse strategies by name.

A strategy is ``Callable[[DataFrame, dict], DataFrame]``: it takes requests
(scope, seq, prompt[, embedding]) and its configuration, and returns
(scope, seq, reuse_hit, served_seq).  Strategies are plain DataFrame
transformations, so ``reqs.transform(lambda d: strategy(d, cfg))`` composes.

A semantic strategy takes its vectors from the encoder that ``embedding_model`` names, if one is registered under that
name; else from the requests' ``embedding``; else it compares TF-IDF weighted texts.  A name that is neither known nor
registered is an error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachescope.operators import reuse as U
from cachescope.operators import vectors as V

Strategy = Callable[[DataFrame, dict], DataFrame]

STRATEGIES: dict[str, Strategy] = {}


def register_strategy(name: str, fn: Strategy) -> None:
    STRATEGIES[name] = fn


def _semantic_out(r: DataFrame, scope: str) -> DataFrame:
    return r.select(F.col("scope").alias(scope), F.col("id").alias("seq"), "reuse_hit",
                    F.col("served_id").alias("served_seq"), "similarity")


def _none(reqs: DataFrame, cfg: dict) -> DataFrame:
    return U.no_reuse(reqs, cfg.get("scope", "run_id"))


def _exact(reqs: DataFrame, cfg: dict) -> DataFrame:
    return U.exact_reuse(reqs, cfg.get("scope", "run_id"))


def _semantic(reqs: DataFrame, cfg: dict, default: float = U.DEFAULT_SEMANTIC_THRESHOLD) -> DataFrame:
    scope = cfg.get("scope", "run_id")
    t = cfg.get("similarity_threshold")
    t = default if t is None else float(t)
    store = cfg.get("store", "misses")
    encoder = cfg.get("embedding_model")
    if encoder is not None and encoder not in {*U.ENCODERS, *V.ENCODERS}:
        raise ValueError(f"Unknown encoder '{encoder}'. Available: {sorted({*U.ENCODERS, *V.ENCODERS})}")
    if encoder in V.ENCODERS and cfg.get("use_embeddings", True):
        reqs = V.embed_text(reqs.drop("embedding"), "prompt", encoder)
    if "embedding" in reqs.columns and cfg.get("use_embeddings", True):
        r = V.vector_reuse(reqs, t, scope=scope, store=store, metric=cfg.get("metric", "cosine"),
                           warm=cfg.get("warm"))
    else:
        r = U.semantic_reuse(reqs, t, scope=scope, store=store)
    return _semantic_out(r, scope)


def _approx(reqs: DataFrame, cfg: dict) -> DataFrame:
    return _semantic(reqs, cfg, U.VANILLA_APPROX_THRESHOLD)


def _extended(reqs: DataFrame, cfg: dict) -> DataFrame:
    preset = cfg.get("looseness_preset")
    if preset is not None:
        if preset not in U.LOOSENESS_PRESETS:
            raise ValueError(f"Unknown looseness preset '{preset}'")
        t = U.LOOSENESS_PRESETS[preset]
    else:
        t = cfg.get("similarity_threshold", U.DEFAULT_LOOSE_THRESHOLD)
    return _semantic(reqs, {**cfg, "similarity_threshold": t}, U.DEFAULT_LOOSE_THRESHOLD)


for _n, _f in (("none", _none), ("vanilla_exact", _exact), ("custom_semantic", _semantic),
               ("vanilla_approx", _approx), ("extended", _extended)):
    register_strategy(_n, _f)


def available_strategies() -> list[str]:
    return sorted(STRATEGIES)


def load_strategy(mode: str | None) -> Strategy:
    """Strategy by name; empty or missing means ``none``; hyphens are accepted
    for underscores.  An unknown name lists the available ones."""
    name = (mode or "none").replace("-", "_")
    if name not in STRATEGIES:
        raise ValueError(f"Cache strategy '{mode}' not found. Available strategies: "
                         f"{', '.join(available_strategies())}.")
    return STRATEGIES[name]


def apply_strategy(reqs: DataFrame, cfg: dict) -> DataFrame:
    return load_strategy(cfg.get("mode")).__call__(reqs, cfg)
