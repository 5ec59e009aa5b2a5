"""Run configurations as data.

A configuration is a nested JSON document (``run``, ``model``, ``dataset``, ``cache``, ``output``), every key optional.
``resolve_configs`` brings documents to one typed row a run, with the declared defaults; ``config_problems`` lists what a
document holds that the declaration does not know (one row a problem): not JSON, an unknown key, a value of
another type, an unsupported provider or dataset, an unknown mode.  ``model.params`` is an open map.

Both are plain projections of a VARIANT, one pass over the documents; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Path, type and default of every configuration key, and the supported names.
CONFIG_KEYS = [
    ("run.id", "string", None), ("run.seed", "bigint", None), ("run.notes", "string", None),
    ("model.provider", "string", "ollama"), ("model.name", "string", None),
    ("model.base_url", "string", "http://localhost:11434"), ("model.params", "map<string,string>", None),
    ("dataset.name", "string", "platinum-bench"), ("dataset.subset", "string", "gsm8k"),
    ("dataset.subsets", "array<string>", None), ("dataset.split", "string", "test"),
    ("dataset.slice.start", "bigint", 0), ("dataset.slice.limit", "bigint", 10),
    ("cache.mode", "string", "none"), ("cache.embedding_model", "string", None),
    ("cache.similarity_threshold", "double", None), ("cache.looseness_preset", "string", None),
    ("cache.vstore", "string", None), ("cache.capacity", "bigint", None), ("cache.eviction", "string", None),
    ("output.dir", "string", "results/raw"), ("output.filename_pattern", "string", "{run_id}.json"),
]
PROVIDERS = ["ollama"]
DATASETS = ["platinum-bench"]
MODES = ["none", "vanilla_exact", "vanilla_approx", "custom_semantic", "extended"]

COLUMNS = {"run.id": "run_id", "run.seed": "seed", "run.notes": "notes", "model.provider": "model_provider",
           "model.name": "model_name", "model.base_url": "base_url", "model.params": "params", "dataset.name": "dataset_name",
           "dataset.split": "split", "dataset.slice.start": "slice_start", "dataset.slice.limit": "slice_limit",
           "cache.mode": "cache_mode", "cache.embedding_model": "embedding_model",
           "cache.similarity_threshold": "similarity_threshold", "cache.looseness_preset": "looseness_preset",
           "cache.vstore": "vstore", "cache.capacity": "capacity", "cache.eviction": "eviction", "output.dir": "output_dir",
           "output.filename_pattern": "filename_pattern"}


def read_configs(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, config): one configuration a file, from the ``*.json`` files of ``path``."""
    raw = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.json").text(path)
    return raw.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("config"))


def _get(path: str, kind: str) -> Column:
    return F.try_variant_get("_v", f"$.{path}", kind)


def _given(path: str) -> Column:
    """The key is there and not null."""
    v = _get(path, "variant")
    return v.isNotNull() & ~F.is_variant_null(v)


def _objects() -> dict[str, list[str]]:
    """Allowed keys of each declared object, open maps left out."""
    out: dict[str, list[str]] = {"": []}
    for path, _, _ in CONFIG_KEYS:
        parts = path.split(".")
        for k in range(len(parts)):
            known = out.setdefault(".".join(parts[:k]), [])
            if parts[k] not in known:
                known.append(parts[k])
    return out


def resolve_configs(configs: DataFrame, doc: str = "config") -> DataFrame:
    """One row a configuration: run_id, the typed columns with their defaults, and ``subsets`` (the list, else
    the single subset).  ``configs`` keeps its other columns; a document that is no JSON object has defaults only
    and a NULL run_id, and stands among the problems."""
    d = configs.withColumn("_v", F.try_parse_json(doc))
    mode = {"cache.mode": lambda c: F.replace(c, F.lit("-"), F.lit("_"))}
    cols = []
    for path, kind, default in CONFIG_KEYS:
        if path in COLUMNS:
            value = _get(path, kind) if default is None else F.coalesce(_get(path, kind), F.lit(default).cast(kind))
            cols.append(mode.get(path, lambda c: c)(value).alias(COLUMNS[path]))
    many = _get("dataset.subsets", "array<string>")
    one = F.array(F.coalesce(_get("dataset.subset", "string"), F.lit("gsm8k")))
    subsets = F.when(F.size(many) > 0, many).otherwise(one)
    return d.select(*[c for c in configs.columns if c != doc], *cols, subsets.alias("subsets"))


def _keys(path: str) -> Column:
    obj = _get(path, "variant") if path else F.col("_v")
    is_object = F.schema_of_variant(obj).startswith("OBJECT")
    return F.when(is_object, F.json_object_keys(F.to_json(obj)))


def _unknown(path: str, known: list[str]) -> Column:
    extra = F.array_except(_keys(path), F.array(*[F.lit(k) for k in known]))
    extra = F.array_sort(F.coalesce(extra, F.array().cast("array<string>")))
    return F.transform(extra, lambda k: F.concat(F.lit(f"unknown:{path}." if path else "unknown:"), k))


def config_problems(configs: DataFrame, doc: str = "config") -> DataFrame:
    """One row a problem: the columns of ``configs`` but the document, ``run_id`` and ``problem``."""
    d = configs.withColumn("_v", F.try_parse_json(doc))
    found: list[Column] = []
    for path, known in _objects().items():
        if not path:
            continue
        obj = _get(path, "variant")
        found.append(F.when(_given(path) & ~F.schema_of_variant(obj).startswith("OBJECT"), F.lit(f"type:{path}")))
    for path, kind, _ in CONFIG_KEYS:
        found.append(F.when(_given(path) & _get(path, kind).isNull(), F.lit(f"type:{path}")))
    for path, names in (("model.provider", PROVIDERS), ("dataset.name", DATASETS), ("cache.mode", MODES)):
        value = F.replace(_get(path, "string"), F.lit("-"), F.lit("_")) if path == "cache.mode" else _get(path, "string")
        found.append(F.when(~value.isin(*names), F.concat(F.lit(f"unsupported:{path}:"), value)))
    unknown = [_unknown(path, known) for path, known in _objects().items()]
    problems = F.concat(F.filter(F.array(*found), lambda x: x.isNotNull()), *unknown)
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    problems = F.when(is_object, problems).otherwise(F.array(F.lit("not a JSON object")))
    return d.select(*[c for c in configs.columns if c != doc], _get("run.id", "string").alias("run_id"),
                    F.explode(problems).alias("problem"))
