"""H2: the declared contract of run documents, as a table of rules over VARIANT values.

A contract is text, one line a field: its path, its types and its constraints.  ``rules`` turns it into rows
(path, kind, argument); ``contract_violations`` evaluates the rows on parsed documents and returns one row a violation.
Fields below ``items[]`` are checked on every element, which a variant table function unnests, so a
document of many items is not one long expression.

Kinds, with the meaning of JSON Schema: ``required`` (the parent is an object without the field), ``additional`` (a
closed object holds an undeclared field; the path names it), ``type`` (JSON null is a type of its own; 2.0 is an
integer), ``enum``, ``minimum``, ``maximum``, ``min_length``.  A constraint holds where the field is absent or of
another type.  Two layouts: ``DECLARED`` (the published schema) and ``WRITTEN`` (what a run writes).  ``document`` itself
that is no JSON object violates ``type`` with an empty path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of the two layouts, with types and constraints.
DECLARED = """
run                              object   required closed
run.id                           string   required min_length=1
run.seed                         integer  required
run.notes                        string
run.started_at                   string   required
run.completed_at                 string   required
run.status                       string   enum=success,partial,failed
model                            object   required closed
model.provider                   string   required
model.name                       string   required
model.params                     object   required
model.params.temperature         number
model.params.top_p               number
model.params.max_tokens          integer
dataset                          object   required closed
dataset.name                     string   required
dataset.split                    string   required
dataset.slice                    object   required closed
dataset.slice.start              integer  required minimum=0
dataset.slice.limit              integer  required minimum=1
dataset.count_processed          integer  required minimum=0
cache                            object   required closed
cache.mode                       string   required enum=none,vanilla-exact,vanilla-approx,extended
cache.stats                      object   closed
cache.stats.hits                 integer  required minimum=0
cache.stats.misses               integer  required minimum=0
metrics                          object   required closed
metrics.latency_mean_sec         number   required minimum=0
metrics.latency_p95_sec          number   required minimum=0
metrics.latency_p99_sec          number   required minimum=0
metrics.cache_hit_rate           number   required minimum=0 maximum=1
metrics.bad_cache_hit_rate       number   minimum=0 maximum=1
metrics.cache_accuracy           number   minimum=0 maximum=1
metrics.cache_statistics         object   closed
metrics.cache_statistics.total_queries    integer  required minimum=0
metrics.cache_statistics.cache_hits       integer  required minimum=0
metrics.cache_statistics.cache_misses     integer  required minimum=0
metrics.cache_statistics.bad_cache_hits   integer  required minimum=0
metrics.cache_statistics.good_cache_hits  integer  required minimum=0
metrics.cache_statistics.hit_rate         number   minimum=0 maximum=1
metrics.cache_statistics.bad_hit_rate     number   minimum=0 maximum=1
metrics.cache_statistics.cache_accuracy   number   minimum=0 maximum=1
metrics.throughput_qps           number   minimum=0
metrics.correctness              number   required minimum=0 maximum=1
items                            array    required
items[]                          object   closed
items[].id                       string   required
items[].prompt                   string   required
items[].response                 string   required
items[].gold                     string
items[].latency_ms               number   required minimum=0
items[].cached                   boolean  required
items[].cache_hit_score          number
items[].error                    string
output                           object   required closed
output.dir                       string   required
output.file                      string   required
"""

WRITTEN = """
run_id                           string   required min_length=1
timestamp                        string|null   required
model                            object   required closed
model.provider                   string   required
model.name                       string|null   required
model.base_url                   string|null
model.params                     object   required
model.params.temperature         number|null
model.params.top_p               number|null
model.params.max_tokens          integer|null
dataset                          object   required closed
dataset.name                     string   required
dataset.split                    string
dataset.slice                    object   closed
dataset.slice.start              integer  minimum=0
dataset.slice.limit              integer|null  minimum=0
dataset.subset                   string|null
dataset.subsets                  array|null
cache                            object   required closed
cache.mode                       string|null   required enum=none,vanilla_exact,vanilla_approx,custom_semantic,extended,vanilla-exact,vanilla-approx,custom-semantic
cache.embedding_model            string|null
cache.similarity_threshold       number|null   minimum=0 maximum=1
cache.looseness_preset           string|null
cache.vstore                     string|null
cache.capacity                   integer|null  minimum=0
cache.eviction                   string|null
metrics                          object   required closed
metrics.latency_mean_sec         number   required minimum=0
metrics.latency_p95_sec          number   minimum=0
metrics.latency_p99_sec          number   minimum=0
metrics.cache_hit_rate           number   required minimum=0 maximum=1
metrics.bad_cache_hit_rate       number   required minimum=0 maximum=1
metrics.cache_accuracy           number   required minimum=0 maximum=1
metrics.cache_statistics         object   required closed
metrics.cache_statistics.total_queries    integer  required minimum=0
metrics.cache_statistics.cache_hits       integer  required minimum=0
metrics.cache_statistics.cache_misses     integer  required minimum=0
metrics.cache_statistics.bad_cache_hits   integer  required minimum=0
metrics.cache_statistics.good_cache_hits  integer  required minimum=0
metrics.cache_statistics.queries_with_hits  integer  minimum=0
metrics.cache_statistics.hit_rate         number   minimum=0 maximum=1
metrics.cache_statistics.bad_hit_rate     number   minimum=0 maximum=1
metrics.cache_statistics.cache_accuracy   number   minimum=0 maximum=1
metrics.throughput_qps           number   minimum=0
metrics.correctness              number   required minimum=0 maximum=1
items                            array    required
items[]                          object   closed
items[].subset                   string|null
items[].row_index                integer  required minimum=0
items[].question                 string   required
items[].expected                 array    required
items[].model_output             string|null   required
items[].latency_sec              number   required minimum=0
items[].cache_hit                boolean  required
items[].correct                  boolean  required
"""

ITEM = "items[]"
RULE_SCHEMA = "path string, kind string, argument string"


def rules(contract: str) -> list[tuple[str, str, str]]:
    """(path, kind, argument) of every rule of a contract text; the document itself has the path ''."""
    out: list[tuple[str, str, str]] = [("", "type", "object")]
    fields = [line.split() for line in contract.strip().splitlines()]
    paths = [f[0] for f in fields]
    closed = [""] + [f[0] for f in fields if "closed" in f[2:]]
    for path, types, *more in fields:
        out.append((path, "type", types))
        for m in more:
            kind, _, argument = m.partition("=")
            if kind != "closed":
                out.append((path, kind, argument))
    for top in closed:
        own = [p[len(top) + 1 if top else 0:] for p in paths if p.startswith(f"{top}." if top else "")]
        out.append((top, "additional", ",".join(n for n in own if "." not in n and "[" not in n)))
    return out


def rule_table(spark: SparkSession, contract: str) -> DataFrame:
    """The rules as a table."""
    return spark.createDataFrame(rules(contract), RULE_SCHEMA)


# ---------------------------------------------------------------------------
# evaluation: SQL text, one expression a projection (values, then their types, then the rules)
# ---------------------------------------------------------------------------

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def _type_sql(v: str) -> str:
    """object, array, string, boolean, null, integer or number; NULL where the field is absent."""
    return f"""CASE WHEN {v} IS NULL THEN NULL ELSE transform(array(schema_of_variant({v})), s -> CASE
  WHEN s LIKE 'OBJECT%' THEN 'object' WHEN s LIKE 'ARRAY%' THEN 'array' WHEN s = 'VOID' THEN 'null'
  WHEN s = 'BIGINT' OR s RLIKE '^DECIMAL[(][0-9]+,0[)]$' THEN 'integer' WHEN s LIKE 'DECIMAL%' THEN 'number'
  WHEN s = 'DOUBLE' THEN if(try_variant_get({v}, '$', 'double') % 1 = 0, 'integer', 'number') ELSE lower(s) END)[0] END"""


def _rule_sql(k: dict[str, int], path: str, shown: str, kind: str, argument: str) -> str:
    """The violation of one rule as a struct (path, kind, detail), or NULL; ``k`` numbers the paths' columns."""
    v, t = f"_v{k[path]}", f"_t{k[path]}"

    def found(where: str, detail: str = "CAST(NULL AS STRING)") -> str:
        return (f"CASE WHEN {where} THEN named_struct('path', {_quoted(shown)}, 'kind', {_quoted(kind)}, "
                f"'detail', {detail}) END")

    names = ", ".join(_quoted(x) for x in argument.replace("|", ",").split(","))
    text, number = f"try_variant_get({v}, '$', 'string')", f"try_variant_get({v}, '$', 'double')"
    if kind == "type":
        return found(f"{t} NOT IN ({names}{', ' + _quoted('integer') if 'number' in argument else ''})", t)
    if kind == "required":
        return found(f"_t{k[path.rpartition('.')[0]]} = 'object' AND {v} IS NULL")
    if kind == "enum":
        return found(f"{t} = 'string' AND {text} NOT IN ({names})", text)
    if kind == "min_length":
        return found(f"{t} = 'string' AND length({text}) < {int(argument)}", text)
    return found(f"{t} IN ('integer', 'number') AND {number} {'<' if kind == 'minimum' else '>'} {float(argument)}D", text)


def _extra_sql(k: dict[str, int], path: str, shown: str, argument: str) -> str:
    """Violations of one closed object."""
    known = ", ".join(_quoted(x) for x in argument.split(","))
    prefix = _quoted(f"{shown}." if shown else "")
    return f"""coalesce(CASE WHEN _t{k[path]} = 'object' THEN transform(
  array_sort(array_except(json_object_keys(to_json(_v{k[path]})), array({known}))),
  x -> named_struct('path', concat({prefix}, x), 'kind', 'additional', 'detail', CAST(NULL AS STRING))) END, array())"""


def _violations(d: DataFrame, keep: list[str], root: str, some: list[tuple[str, str, str, str]]) -> DataFrame:
    """``keep`` of ``d`` with one row a violation of the rules (path, shown path, kind, argument) on the VARIANT ``root``."""
    k = {p: n for n, p in enumerate(dict.fromkeys(["", *[r[0] for r in some]]))}
    values = [f"{root} AS _v{n}" if not p else f"try_variant_get({root}, '$.{p}', 'variant') AS _v{n}" for p, n in k.items()]
    kept = [f"`{c}`" for c in keep]
    d = d.selectExpr(*kept, *values)
    d = d.selectExpr(*kept, *[f"_v{n}" for n in k.values()], *[f"{_type_sql(f'_v{n}')} AS _t{n}" for n in k.values()])
    single = ",\n".join(_rule_sql(k, *r) for r in some if r[2] != "additional")
    extra = [_extra_sql(k, p, shown, a) for p, shown, kind, a in some if kind == "additional"]
    found = f"concat({', '.join([f'filter(array({single}), x -> x IS NOT NULL)', *extra])})"
    return d.selectExpr(*kept, f"inline({found})")


def contract_violations(docs: DataFrame, contract: str = WRITTEN, doc: str = "document") -> DataFrame:
    """One row a violation: the columns of ``docs`` but the document, ``item`` (position in items, else NULL), path, kind, detail."""
    keep = [c for c in docs.columns if c != doc]
    own = [(p, p, k, a) for p, k, a in rules(contract) if not p.startswith(ITEM)]
    each = [(p[len(ITEM) + 1:], p, k, a) for p, k, a in rules(contract) if p.startswith(ITEM)]
    d = docs.withColumn("_v", F.try_parse_json(doc)).withColumn("item", F.lit(None).cast("int"))
    broken = d.where(F.col("_v").isNull()).selectExpr(
        *[f"`{c}`" for c in [*keep, "item"]], "'' AS path", "'type' AS kind", "'not JSON' AS detail")
    whole = _violations(d.where(F.col("_v").isNotNull()), [*keep, "item"], "_v", own)
    parts = d.selectExpr(*[f"`{c}`" for c in keep], "try_variant_get(_v, '$.items', 'variant') AS _items").where(
        "schema_of_variant(_items) LIKE 'ARRAY%'")
    parts = parts.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("_items").outer()))
    inside = _violations(parts.select(*keep, F.col("pos").alias("item"), "value"), [*keep, "item"], "value", each)
    return reduce(DataFrame.unionByName, [broken, whole, inside])
