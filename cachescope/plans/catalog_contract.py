"""Registered queries of the declared document contract (H2), against literal JSON SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cachescope.plans import catalog as C
from cachescope.plans import sql as S
from cachescope.sources import contract as K
from cachescope.sources import documents as DOC
from cachescope.sources import tables as TB

register = C.register

# The document of a customer: valid in most rows, broken by rule in others.  Written once, as SQL that both engines read.
DOCUMENT_SQL = """concat(
  '{"run": {"id": "', CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('run-', c_custkey) END,
  '", "seed": ', CASE c_custkey % 5 WHEN 0 THEN '"7"' WHEN 1 THEN 'null' WHEN 2 THEN concat(c_custkey, '.5') ELSE concat(c_custkey, '') END,
  CASE WHEN c_custkey % 11 = 0 THEN ', "extra": 1' ELSE '' END, ', "started_at": "2024-01-01T00:00:00Z"',
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ', "completed_at": "2024-01-01T01:00:00Z"' END, '}',
  ', "model": {"provider": "ollama", "name": "m", "params": ',
  CASE WHEN c_custkey % 13 = 0 THEN '[1]' ELSE concat('{"any": 1, "temperature": 0.5, "max_tokens": ',
    CASE WHEN c_custkey % 4 = 0 THEN '2.5' ELSE '256' END, '}') END, '}',
  CASE WHEN c_custkey % 17 = 0 THEN '' ELSE concat(', "dataset": {"name": "d", "split": "test", "slice": {"start": ',
    c_custkey % 4 - 1, ', "limit": ', c_custkey % 3, '}, "count_processed": 5}') END,
  ', "cache": {"mode": "', CASE c_custkey % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'lru' WHEN 2 THEN 'extended' ELSE 'vanilla-exact' END,
  '", "stats": {"hits": ', c_custkey % 6 - 1, CASE WHEN c_custkey % 8 = 0 THEN '' ELSE ', "misses": 1' END, '}}',
  ', "metrics": {"latency_mean_sec": ', c_custkey % 9, '.5, "latency_p95_sec": 1, "latency_p99_sec": 1, "cache_hit_rate": ',
  CASE WHEN c_custkey % 10 = 0 THEN '1.5' ELSE '0.5' END, ', "correctness": ', CASE WHEN c_custkey % 19 = 0 THEN 'true' ELSE '1' END, '}',
  ', "items": ', CASE c_custkey % 4 WHEN 0 THEN '"none"' WHEN 1 THEN '[]' ELSE concat('[{"id": "a", "prompt": "p", "response": ',
    CASE WHEN c_custkey % 5 = 0 THEN 'null' ELSE '"r"' END, ', "latency_ms": ', c_custkey % 7 - 1, ', "cached": ',
    CASE WHEN c_custkey % 6 = 0 THEN '"no"' ELSE 'false' END, '}, ',
    CASE WHEN c_custkey % 9 = 0 THEN '5' ELSE '{"id": "b", "response": "r", "latency_ms": 1.5, "cached": true, "note": 1}' END, ']') END,
  ', "output": {"dir": "d", "file": "f"}', CASE WHEN c_custkey % 23 = 0 THEN '' ELSE '}' END)"""

_RULES = [  # path, kind, detail, condition on the document j
    ("run.id", "min_length", "''", "json_extract_string(j, '$.run.id') = ''"),
    ("run.seed", "type", "CASE json_type(j, '$.run.seed') WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN 'null' ELSE 'number' END",
     "json_type(j, '$.run.seed') IN ('VARCHAR', 'NULL', 'DOUBLE')"),
    ("run.extra", "additional", "NULL", "json_exists(j, '$.run.extra')"),
    ("run.completed_at", "required", "NULL", "NOT json_exists(j, '$.run.completed_at')"),
    ("model.params", "type", "'array'", "json_type(j, '$.model.params') = 'ARRAY'"),
    ("model.params.max_tokens", "type", "'number'", "json_type(j, '$.model.params.max_tokens') = 'DOUBLE'"),
    ("dataset", "required", "NULL", "NOT json_exists(j, '$.dataset')"),
    ("dataset.slice.start", "minimum", "json_extract_string(j, '$.dataset.slice.start')",
     "json_extract(j, '$.dataset.slice.start')::BIGINT < 0"),
    ("dataset.slice.limit", "minimum", "json_extract_string(j, '$.dataset.slice.limit')",
     "json_extract(j, '$.dataset.slice.limit')::BIGINT < 1"),
    ("cache.mode", "enum", "json_extract_string(j, '$.cache.mode')",
     "json_extract_string(j, '$.cache.mode') NOT IN ('none', 'vanilla-exact', 'vanilla-approx', 'extended')"),
    ("cache.stats.hits", "minimum", "json_extract_string(j, '$.cache.stats.hits')", "json_extract(j, '$.cache.stats.hits')::BIGINT < 0"),
    ("cache.stats.misses", "required", "NULL", "NOT json_exists(j, '$.cache.stats.misses')"),
    ("metrics.cache_hit_rate", "maximum", "json_extract_string(j, '$.metrics.cache_hit_rate')",
     "json_extract(j, '$.metrics.cache_hit_rate')::DOUBLE > 1"),
    ("metrics.correctness", "type", "'boolean'", "json_type(j, '$.metrics.correctness') = 'BOOLEAN'"),
    ("items", "type", "'string'", "json_type(j, '$.items') = 'VARCHAR'"),
]
_ITEM_RULES = [  # the same on an element e
    ("items[]", "type", "'integer'", "json_type(e) = 'UBIGINT'"),
    ("items[].response", "type", "'null'", "json_type(e, '$.response') = 'NULL'"),
    ("items[].latency_ms", "minimum", "json_extract_string(e, '$.latency_ms')", "json_extract(e, '$.latency_ms')::DOUBLE < 0"),
    ("items[].cached", "type", "'string'", "json_type(e, '$.cached') = 'VARCHAR'"),
    ("items[].prompt", "required", "NULL", "json_type(e) = 'OBJECT' AND NOT json_exists(e, '$.prompt')"),
    ("items[].note", "additional", "NULL", "json_exists(e, '$.note')"),
]


def _violations_sql() -> str:
    own = [f"SELECT c_custkey, NULL::INT AS item, '{p}' AS path, '{k}' AS kind, {d} AS detail FROM j WHERE {w}" for p, k, d, w in _RULES]
    each = [f"SELECT c_custkey, item, '{p}', '{k}', {d} FROM e WHERE {w}" for p, k, d, w in _ITEM_RULES]
    broken = "SELECT c_custkey, NULL, '', 'type', 'not JSON' FROM d WHERE NOT json_valid(document)"
    return f"""WITH d AS (SELECT c_custkey, {DOCUMENT_SQL} AS document FROM customer),
j AS (SELECT c_custkey, document::JSON AS j FROM d WHERE json_valid(document)),
e AS (SELECT c_custkey, unnest(range(json_array_length(j, '$.items')::BIGINT))::INT AS item,
        unnest(json_extract(j, '$.items[*]')) AS e FROM j WHERE json_type(j, '$.items') = 'ARRAY')
""" + "\nUNION ALL\n".join([*own, *each, broken])


@register("contract_violations", _violations_sql())
def q_contract_violations(spark, sf):
    """H2: violations of the published layout, documents and their items."""
    # the keys are dealt, not the documents made of them
    keys = TB.spread(TB.table(spark, sf, "customer").select("c_custkey"), "c_custkey")
    docs = keys.select("c_custkey", F.expr(DOCUMENT_SQL).alias("document"))
    return K.contract_violations(docs, K.DECLARED)


@register("contract_dropped_fields", S.with_views(
    "SELECT r.run_id, v.variant, v.path, 'required' AS kind FROM (SELECT DISTINCT run_id FROM request_log) r CROSS JOIN (VALUES "
    + ", ".join(f"({k}, {S.lit(p)})" for k, p in enumerate(C.CONTRACT_PATHS)) + ") AS v(variant, path)", "request_log"))
def q_contract_dropped_fields(spark, sf):
    """H2 on the written layout: each document of the log's runs lacks one field, the last variant none."""
    log = TB.request_log(spark, sf)
    stamps = log.groupBy("run_id").agg(F.date_format(F.max("ts"), C.TS_FORMAT).alias("timestamp"))
    m = C.metrics_df(spark, sf).join(stamps, "run_id", "left")
    doc = DOC.document_struct({"timestamp": F.col("timestamp")})
    variants = [F.to_json(doc.dropFields(p), {"ignoreNullFields": "false"}) for p in C.CONTRACT_PATHS]
    variants.append(F.to_json(doc, {"ignoreNullFields": "false"}))
    d = m.select("run_id", F.posexplode(F.array(*variants)).alias("variant", "document"))
    return K.contract_violations(d, K.WRITTEN).select("run_id", F.col("variant").cast("int").alias("variant"), "path", "kind")
