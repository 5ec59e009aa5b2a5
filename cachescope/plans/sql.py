"""DuckDB spellings of the scalar functions and input views, used by the oracle
queries of ``__spark_entry__.oracle_sql``.  They are independent brute-force
statements over the same parquet tables: patterns, run rows and presets are
written out here, so a change on the Spark side shows as a difference.
"""

from __future__ import annotations

# The patterns of the scalar functions in RE2 spelling.
BLANK = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}-\x{2029}\x{202f}\x{205f}\x{3000}]"
NUMBER_RE = r"-?[0-9]+(?:\.[0-9]+)?"
ANSWER_RE_RE2 = f"(?i)answer{BLANK}*:{BLANK}*({NUMBER_RE})"
STRIP_RE = f"\\A{BLANK}+|{BLANK}+\\z"
PUNCT_CLASS = "[?.!,;:]"
QUOTE_CLASS = "[\"'`]"
SAFE_NAME_CLASS = "[^A-Za-z0-9_.-]+"
PARAPHRASE_SUFFIX = "\nPlease answer concisely."


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def num(x: str) -> str:
    marked = f"regexp_extract({x}, {lit(ANSWER_RE_RE2)}, 1)"
    last = f"list_extract(regexp_extract_all(replace({x}, ',', ''), {lit(NUMBER_RE)}), -1)"
    return f"(CASE WHEN {marked} <> '' THEN TRY_CAST({marked} AS DOUBLE) ELSE TRY_CAST({last} AS DOUBLE) END)"


def norm(x: str) -> str:
    s = f"regexp_replace({x}, {lit(STRIP_RE)}, '', 'g')"
    s = f"lower({s})"
    s = f"regexp_replace({s}, {lit(BLANK + '+')}, ' ', 'g')"
    s = f"regexp_replace({s}, {lit(QUOTE_CLASS)}, '', 'g')"
    s = f"regexp_replace({s}, {lit(BLANK + '(' + PUNCT_CLASS + ')')}, '\\1', 'g')"
    return s


def safe_name(x: str) -> str:
    return f"regexp_replace({x}, {lit(SAFE_NAME_CLASS)}, '_', 'g')"


def paraphrase(x: str) -> str:
    return f"concat(regexp_replace({x}, {lit(BLANK + '+' + chr(92) + 'z')}, '', 'g'), {lit(PARAPHRASE_SUFFIX)})"


def int_or_null(x: str) -> str:
    """Python ``int(text)`` for plain integers; NULL where Python would fail."""
    return (f"(CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') "
            f"THEN TRY_CAST(trim({x}) AS BIGINT) END)")


REQUEST_LOG = """
SELECT event_type AS run_id, event_id AS seq,
       concat('question ', user_id) AS prompt,
       concat('Answer: ', json_extract_string(props, '$.k')) AS response,
       value / 100 AS latency_sec,
       [CASE WHEN event_id % 3 <> 0 THEN json_extract_string(props, '$.k')
             ELSE CAST(user_id % 100 AS VARCHAR) END] AS expected,
       ts
FROM events"""

EVAL_ITEMS = """
SELECT list_extract(['gsm8k', 'hotpotqa', 'singleq', 'mmlu_math', 'winograd_wsc', 'squad'], CAST(p_partkey % 6 AS INT) + 1) AS subset,
       p_partkey AS item_idx,
       CASE WHEN p_partkey % 10 = 0 THEN 'rejected' WHEN p_partkey % 10 = 1 THEN NULL ELSE 'consensus' END AS cleaning_status,
       CASE WHEN p_partkey % 4 = 0 THEN concat('How big is ', p_name, '?') WHEN p_partkey % 4 = 1 THEN '' END AS platinum_prompt,
       CASE WHEN p_partkey % 4 IN (1, 2) THEN concat('Size of ', p_name, '?') END AS question,
       concat(p_name, ' has a size.') AS statement,
       CASE WHEN p_partkey % 7 = 0 THEN [CAST(p_size AS VARCHAR), p_type] END AS platinum_target,
       CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size % 6 AS VARCHAR) ELSE '' END AS answer,
       CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) END AS output_answer,
       [p_brand, p_type, p_name, 'none'] AS choices,
       CAST(p_size % 3 AS VARCHAR) AS label,
       [p_brand, p_name] AS options
FROM part"""


RUNS = """SELECT * FROM (VALUES
  ('error', 'none', CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE)), ('click', 'custom_semantic', 'bge_small', 0.9),
  ('view', 'custom_semantic', 'bge_small', 0.95), ('signup', 'custom_semantic', 'mpnet', 0.9),
  ('purchase', 'custom_semantic', 'mpnet', 0.95)) AS t(run_id, cache_mode, embedding_model, similarity_threshold)"""


RUN_PLAN = """SELECT * FROM (VALUES
  ('error', ['gsm8k', 'hotpotqa', 'singleq', 'mmlu_math', 'winograd_wsc']), ('click', ['gsm8k', 'singleq']),
  ('view', ['squad']), ('signup', ['winograd_wsc', 'mmlu_math', 'hotpotqa']),
  ('purchase', ['hotpotqa', 'gsm8k'])) AS t(run_id, subsets)"""


PRESETS = {"conservative": 0.75, "moderate": 0.5, "aggressive": 0.35, "reckless": 0.2}


def with_views(body: str, *names: str) -> str:
    views = {"request_log": REQUEST_LOG, "eval_items": EVAL_ITEMS, "runs": RUNS, "run_plan": RUN_PLAN}
    ctes = ",\n".join(f"{n} AS ({views[n]})" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
