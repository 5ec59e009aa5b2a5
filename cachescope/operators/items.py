"""Labelled items: B1-B6, B9, C9 (option), D8, G3."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cachescope.functions.grading import label_words
from cachescope.functions.text import BLANK
from cachescope.operators.scan import positions

# Question fields in priority order, and the subset groups of the
# expected-answer chain.
QUESTION_FIELDS = ["platinum_prompt_no_cot", "platinum_prompt", "question", "input", "text",
                   "statement", "question_concat"]
OUTPUT_ANSWER_SUBSETS = ["singleq", "singleop", "multiarith"]
ANSWER_TEXT_SUBSETS = ["squad", "hotpotqa"]
GENERIC_FIELDS = ["target", "label", "output_answer", "answer"]


def drop_rejected(items: DataFrame) -> DataFrame:
    """B1: drop ``cleaning_status = 'rejected'``; NULL status is kept; no-op
    when the column does not exist."""
    if "cleaning_status" not in items.columns:
        return items
    return items.where(~F.col("cleaning_status").eqNullSafe(F.lit("rejected")))


def slice_items(items: DataFrame, start: int | None = 0, limit: int | None = None,
                part: str = "subset", order: str = "item_idx") -> DataFrame:
    """B2: positional slice ``[start, start + limit)`` per subset after B1.

    start below 0 counts as 0, limit NULL means all, limit 0 gives nothing.
    Positions come from the chunked scan, so a huge subset is not one task.
    """
    s = max(0, int(start or 0))
    x = positions(drop_rejected(items), [part], order, "item_pos")
    cond = F.col("item_pos") >= s
    if limit is not None:
        cond = cond & (F.col("item_pos") < s + max(0, int(limit)))
    return x.where(cond)


def pick_question(items: DataFrame | None = None, strict: bool = False) -> Column:
    """First non-empty of the seven question fields (NULL when none;
    ``strict`` raises like the reference)."""
    cols = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in QUESTION_FIELDS
            if items is None or c in items.columns]
    q = F.coalesce(*cols)
    if strict:
        q = F.when(q.isNull(), F.raise_error(F.lit("No suitable question field found."))).otherwise(q)
    return q


def _present(c: str) -> Column:
    return F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.array(F.col(c).cast("string")))


def py_int(c: Column) -> Column:
    """Python ``int(text)`` for plain integers, NULL where Python raises."""
    m = F.regexp_extract(c, f"\\A{BLANK}*([+-]?[0-9]+){BLANK}*\\z", 1)
    return F.when(m != "", m.try_cast("long"))


def _index_lookup(arr: str, idx: str) -> Column:
    i = py_int(F.col(idx))
    return F.when((i >= 0) & (i < F.size(F.col(arr))), F.array(F.get(F.col(arr), i.cast("int"))))


def expected_answers(subset: Column | None = None, with_label_words: bool = False) -> Column:
    """Acceptable answers, by the reference's priority chain."""
    subset = F.col("subset") if subset is None else subset
    tgt = F.col("platinum_target")
    chain = [
        F.when(F.size(F.coalesce(tgt, F.array().cast("array<string>"))) > 0,
               F.transform(tgt, lambda x: F.coalesce(x, F.lit("None")))),
        F.when(subset.isin(*OUTPUT_ANSWER_SUBSETS), _present("output_answer")),
        F.when(subset == "gsm8k", _present("answer")),
        F.when(subset == "mmlu_math", _index_lookup("choices", "answer")),
        F.when(subset.isin(*ANSWER_TEXT_SUBSETS), F.coalesce(
            _present("answer"),
            F.when(F.size(F.coalesce(F.col("answers.text"), F.array().cast("array<string>"))) > 0,
                   F.array(F.get(F.col("answers.text"), 0))))),
        F.when(subset == "winograd_wsc", _index_lookup("options", "label")),
    ]
    if with_label_words:
        chain.append(F.when(subset == "tab_fact", F.when(F.col("label").isNotNull(),
                                                         F.array(label_words("label")))))
    chain += [_present(c) for c in GENERIC_FIELDS]
    chain.append(F.array(F.lit("")))
    return F.coalesce(*chain)


def sample_items(items: DataFrame, n: int, seed: int = 0, part: str = "subset",
                 key: str = "item_idx") -> DataFrame:
    """N items per subset without replacement, seeded.

    Draw order is ``sha2(seed:key)``; ``row_number() <= n`` lets Spark put a
    partial per-partition limit (WindowGroupLimit) below the shuffle, so a huge
    subset never reaches one task whole.
    """
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    w = Window.partitionBy(part).orderBy(h, F.col(key))
    return drop_rejected(items).withColumn("_draw", F.row_number().over(w)) \
        .where(F.col("_draw") <= n).drop("_draw")


def item_at(items: DataFrame, index: int, part: str = "subset", order: str = "item_idx") -> DataFrame:
    """Item at position ``index`` per subset after B1, position 0 when out of range."""
    x = positions(drop_rejected(items), [part], order, "item_pos")
    sizes = x.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    x = x.join(sizes, part)
    want = F.when((F.lit(index) >= 0) & (F.lit(index) < F.col("_n")), F.lit(index)).otherwise(F.lit(0))
    return x.where(F.col("item_pos") == want).drop("_n")


def plan_requests(run_plan: DataFrame, items: DataFrame, start: int | None = 0,
                  limit: int | None = None) -> DataFrame:
    """D8 + G3: runs x items.  ``run_plan`` has (run_id, subsets ARRAY<STRING>).

    Items are selected per subset (B1, B2), then each run gets its subsets in
    list order; ``seq`` numbers a run's requests across subsets.  Only small
    per-subset counts are combined with windows; the item rows are joined once.
    """
    sel = slice_items(items, start, limit)
    sel = sel.select("subset", "item_idx", "item_pos",
                     pick_question(sel).alias("question"),
                     expected_answers().alias("expected"))
    s = max(0, int(start or 0))
    plan = run_plan.select("run_id", F.posexplode("subsets").alias("subset_ord", "subset"))
    sizes = sel.groupBy("subset").agg(F.count(F.lit(1)).alias("_n"))
    offsets = plan.join(sizes, "subset", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    offsets = offsets.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.partitionBy("run_id").orderBy("subset_ord")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = offsets.select("run_id", "subset", "subset_ord", "_off").join(sel, "subset")
    return out.select("run_id", (F.col("_off") + F.col("item_pos") - s).alias("seq"), "subset",
                      F.col("item_pos").alias("row_index"), "item_idx", "question", "expected")


def item_log(hits: DataFrame, start: int = 0) -> DataFrame:
    """Per-request item log with the reference's field names.

    ``row_index`` is the position in the subset: the log's own column where it has one
    (``plan_requests`` gives it), else the position in the run, counted from ``start``
    (a run over one subset)."""
    row_index = F.col("row_index") if "row_index" in hits.columns else F.col("pos") + F.lit(start)
    return hits.select(
        "run_id", "seq",
        F.col("subset") if "subset" in hits.columns else F.lit(None).cast("string").alias("subset"),
        row_index.alias("row_index"),
        F.col("prompt").alias("question"), "expected",
        F.col("response").alias("model_output"),
        F.round("latency_sec", 6).alias("latency_sec"),
        "cache_hit", "correct")
