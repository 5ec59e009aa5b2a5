"""Labelled items from files: A1 (Parquet) and A2 (JSON lines).

Items lie in ``<path>/subset=<name>/split=<name>/``.  Subset and split are partition columns,
so a reader of some subsets lists and opens those folders only: literal names become
partition filters, the subsets that runs ask (``items_of_runs``) a dynamic partition filter.

A JSON line is parsed once, to a VARIANT, and every declared field is a typed read of it.  Ragged
fields are unified on read: a target is a scalar in one subset and a list in another, an answer is a text
or an index; lists become ``ARRAY<STRING>``, scalars text.  Lines that are no JSON object go to the
rejects, with their file, and never stop the job.  Parquet files of any column types are brought to the same
declared schema.

Item order is a column (``item_idx``): the file's own field, or the place of the line in the files of its subset
and split, by file name.  The place is counted inside each file block (bounded by
``spark.sql.files.maxPartitionBytes``), and the blocks' row counts give the offsets.

Differences: a JSON number is written as text without a trailing ``.0``, booleans in lower case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of an item, by kind.
TEXT_FIELDS = ["cleaning_status", "platinum_prompt_no_cot", "platinum_prompt", "question", "input", "text",
               "statement", "question_concat", "answer", "output_answer", "target", "label"]
LIST_FIELDS = ["platinum_target", "choices", "options"]
ANSWERS_TYPE = "struct<text:array<string>>"
ITEM_FIELDS = TEXT_FIELDS + LIST_FIELDS + ["answers"]
ITEM_COLUMNS = ["subset", "split", "item_idx", *ITEM_FIELDS, "source_file"]


def _is_list(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("ARRAY")


def _variant_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _variant_list(v: Column) -> Column:
    """A list as it is, a scalar as a list of one, JSON null and absence as NULL."""
    return F.when(_is_list(v), F.try_variant_get(v, "$", "array<string>")).when(
        _variant_text(v).isNotNull(), F.array(_variant_text(v)))


def _variant_answers(v: Column) -> Column:
    text = _variant_list(F.try_variant_get(v, "$.text", "variant"))
    return F.when(text.isNotNull(), F.struct(text.alias("text"))).cast(ANSWERS_TYPE)


def _line_places(lines: DataFrame) -> DataFrame:
    """``lines`` with ``_place``: 0-based place of a line in its subset and split, by file name."""
    group, block = ["subset", "split"], ["_file", "_block"]
    inside = Window.partitionBy(*group, *block).orderBy("_row")
    counts = lines.groupBy(*group, *block).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*group, *block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    numbered = lines.withColumn("_in", F.row_number().over(inside) - 1)
    return numbered.join(base, group + block).withColumn("_place", F.col("_base") + F.col("_in")).drop("_in", "_base")


def _scan(df: DataFrame, subsets: Sequence[str] | None, split: str | None) -> DataFrame:
    """Partition filters on the literal names."""
    if split is not None:
        df = df.where(F.col("split") == split)
    return df if subsets is None else df.where(F.col("subset").isin(*subsets))


def _lines(spark: SparkSession, path: str, subsets: Sequence[str] | None, split: str | None) -> DataFrame:
    raw = spark.read.schema("value string, subset string, split string").text(path)
    raw = _scan(raw, subsets, split).where(F.trim("value") != "").select(
        "subset", "split", "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    return raw.withColumn("_v", F.try_parse_json("value"))


def _is_item() -> Column:
    return F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))


def read_json_items(spark: SparkSession, path: str, subsets: Sequence[str] | None = None,
                    split: str | None = "test", number_lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """A2: (items, rejects) of the JSON lines under ``path``.

    ``number_lines`` numbers the lines that have no ``item_idx`` by their place (one shuffle); without it those
    have NULL.  Rejects: subset, split, source_file, line, reason."""
    lines = _lines(spark, path, subsets, split)
    reason = F.when(F.col("_v").isNull(), F.lit("not JSON")).otherwise(F.lit("not an object"))
    rejects = lines.where(~_is_item()).select(
        "subset", "split", F.col("_file").alias("source_file"), F.col("value").alias("line"), reason.alias("reason"))
    own = F.try_variant_get("_v", "$.item_idx", "bigint")
    if number_lines:
        lines, own = _line_places(lines), F.coalesce(own, F.col("_place"))
    field = lambda c: F.try_variant_get("_v", f"$.{c}", "variant")
    items = lines.where(_is_item()).select(
        "subset", "split", own.cast("bigint").alias("item_idx"), *[_variant_text(field(c)).alias(c) for c in TEXT_FIELDS],
        *[_variant_list(field(c)).alias(c) for c in LIST_FIELDS],
        _variant_answers(field("answers")).alias("answers"), F.col("_file").alias("source_file"))
    return items, rejects


def _declared(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` in its declared type, NULL where ``df`` has none."""
    kind = "array<string>" if name in LIST_FIELDS else ANSWERS_TYPE if name == "answers" else "string"
    if name not in df.columns:
        return F.lit(None).cast(kind).alias(name)
    c, have = F.col(name), df.schema[name].dataType
    if isinstance(have, T.VariantType):
        c = {"string": _variant_text, "array<string>": _variant_list}.get(kind, _variant_answers)(c)
    elif kind == "array<string>" and not isinstance(have, T.ArrayType):
        c = F.when(c.isNotNull(), F.array(c.cast("string")))
    return c.cast(kind).alias(name)


def read_parquet_items(spark: SparkSession, path: str, subsets: Sequence[str] | None = None,
                       split: str | None = "test") -> DataFrame:
    """A1: items of the Parquet files under ``path``, in the declared schema; ``item_idx`` is the file's own
    column, else the row's place in its subset and split."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    df = df.withColumns({"subset": F.col("subset").cast("string"), "split": F.col("split").cast("string")})
    df = _scan(df, subsets, split).select("*", F.col("_metadata.file_path").alias("_file"))
    if "item_idx" in df.columns:
        df = df.withColumn("item_idx", F.col("item_idx").cast("bigint"))
    else:
        df = df.select("*", F.lit(0).alias("_block"), F.col("_metadata.row_index").alias("_row"))
        counts = df.groupBy("subset", "split", "_file").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy("subset", "split").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
        base = counts.select("subset", "split", "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
        df = df.join(base, ["subset", "split", "_file"]).withColumn("item_idx", F.col("_base") + F.col("_row"))
    return df.select("subset", "split", "item_idx", *[_declared(df, c) for c in ITEM_FIELDS],
                     F.col("_file").alias("source_file"))


def items_of_runs(items: DataFrame, run_plan: DataFrame) -> DataFrame:
    """Items of the subsets that ``run_plan`` (run_id, subsets) asks for.

    The subsets are the small, selective side of a semi join on the partition column, so
    Spark prunes the folders at run time (dynamic partition pruning)."""
    asked = run_plan.select(F.explode("subsets").alias("_asked")).where(F.col("_asked") > "").distinct()
    return items.join(asked, F.col("subset") == F.col("_asked"), "left_semi")


def write_items(items: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Item rows under ``subset=/split=`` folders, as Parquet or JSON lines (column ``line``, if there is one, is
    written as it stands)."""
    if fmt == "parquet":
        items.write.partitionBy("subset", "split").parquet(path)
        return
    line = F.col("line") if "line" in items.columns else F.to_json(
        F.struct(*[c for c in items.columns if c not in ("subset", "split")]))
    items.select("subset", "split", line.alias("value")).write.partitionBy("subset", "split").text(path)
