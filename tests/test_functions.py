"""Golden vectors of the scalar functions (FIXTURES section 2)."""

import pytest
from pyspark.sql import functions as F

from cachescope.functions import grading as G
from cachescope.functions import text as X
from cachescope.operators.items import expected_answers, pick_question


def one(spark, col, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(
        f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in cols.items()))
    return df.select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("expected,output,ok", [
    (["42"], "Answer: 42", True), (["42"], "The result is 42", True), (["42.0"], "42", True),
    (["3.1415927"], "Answer: 3.141593", True), (["100"], "Answer: 42", False),
    (["Paris"], "The capital is Paris.", True), (["Paris"], "paris", True),
    (["the capital is paris"], "Paris", True), (["London"], "The capital is Paris.", False),
    (["42"], "", True), ([""], "anything", True), (["42"], None, False)])
def test_grade(spark, expected, output, ok):
    assert one(spark, G.grade(F.col("e"), F.col("o")), e=expected, o=output) is ok


def test_grade_strict(spark):
    assert one(spark, G.grade(F.col("e"), F.col("o"), strict=True), e=[""], o="x") is False
    assert one(spark, G.grade(F.col("e"), F.col("o"), strict=True), e=["42"], o="") is False


@pytest.mark.parametrize("text,num", [
    ("Answer: 1,234", 1.0), ("It costs $1,234.", 1234.0), ("3-4", -4.0), ("Answer:**42** or 7", 7.0),
    ("the ANSWER : -3.50 then 9", -3.5), (".5", 5.0), ("1e5", 5.0), ("no digits", None)])
def test_final_number(spark, text, num):
    assert one(spark, X.final_number(F.col("t")), t=text) == num


@pytest.mark.parametrize("text,norm", [
    ("  Hello   World  ", "hello world"), ('He said "yes" .', "he said yes."),
    ("a b", "a b"), ("Why ?", "why?"), ("`quoted'", "quoted")])
def test_normalize(spark, text, norm):
    assert one(spark, X.normalize_text(F.col("t")), t=text) == norm


def test_small_helpers(spark):
    assert one(spark, X.prompt_key(F.col("t")), t="abc") == \
        "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert one(spark, X.safe_name(F.col("t")), t="gemma2:9b/x y") == "gemma2_9b_x_y"
    assert one(spark, X.paraphrase(F.col("t")), t="Q?  \n") == "Q?\nPlease answer concisely."
    assert one(spark, G.safe_ratio(F.lit(5), F.lit(10)), t="") == 0.5
    assert one(spark, G.safe_ratio(F.lit(0), F.lit(0)), t="") == 0.0
    assert one(spark, G.verdict_numeric(F.col("e"), F.col("o")), e=["100"], o="100.00001") is True
    assert one(spark, G.mostly_numeric(F.col("e")), e=["1", "a", "b"]) is True
    assert one(spark, G.mostly_numeric(F.col("e")), e=["a", "b"]) is False
    assert one(spark, G.label_words(F.col("t")), t="1") == "entailed"


def test_question_and_expected(spark):
    rows = [("gsm8k", "", "Q1", "7", None, None, None, None),
            ("mmlu_math", None, "Q2", "2", None, ["a", "b", "c"], None, None),
            ("mmlu_math", None, "Q3", "9", None, ["a"], None, None),
            ("winograd_wsc", None, "Q4", None, "1", None, ["x", "y"], None),
            ("other", None, None, "0", None, None, None, None)]
    schema = ("subset string, platinum_prompt string, question string, answer string, label string, "
              "choices array<string>, options array<string>, platinum_target array<string>")
    df = spark.createDataFrame(rows, schema)
    for c in ("platinum_prompt_no_cot", "input", "text", "statement", "question_concat", "output_answer",
              "target"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumn("answers", F.lit(None).cast("struct<text:array<string>>"))
    got = df.select(pick_question(df).alias("q"), expected_answers().alias("e")).collect()
    assert [r.q for r in got] == ["Q1", "Q2", "Q3", "Q4", None]
    assert [r.e for r in got] == [["7"], ["c"], ["9"], ["y"], ["0"]]


def test_stamp_label(spark):
    c = X.stamp_label(F.to_timestamp(F.col("t")))
    assert one(spark, c, t="2024-03-05 07:08:09") == "20240305_070809"


def test_numeric_verdict_at_the_edges(spark):
    big = "1" + "0" * 400  # reads as infinity
    v = G.verdict_numeric(F.col("e"), F.col("o"))
    assert one(spark, v, e=["5.0000001"], o="5") is True and one(spark, v, e=["5.1"], o="5") is False
    assert one(spark, v, e=[big], o="Answer: 5") is False
    assert one(spark, v, e=["no number"], o="5") is False
