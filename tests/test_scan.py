"""Chunked scans: chunks of equal depth whatever the values, NULL groups, positions and item slices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cachescope.operators import items as I
from cachescope.operators import scan as S

ROWS = 3000
CHUNK = 25  # 3,000 rows: two rounds of splitting


def orders():
    rng = np.random.default_rng(3)
    yield "outlier", [*range(ROWS - 1), 10 ** 15]
    yield "outliers", [-10 ** 17, *range(ROWS - 2), 10 ** 17]
    yield "powers", [int(1.0116 ** k * 1000) + k for k in range(ROWS)]
    yield "two_clusters", [*range(ROWS // 2), *range(10 ** 12, 10 ** 12 + ROWS // 2)]
    yield "uneven", sorted(set(rng.integers(0, 10 ** 9, ROWS).tolist()))


@pytest.mark.parametrize("name,values", list(orders()), ids=lambda x: x if isinstance(x, str) else "")
def test_chunks_are_of_equal_depth(spark, name, values):
    rows = [(g, v) for g in ("a", None) for v in values] + [("small", 1), ("small", 2)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(5)
    chunks = S.value_chunks(df, ["g"], "v", CHUNK).groupBy("g", "_chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("g", "_chunk").collect()
    assert sum(c.n for c in chunks) == len(rows) and max(c.n for c in chunks) <= 2 * CHUNK
    for a, b in zip(chunks, chunks[1:]):
        assert a.g != b.g or a.hi < b.lo
    got = {(r.g, r.v): r.pos for r in S.positions(df, ["g"], "v", "pos", CHUNK).collect()}
    want = {(g, v): k for g in ("a", None) for k, v in enumerate(sorted(values))} | {("small", 1): 0, ("small", 2): 1}
    assert got == want


def test_equal_and_null_values_share_a_chunk(spark):
    rows = [("g", 5.0, i) for i in range(500)] + [("g", float(i), 1000 + i) for i in range(300)] + [("g", None, 2000)]
    x = S.value_chunks(spark.createDataFrame(rows, "g string, v double, i long"), ["g"], "v", 20)
    assert x.where("v = 5").select("_chunk").distinct().count() == 1
    order = [r.v for r in x.groupBy("_chunk").agg(F.min("v").alias("v")).orderBy("_chunk").collect()]
    assert order == sorted(order)
    assert x.where("v is null").first()["_chunk"] == x.agg(F.min("_chunk")).first()[0]


def test_a_large_group_is_not_gathered_to_be_cut(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.createDataFrame([("g", k) for k in range(ROWS)], "g string, v long").repartition(6, "v")
        x = S.value_chunks(df, ["g"], "v", 1000).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in x) == ROWS and max(r["count"] for r in x) < ROWS / 2


def test_running_aggregates_in_null_groups(spark):
    rows = [(g, h, i, (i * 7) % 11) for g in ("a", None, "") for h in (1, None) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, h int, i long, v long").repartition(6)
    r = S.running(df, ["g", "h"], ["i"], S.pos_chunk("i", 9), [
        ("s", "sum", F.col("v")), ("m", "max", F.struct("v", "i")), ("n", "count", F.lit(1))], inclusive=False)
    for x in r.collect():
        before = [(q[3], q[2]) for q in rows if q[:2] == (x.g, x.h) and q[2] < x.i]
        assert (x.s, x.n) == (sum(v for v, _ in before), len(before))
        assert (x.m and tuple(x.m)) == (max(before) if before else None)
    assert r.columns == ["g", "h", "i", "v", "s", "m", "n"]


def items(spark):
    rows = [(s, k * k * k, "rejected" if k % 4 == 0 else None) for s in ("x", "y") for k in range(1, 21)]
    return spark.createDataFrame(rows, "subset string, item_idx long, cleaning_status string")


@pytest.mark.parametrize("start,limit", [(0, None), (None, 0), (3, 5), (-4, 2), (14, 9), (15, 3), (2, -1)])
def test_slices(spark, start, limit):
    left = [k ** 3 for k in range(1, 21) if k % 4]
    a = max(0, start or 0)
    want = left[a:] if limit is None else left[a:a + max(0, limit)]
    got = sorted((r.subset, r.item_idx) for r in I.slice_items(items(spark), start, limit).collect())
    assert got == [(s, v) for s in ("x", "y") for v in want]


@pytest.mark.parametrize("index,want", [(0, 1), (2, 27), (14, 19 ** 3), (15, 1), (-1, 1)])
def test_item_out_of_range_is_the_first(spark, index, want):
    assert {r.item_idx for r in I.item_at(items(spark), index).collect()} == {want}


def test_strict_question_and_label_words(spark):
    row = spark.createDataFrame([("", None)], "question string, input string")
    assert row.select(I.pick_question(row).alias("q")).first().q is None
    with pytest.raises(Exception, match="No suitable question field"):
        row.select(I.pick_question(row, strict=True).alias("q")).collect()
    fields = "platinum_target array<string>, output_answer string, answer string, choices array<string>, " \
             "answers struct<text: array<string>>, options array<string>, label string, target string"
    r = spark.createDataFrame([("tab_fact", None, None, None, None, None, None, x, None) for x in ("1", "0")],
                              "subset string, " + fields)
    words = [x.e for x in r.orderBy(F.desc("label")).select(I.expected_answers(with_label_words=True).alias("e")).collect()]
    assert words == [["entailed"], ["refuted"]]
