"""Sizes of what tasks hold: rows of an Arrow batch, words added to the counters, lines in order."""

import numpy as np
import pyarrow as pa
import pytest

from cachescope.llm import common, linededup


def test_arrow_batches_are_bounded_on_both_sides(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    before = spark.conf.get(common.ARROW_ROWS)
    try:
        for limit, after in (("10000", common.BATCH_ROWS), ("0", common.BATCH_ROWS), ("700", 700)):
            spark.conf.set(common.ARROW_ROWS, limit)
            got = common.map_batches(spark.range(0, 5000, 1, 1), sizes, "n long").collect()
            assert int(spark.conf.get(common.ARROW_ROWS)) == after
            assert sum(r["n"] for r in got) == 5000 and max(r["n"] for r in got) <= after
    finally:
        spark.conf.set(common.ARROW_ROWS, before)


@pytest.mark.parametrize("last", [50, 1 << 23])      # few lines, and more than a packed number holds
def test_lines_in_order_of_rarity(last):
    rng = np.random.default_rng(4)
    line = np.sort(rng.integers(0, 50, 2000))
    line[-1] = last
    seen = rng.integers(0, linededup.MOST + 1, 2000)
    seen[::3] = 1
    assert linededup.by_line_and_rarity(line, seen).tolist() == np.lexsort((seen, line)).tolist()
    assert not len(linededup.by_line_and_rarity(line[:0], seen[:0]))


def test_words_are_counted_in_any_portions(spark, monkeypatch):
    runs = []

    def keep(df, run, schema):
        runs.append(run)
        raise InterruptedError

    monkeypatch.setattr(linededup, "map_batches", keep)
    with pytest.raises(InterruptedError):
        linededup.word_counters(spark.createDataFrame([("",)], "text string"))
    texts = pa.RecordBatch.from_arrays([pa.array(["a b a", None, "", "b\nc d e a"] * 100)], ["text"])
    totals = []
    for portion in (1, 7, 1 << 20):
        monkeypatch.setattr(linededup, "COUNTED_AT_ONCE", portion)
        cells = {}
        for out in runs[0](iter([texts, texts, texts.slice(0, 0)])):
            cells |= {p: c for p, c in zip(out.column(0).to_pylist(), out.column(1).to_pylist())}
        totals.append(cells)
        counts = np.concatenate([np.frombuffer(c, np.uint16) for c in cells.values()])
        assert sorted(counts[counts > 0].tolist()) == [200, 200, 200, 400, 600]
    assert totals[0] == totals[1] == totals[2]
