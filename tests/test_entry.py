"""Driver contract: the flagship entry and every registered query run at sf0.001."""

import __spark_entry__ as E
from conftest import SF001


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "correctness" in df.columns


def test_all_queries_run(spark):
    qs, oracles = E.queries(), E.oracle_sql()
    assert set(oracles) <= set(qs)
    for name, fn in qs.items():
        df = fn(spark, SF001)
        df.write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
