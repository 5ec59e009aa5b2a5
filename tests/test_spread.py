"""Heavy work over narrow scans is dealt over the shuffle partitions."""

from pyspark.sql import functions as F

from cachescope.plans import catalog
from cachescope.sources import tables as TB


def test_spread_deals_the_rows_of_one_partition(spark):
    df = spark.createDataFrame([(k,) for k in range(500)] + [(None,), (7,), (7,)], "k long").coalesce(1)
    out = TB.spread(df, "k")
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert out.groupBy(F.spark_partition_id()).count().count() > 1
    assert sorted(r.k or -1 for r in out.collect()) == sorted(r.k or -1 for r in df.collect())


def test_contract_documents_are_judged_in_many_tasks(spark, scratch):
    spark.range(1, 401).withColumnRenamed("id", "c_custkey").coalesce(1).write.parquet(f"{scratch}/customer.parquet")
    found = catalog.QUERIES["contract_violations"](spark, scratch)
    # the rule rows of documents are one branch, those of items another, broken documents a third
    whole = found.where("item is null and detail is distinct from 'not JSON'").select(F.spark_partition_id().alias("p"))
    assert whole.distinct().count() > 1
