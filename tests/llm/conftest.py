import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """A small documents table with the awkward rows: nulls, empty, repeated, very long, extra columns."""
    base = spark.read.parquet(f"{SF001}/documents.parquet").where("doc_id < 60")
    extra = spark.createDataFrame(
        [(900, None, "en", "a", 1), (901, "", None, None, 0), (902, " \n\t ", "fr", "a", 4), (903, "x " * 30000, "en", None, 9),
         (904, "the same line of words here\nthe same line of words here\nshort", "en", "a", 9),
         (904, "the same line of words here\nthe same line of words here\nshort", "en", "a", 9),
         (None, "no id at all but a text of words", None, "b", 3)],
        base.schema)
    from pyspark.sql import functions as F
    return base.unionByName(extra).withColumn("_fp", F.lit("clash")).withColumn("size", F.lit("clash")).coalesce(3)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF001}/labels.parquet")
