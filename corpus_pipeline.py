"""Training-corpus pipeline: quality rules, line dedup, SimHash near-dedup, source mix, byte-level BPE.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame.  All but the last return the columns of documents.  ``run`` applies them
to the documents table and writes each stage's result into the shared folder,
since every stage reads its input more than once.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cachescope.llm import bpe, linededup, mixing, quality, simhash
from cachescope.llm.common import materialise

RANKS = "byte_bpe_multi_50k.tiktoken"

# SQL has neither the hashes nor the merges of these stages; tests compare with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the n-gram ratio keep."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line resembles (every row stays)."""
    return linededup.dedup_lines(docs, min_words=linededup.EVERY_LINE)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    return bpe.encode_documents(docs, public_tokenizers.path(RANKS), keep=("doc_id", "lang", "source"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("simhash near-dedup", simhash_dedup),
          ("source mix", mix_sources), ("byte-level bpe", byte_bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
