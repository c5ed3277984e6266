"""A training corpus from the documents: filtered, freed of copies and benchmark items, mixed and sharded.

``STAGES`` run in this order; each gets the documents its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import decontaminate, mixing, ngram_join, quality, sharding
from lakeloom.llm.workers import find_package
from lakeloom.session import cut, tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; lines that too many documents of their source share are cut."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return ngram_join.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item's question and answer go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens there are, dealt evenly over the sources of each language, whatever the sources' sizes."""
    return mixing.apply(docs, F.lit(1.0), domain=F.lit("web"))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document that is left, in eight shards, and its shard among nine."""
    return sharding.shard(docs, [1.0] * 8, [1.0] * 9)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: Shingle sets, BM25 and seeded hashes are beyond SQL that other engines share; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = find_package(tune(spark))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
