"""From raw documents to training shards: STAGES in order, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.llm import decontaminate, mixing, quality, sharding, simhash
from evalspark.session import configure, materialise

SHARDS = 40


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    model = quality.fit(docs, configure(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).where(F.col("score") >= quality.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 5-word shingles, Jaccard similarity 0.8."""
    configure(spark)
    return simhash.without_near_duplicates(docs, words=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not repeat the benchmark."""
    benchmark = configure(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or cut so that the sources have their weights."""
    configure(spark)
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their place in it."""
    configure(spark)
    return sharding.shard_by_bytes(docs, SHARDS)


STAGES = [
    ("quality classifier", keep_quality),
    ("near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

#: SQL cannot express the classifier and the components; see the test against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
