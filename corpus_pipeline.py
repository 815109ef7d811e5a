"""Corpus pipeline: quality filter, near-duplicates, decontamination, mixing, sharding.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
``run`` writes each stage's result as Parquet below the shared folder and reads it again for
the next one, so a lost executor never reaches back beyond one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendmill.llm import decontaminate, mix, quality, shard, simhash
from lendmill.session import materialise


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier, fitted on labels outside the held-out quarter,
    predicts to be good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = quality.labelled_texts(docs, labels)
    return quality.accepted(docs, quality.fit(known))


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked fingerprints: the least doc_id."""
    return simhash.one_of_each(docs, distance=4, shingle=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document as often as the mix takes it; documents not taken go."""
    return mix.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot in the shard."""
    return shard.sharded(docs, shards=16)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", source_mixing),
    ("sharding", sharding),
]

# Fingerprint components, alignments, the classifier and the cube method have no SQL form.
# tests/llm holds each stage against its operator's results on the stage's input: components against
# brute force, the mix against its targets, the shards against their gapless slots.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
