"""The corpus pipeline: five stages, each over all documents that the one before it kept.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.

Defined cases are those of the operators: nulls and empty texts pass as empty,
repeated rows are rows of their own, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeshift.llm import extendible_sharding, order_minhash, quality_bayes, source_mixing, spaced_decontam
from lakeshift.llm.common import stored, table
from lakeshift.llm.registry import SHARD_BYTES


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (toxic or of low quality) go."""
    return quality_bayes.kept(docs, table(spark, sf_dir, "labels"), *quality_bayes.source_site())


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return order_minhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return spaced_decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it."""
    return source_mixing.mixture(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard."""
    return extendible_sharding.sharded(docs, SHARD_BYTES)


STAGES = [
    ("quality classifier", quality),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("source mixing", mixing),
    ("sharding", sharding),
]

# The classifier and the sketches cannot be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
