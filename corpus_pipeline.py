"""The corpus pipeline: stages that each read what the one before them has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeworks import session
from tapeworks.llm import decontamination, mixing, quality, sharding, simhash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their nearest labelled neighbours find good."""
    return quality.good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id.

    Near are texts whose SimHash fingerprints over four-word shingles differ in at most
    four bits, also by way of others.
    """
    return simhash.dedup(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as the source weights take them, some twice, in training order."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its slot in it."""
    return sharding.sharded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("mix", mix),
    ("shard", shard),
]

#: No SQL: several stages are models or iterations; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents, each stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = session.scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
