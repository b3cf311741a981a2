"""A training-data pipeline over ``documents``: quality, near-duplicates, benchmark passages, mixture, shards.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its rows are written as
Parquet under ``spark.checkpoint.dir`` and read again as the next stage's input, so a lost
executor never costs more than the stage it worked on. All stages but the last return the
columns of ``documents``; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from roadlens.llm import decontaminate, mixing, near_dedup, quality, sharding
from roadlens.llm.common import table
from roadlens.session import checkpoint_root


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a five-word-shingle similarity of 0.8 or more."""
    return near_dedup.deduplicate(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that are mostly benchmark go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot along the Hilbert curve."""
    return sharding.shard_rows(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("mix", mix_sources),
    ("shard", shard),
]

ORACLE_SQL = None  # trees and suffix automata are not SQL; the tests hold every stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{checkpoint_root(spark)}/roadlens-pipeline/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{i}-{name}")
        docs = spark.read.parquet(f"{root}/{i}-{name}")
    return docs
