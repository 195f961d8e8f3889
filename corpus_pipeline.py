"""From raw documents to shards of a training mix, in five stages.

Each stage takes (spark, documents, folder of the tables) and works on all that its predecessor
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskframe.llm import decontaminate, quality, sharding, simhash  # noqa: E402
from riskframe.llm.common import table  # noqa: E402
from riskframe.llm.mixture import Mixture  # noqa: E402
from riskframe.session import materialise  # noqa: E402


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each SimHash group: 4-word shingles, at most 4 differing bits."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each document and pass over its source."""
    return Mixture().documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with region, rack, shard (0 to 39) and slot."""
    return sharding.sharded(docs, sharding.Tree.uniform(40)).drop("grown_shard")


STAGES = [
    ("quality", keep_good),
    ("near-duplicates", keep_one),
    ("decontamination", drop_leaks),
    ("mixture", mix),
    ("sharding", shard),
]

#: Training, fingerprints and alignment have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
