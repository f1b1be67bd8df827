"""A cleaning pipeline over ``documents``: toxicity, near-duplicates, contamination, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's
docs. All but the last return the columns of ``documents``. Fingerprints, hashes, a trained classifier and hypergeometric draws
have no SQL form, so there is no oracle; the stages are tested against plain Python versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fringeline.llm import decontaminate, mixing, sharding, simhash, toxicity
from fringeline.llm.common import read, written

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier doesn't reject."""
    return toxicity.accepted(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which no window of a benchmark item occurs."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the sources' words meet their targets."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard and slot."""
    return sharding.sharded(docs)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_copies), ("decontaminate", drop_contaminated), ("mixing", mix_sources), ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
