"""From raw documents to shards: quality, near-duplicates, decontamination, mix, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.fast_sketch_dedup import NearDup, one_of_each
from ledgerspark.llm.kd_shards import kd_shards
from ledgerspark.llm.line_quality import reject_documents
from ledgerspark.llm.pareto_mix import mixed_documents
from ledgerspark.llm.scratch import table, written
from ledgerspark.llm.suffix_decontaminate import decontaminate


#: Near-duplicates of a similarity of 0.8 or more. At 0.8 two documents agree in no band with a probability of
#: (1 - 0.8**4)**30, 1.4e-7, and in under 74 of 120 coordinates (96 expected, standard deviation 4.4) with one under 1e-6.
NEAR = NearDup(percent=80, bands=30, rows=4, least_agreeing=74)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return reject_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs, NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The weighted mix; a document that is taken n times is n rows."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of the mix with its shard and slot; columns of these names are replaced."""
    names = {"_size": "size", "_shard": "shard", "_slot": "slot"}
    placed = kd_shards(docs.drop(*names.values()))
    kept = [c for c in placed.columns if c not in names]
    return placed.select(*kept, *[F.col(old).alias(new) for old, new in names.items()])


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Connected components over confirmed links and the sharding search have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
