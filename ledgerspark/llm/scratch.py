"""Intermediate tables that survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.session import remove_dir, scratch_dir


class Rounds:
    """Tables of a loop: each round's is written and replaces the one before, whose files go."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.path = spark, name, None

    def put(self, df: DataFrame) -> DataFrame:
        path = scratch_dir(self.spark, self.name)
        df.write.parquet(path)
        if self.path:
            remove_dir(self.spark, self.path)
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)


#: Whether Spark removes the files of a query's exchanges when it ends, instead of some time after.
REMOVE_EXCHANGES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(spark: SparkSession, df: DataFrame, name: str, leave_exchanges: bool = True) -> DataFrame:
    """``df`` written once to the shared scratch folder and read from there."""
    path = scratch_dir(spark, name)
    before = spark.conf.get(REMOVE_EXCHANGES, "false")
    spark.conf.set(REMOVE_EXCHANGES, before if leave_exchanges else "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(REMOVE_EXCHANGES, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
