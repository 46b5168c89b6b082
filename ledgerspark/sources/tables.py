"""Stored tables: one layout for all taxpayers, read as a whole or for one of them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.schemas import TAXPAYER, TableSpec
from ledgerspark.session import remove_dir, scratch_dir

BUCKET = "taxpayer_bucket"
BUCKETS = 64
INGEST_RUN = "ingest_run"


def bucket_of(taxpayer: Column) -> Column:
    """Bucket of a taxpayer; a fixed number of them, however many taxpayers there are."""
    return F.pmod(F.xxhash64(taxpayer), F.lit(BUCKETS)).cast("int")


def write_table(
    df: DataFrame, path: str, spec: TableSpec, mode: str = "overwrite", written: Observation | None = None
) -> None:
    """Parquet table in taxpayer buckets, sorted by taxpayer and date so that a reader can skip row groups.

    The rebalance splits a bucket that one large taxpayer fills over several tasks and files, and
    joins small ones. ``written`` observes the rows as ``n`` in the tasks that write them, after the last shuffle, so
    a stage that is run again is not counted twice.
    """
    rows = (
        df.withColumn(BUCKET, bucket_of(F.col(TAXPAYER)))
        .hint("rebalance", BUCKET)
        .sortWithinPartitions(BUCKET, TAXPAYER, spec.date_column)
    )
    if written is not None:
        rows = rows.observe(written, F.count(F.lit(1)).alias("n"))
    rows.write.mode(mode).partitionBy(BUCKET).parquet(path)


def stored_rows(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame | None:
    """The stored table at ``path`` with its bucket column, or None before its first write."""
    schema = T.StructType([*spec.schema, T.StructField(INGEST_RUN, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def replace_taxpayers(spark: SparkSession, rows: DataFrame, taxpayers: DataFrame, path: str, spec: TableSpec) -> None:
    """Put ``rows`` in place of all stored rows of ``taxpayers``; rows of others stay.

    Only buckets of these taxpayers are written again: their new content goes to a scratch table first and
    then replaces the buckets, so a failure before that leaves the table as it was.
    """
    stored = stored_rows(spark, path, spec)
    if stored is None:
        write_table(rows, path, spec)
        return
    names = taxpayers.select(TAXPAYER).distinct()
    touched = [r[0] for r in names.select(bucket_of(F.col(TAXPAYER))).distinct().collect()]
    others = stored.filter(F.col(BUCKET).isin(touched)).join(names, TAXPAYER, "left_anti")
    scratch = scratch_dir(spark, "replace")
    write_table(others.drop(BUCKET).unionByName(rows, allowMissingColumns=True), scratch, spec)
    fresh = stored_rows(spark, scratch, spec)
    left = {r[0] for r in fresh.select(BUCKET).distinct().collect()}
    (
        fresh.hint("rebalance", BUCKET)
        .sortWithinPartitions(BUCKET, TAXPAYER, spec.date_column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )
    # A bucket that has no row left is not overwritten but goes.
    for bucket in sorted(set(touched) - left):
        remove_dir(spark, f"{path.rstrip('/')}/{BUCKET}={bucket}")
    remove_dir(spark, scratch)


def tenant_rows(df: DataFrame, taxpayer: str) -> DataFrame:
    """One taxpayer's rows of a stored table: one bucket's files, and few row groups of those."""
    return df.filter((F.col(BUCKET) == bucket_of(F.lit(taxpayer))) & (F.col(TAXPAYER) == taxpayer))


def read_table(
    spark: SparkSession, path: str, spec: TableSpec, taxpayer: str | None = None
) -> DataFrame:
    """Rows of a stored table, of one taxpayer if given; a table never written has none."""
    table = stored_rows(spark, path, spec)
    if table is None:
        return spark.createDataFrame([], spec.schema)
    if taxpayer is not None:
        table = tenant_rows(table, taxpayer)
    return table.select(*spec.schema.names)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Append to a database table through JDBC; the driver must be on the class path."""
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: str, upper: str, partitions: int, **options: str
) -> DataFrame:
    """A database table through JDBC, read in ``partitions`` ranges of ``column``."""
    ranges = {"partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": str(partitions)}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **ranges, **options).load()
