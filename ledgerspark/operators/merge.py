"""Repeats: one row per key, insert-or-ignore and its write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgerspark.functions.joins import without_match
from ledgerspark.schemas import TAXPAYER, TableSpec
from ledgerspark.sources.tables import BUCKET, INGEST_RUN, bucket_of, stored_rows, write_table

#: Rows of a batch whose keys Spark may broadcast; a larger one is sorted together with the stored keys.
SMALL_BATCH = 100_000


def first_per_key(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """First row of each key (null key parts are equal) in the given order.

    Spark keeps one row per key in every map task before it shuffles (WindowGroupLimit), so a key
    that holds a third of all rows brings one row per input partition to its task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def keep_smallest_id(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Repair of a table with repeats: the smallest id of each natural key stays."""
    return first_per_key(df, spec.key, [F.col(spec.id_column).asc_nulls_last()])


def new_rows(batch: DataFrame, existing: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing``, one per key.

    Repeats go first, so no key is hot in the anti-join, and only key columns of ``existing`` move.
    """
    return without_match(first_per_key(batch, key, order), existing, key)


def new_rows_of_many(batch: DataFrame, existing: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """The same for a batch that is too large to broadcast: no joins, one exchange of its rows and the stored keys.

    Stored keys come first, so that they are what stays of their rows; null key parts are equal.
    """
    stored = existing.select(*key, F.lit(True).alias("_stored"))
    both = batch.withColumn("_stored", F.lit(False)).unionByName(stored, allowMissingColumns=True)
    return first_per_key(both, key, [F.col("_stored").desc(), *order]).filter("not _stored").drop("_stored")


def insert_ignore(
    existing: DataFrame, batch: DataFrame, key: list[str], order: list[Column | str]
) -> DataFrame:
    """The table after an insert that ignores rows whose key it already has."""
    return existing.unionByName(new_rows(batch, existing, key, order))


def append_new_rows(
    batch: DataFrame, path: str, spec: TableSpec, order: list[Column | str], run: str
) -> int:
    """Append the unseen rows of ``batch`` to the stored table at ``path``, marked with ``run``; gives their number.

    Every row is decided by its key alone: a run that failed half-way can be repeated and adds only
    what is missing. New rows are written once, and counted by the tasks that write them. ``batch`` is read several
    times, so keep it in a table. One writer per table at a time; plain Parquet has no transactions.
    """
    existing = stored_rows(batch.sparkSession, path, spec)
    if existing is None:
        rows = first_per_key(batch, spec.key, order)
    else:
        unseen = new_rows if batch.count() <= SMALL_BATCH else new_rows_of_many
        rows = unseen(batch, _within_reach(existing, batch, spec.date_column), spec.key, order)
    added = Observation()
    write_table(rows.select(*spec.schema.names, F.lit(run).alias(INGEST_RUN)), path, spec, "append", added)
    return added.get["n"]


def _within_reach(existing: DataFrame, batch: DataFrame, date_column: str) -> DataFrame:
    """Stored rows that can have a key of the batch: its taxpayers' buckets, its range of dates.

    Both limits reach the scan. One row comes to the driver, with at most one number per bucket.
    """
    day = F.col(date_column)
    buckets, first, last, n_undated = batch.agg(
        F.collect_set(bucket_of(F.col(TAXPAYER))), F.min(day), F.max(day), F.count_if(day.isNull())
    ).first()
    dated = F.lit(False) if first is None else day.between(F.lit(first), F.lit(last))
    return existing.filter(F.col(BUCKET).isin(buckets) & (dated | day.isNull() if n_undated else dated))


def import_summary(read: DataFrame, inserted: DataFrame) -> DataFrame:
    """Rows read and rows added per table; both frames carry a ``table_name`` column.

    ``rows_processed`` counts the rows read, repeats included, as the import log always did.
    """
    n_read = read.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows_processed"))
    n_new = inserted.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows_inserted"))
    return n_read.join(n_new, "table_name", "left").select(
        "table_name",
        "rows_processed",
        F.coalesce("rows_inserted", F.lit(0)).cast("long").alias("rows_inserted"),
        F.lit("ok").alias("status"),
    )


def write_summary(summary: DataFrame, path: str) -> None:
    """Import summary as one JSON object per table."""
    summary.coalesce(1).write.mode("overwrite").json(path)
