"""Repeated imports as one incremental stream: only unseen rows are added."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.joins import without_match
from ledgerspark.operators.merge import append_new_rows, first_per_key
from ledgerspark.plans.import_run import import_cells
from ledgerspark.schemas import TAXPAYER, TableSpec
from ledgerspark.session import remove_dir, scratch_dir
from ledgerspark.sources.reports import report_cells, with_owner


def import_increment(
    stream: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    spec: TableSpec,
    order: list[Column | str],
    run: str,
) -> None:
    """Bring the rows of all new files of a file stream into the table at ``target``, then stop.

    The checkpoint skips files already seen; rows of a new file that the table has are ignored by
    key. A batch that is repeated after a failure therefore adds nothing twice. A batch is prepared once,
    into a scratch table that goes after its append.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        scratch, rows = scratch_dir(spark, "batch"), prepare(batch)
        rows.write.parquet(scratch)
        append_new_rows(spark.read.schema(rows.schema).parquet(scratch), target, spec, order, f"{run}-{batch_id}")
        remove_dir(spark, scratch)

    _drain(stream, write_batch, checkpoint)


_REPORT = [TAXPAYER, "report", "ref_year"]
_CHOSEN = f"{TAXPAYER} string, report string, ref_year int, age long, path string, length long"


def import_new_reports(
    spark: SparkSession,
    folder: str,
    tables_dir: str,
    checkpoint: str,
    run: str,
    pages: DataFrame,
    files_per_batch: int | None = None,
) -> DataFrame | None:
    """Import the newest file of every taxpayer, report and year of ``folder``, as a batch import of it would.

    A stream over file names keeps the newest file of each report as its state, across runs; a file that arrives late
    but is older than the one known changes nothing. What becomes newest goes to a log beside the checkpoint. Once
    all new names are seen, the newest files that are not imported yet are opened and imported. A run that fails
    after that point leaves its choice in the log, and the next one imports it. Gives the summary, or None if there
    was nothing to import.
    """
    _drain_names(spark, folder, checkpoint, files_per_batch)
    pending = _pending_reports(spark, checkpoint)
    if pending is None:
        return None
    scratch = scratch_dir(spark, "pending")
    pending.write.parquet(scratch)
    chosen = spark.read.schema(_CHOSEN).parquet(scratch)
    summary = None
    if not chosen.isEmpty():
        summary = import_cells(spark, report_cells(spark, folder, chosen), tables_dir, run, pages)
        chosen.write.mode("append").parquet(f"{checkpoint}/imported")
    remove_dir(spark, scratch)
    return summary


def _drain_names(spark: SparkSession, folder: str, checkpoint: str, files_per_batch: int | None) -> None:
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.xlsx")
    if files_per_batch:
        files = files.option("maxFilesPerTrigger", files_per_batch)
    named = with_owner(files.option("recursiveFileLookup", "true").load(folder).drop("content"))
    # The smallest is the newest; equal times are decided by path.
    age = (-F.unix_micros("modificationTime")).alias("age")
    newest = named.groupBy(*_REPORT).agg(F.min(F.struct(age, "path", "length")).alias("_file"))

    def log(batch: DataFrame, batch_id: int) -> None:
        # A batch that is repeated writes its part of the log again.
        batch.select(*_REPORT, "_file.*").write.mode("overwrite").parquet(f"{checkpoint}/chosen/batch={batch_id}")

    _drain(newest, log, f"{checkpoint}/stream", "update")


def _pending_reports(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """The newest known file of each report, unless it is the one that was imported last."""
    chosen = _logged(spark, f"{checkpoint}/chosen")
    if chosen is None:
        return None
    newest = first_per_key(chosen, _REPORT, ["age", "path"])
    imported = _logged(spark, f"{checkpoint}/imported")
    if imported is None:
        return newest
    return without_match(newest, imported.select(*_REPORT, "age", "path"), [*_REPORT, "age", "path"])


def _logged(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_CHOSEN).parquet(path).select(*_REPORT, "age", "path", "length")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _drain(
    stream: DataFrame, write_batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    query = (
        stream.writeStream.foreachBatch(write_batch)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
