"""Import of all reports in a folder, and load of older dumps, into stored tables."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.bonus import enrich_bonus, page_cards, pages_to_read, typed_cards
from ledgerspark.operators.ingest import route_sheets, table_rows
from ledgerspark.operators.merge import append_new_rows
from ledgerspark.plans.totals import drop_totals, forbid_counted_run, log_run
from ledgerspark.schemas import TABLES, TAXPAYER, TableSpec, table_spec
from ledgerspark.session import remove_dir, scratch_dir
from ledgerspark.sources.legacy_dump import dump_files, dump_rows, legacy_table
from ledgerspark.sources.reports import latest_reports, report_cells
from ledgerspark.sources.tables import INGEST_RUN, replace_taxpayers

MOVEMENT_TABLE, BONUS_TABLE = "b3_movimentacao", "b3_bonificacao_acoes"
# Order of arrival: it decides which of several rows with one key stays.
ARRIVAL = ["path", "row_idx"]
#: Name of the import that rows of older dumps count as.
LEGACY = "legacy"


def table_path(tables_dir: str, table: str) -> str:
    return f"{tables_dir.rstrip('/')}/{table}"


SUMMARY = "table_name string, rows_processed long, rows_inserted long, status string"


def run_import(
    spark: SparkSession,
    folder: str,
    tables_dir: str,
    run: str,
    pages: DataFrame,
    year: int | None = None,
    tables: Iterable[str] = tuple(TABLES),
) -> DataFrame:
    """Import the newest reports of ``folder``; returns rows read and added per table.

    ``pages`` are stored company pages ``(ticker, html)`` for the base values of bonus shares.
    """
    cells = report_cells(spark, folder, latest_reports(spark, folder, year))
    return import_cells(spark, cells, tables_dir, run, pages, tables)


def import_cells(
    spark: SparkSession,
    cells: DataFrame,
    tables_dir: str,
    run: str,
    pages: DataFrame,
    tables: Iterable[str] = tuple(TABLES),
) -> DataFrame:
    """Import the cells of report files.

    Workbooks are opened once: a job that is alone reads the cells as they come, several read them from a scratch
    table. Each job is one plan to typed rows, kept in such a table, and one append of the unseen ones; rows are counted
    as they are written. The jobs write different tables and run side by side, so Spark fills the cores that a small
    one leaves.
    """
    forbid_counted_run(spark, tables_dir, run)
    scratch = scratch_dir(spark, "import")
    names = list(tables)
    staged = route_sheets(cells)
    # Bonus rows need the movements twice.
    if len(names) > 1 or BONUS_TABLE in names:
        staged.write.partitionBy("table_name").parquet(f"{scratch}/cells")
        staged = spark.read.schema(staged.schema).parquet(f"{scratch}/cells")

    def job(name: str) -> tuple[str, int, int, str]:
        spec, read = table_spec(name), Observation()
        rows = _job_rows(staged, spec, pages)
        rows.observe(read, F.count(F.lit(1)).alias("n")).write.parquet(f"{scratch}/{name}")
        typed = spark.read.schema(rows.schema).parquet(f"{scratch}/{name}")
        order = [*ARRIVAL, "card_no"] if name == BONUS_TABLE else ARRIVAL
        return name, read.get["n"], append_new_rows(typed, table_path(tables_dir, name), spec, order, run), "ok"

    with ThreadPoolExecutor(len(names) or 1) as pool:
        summary = list(pool.map(inheritable_thread_target(spark)(job), names))
    log_run(spark, tables_dir, run)
    remove_dir(spark, scratch)
    return spark.createDataFrame(summary, SUMMARY)


def _job_rows(staged: DataFrame, spec: TableSpec, pages: DataFrame) -> DataFrame:
    if spec.name != BONUS_TABLE:
        return table_rows(staged.filter(F.col("table_name") == spec.name), spec)
    movements = table_rows(staged.filter(F.col("table_name") == MOVEMENT_TABLE), table_spec(MOVEMENT_TABLE))
    events = typed_cards(page_cards(pages_to_read(pages, movements)))
    return enrich_bonus(movements, events)


def run_legacy_load(spark: SparkSession, dumps: str, tables_dir: str, taxpayer: Column) -> None:
    """Replace the rows of the dumps' taxpayers by the first blocks of their dumps.

    ``taxpayer`` says whose dump a row is from, as a literal or from its ``path``. A table without a block is
    emptied for these taxpayers; rows of all others stay.
    """
    scratch = scratch_dir(spark, "legacy")
    rows = dump_rows(spark, dumps)
    rows.write.partitionBy("table_name").parquet(f"{scratch}/rows")
    staged = spark.read.schema(rows.schema).parquet(f"{scratch}/rows")
    owners = dump_files(spark, dumps).select(taxpayer.alias(TAXPAYER)).distinct()
    for spec in TABLES.values():
        table = legacy_table(staged, spec, taxpayer).withColumn(INGEST_RUN, F.lit(LEGACY))
        replace_taxpayers(spark, table, owners, table_path(tables_dir, spec.name), spec)
    drop_totals(spark, tables_dir)
    log_run(spark, tables_dir, LEGACY)
    remove_dir(spark, scratch)
