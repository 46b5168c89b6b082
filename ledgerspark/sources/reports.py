"""Report files: whose they are, which is the newest, and their contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.merge import first_per_key
from ledgerspark.schemas import ANNUAL, MOVEMENTS, TAXPAYER, TRADES
from ledgerspark.sources.workbook import opened_by_tasks, workbook_cells, workbook_cells_at

# Annual reports have exactly this name, the others may go on after the year.
_NAME = rf"^(.+)-(?:({MOVEMENTS}|{TRADES})-(\d{{4}}).*|({ANNUAL})-(\d{{4}}))\.xlsx\z"


def binary_files(spark: SparkSession, folder: str) -> DataFrame:
    """Workbooks below a folder: path, modification time, length and content."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xlsx")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )


def with_owner(files: DataFrame) -> DataFrame:
    """Add taxpayer, report and reference year from ``<taxpayer>-<report>-<year>….xlsx``."""
    name = F.substring_index("path", "/", -1)
    parts = files.withColumns(
        {
            TAXPAYER: F.regexp_extract(name, _NAME, 1),
            # One of the two forms of a name matches, the groups of the other are empty.
            "report": F.concat(F.regexp_extract(name, _NAME, 2), F.regexp_extract(name, _NAME, 4)),
            "_year": F.concat(F.regexp_extract(name, _NAME, 3), F.regexp_extract(name, _NAME, 5)),
        }
    )
    # Other files give empty parts.
    named = parts.filter("_year <> ''")
    return named.withColumn("ref_year", F.col("_year").cast("int")).drop("_year")


def latest_files(files: DataFrame) -> DataFrame:
    """Newest file of every taxpayer, report and year; equal times are decided by path."""
    return first_per_key(
        files,
        [TAXPAYER, "report", "ref_year"],
        [F.col("modificationTime").desc(), F.col("path").asc()],
    )


def of_year(files: DataFrame, year: int) -> DataFrame:
    """Files an import of ``year`` reads: that year's reports and the annual report before it."""
    annual = F.col("report") == ANNUAL
    return files.filter(F.col("ref_year") == F.when(annual, F.lit(year - 1)).otherwise(F.lit(year)))


def missing_reports(latest: DataFrame) -> DataFrame:
    """Taxpayers that lack one of the three reports, with the reports they have."""
    found = latest.groupBy(TAXPAYER).agg(F.sort_array(F.collect_set("report")).alias("reports"))
    return found.filter(F.size("reports") < 3)


def latest_reports(spark: SparkSession, folder: str, year: int | None = None) -> DataFrame:
    """The newest files of a folder, without their contents; a report that is missing is an error.

    With a year, every taxpayer needs all three reports of it. The choice is made on file names and times.
    """
    named = with_owner(binary_files(spark, folder).select("path", "modificationTime", "length"))
    latest = latest_files(named if year is None else of_year(named, year))
    if year is not None:
        lacking = missing_reports(latest).limit(5).collect()
        if lacking:
            have = "; ".join(f"{r[0]} has only {', '.join(r[1])}" for r in lacking)
            raise FileNotFoundError(f"reports missing in {folder}: {have}")
    if latest.isEmpty():
        raise FileNotFoundError(f"no report in {folder}")
    return latest


def report_cells(spark: SparkSession, folder: str, chosen: DataFrame) -> DataFrame:
    """Cells of chosen files of a folder (``path``, ``length``) with their owner's columns.

    Tasks open the files by name: neither names nor contents pass through the driver, and contents are in no
    exchange. In a store that only Spark's reader opens, the folder is scanned and other files' contents are dropped.
    """
    if opened_by_tasks(folder):
        # The owner is found once per file, not once per row.
        return workbook_cells_at(with_owner(chosen.select("path", "length")))
    contents = binary_files(spark, folder).join(chosen.select("path"), "path", "left_semi")
    return with_owner(workbook_cells(contents))
