r"""Rows of text dumps made of ``COPY <table> (<columns>) FROM stdin;`` blocks that end with ``\.``.

A dump is read line by line in parallel, so a block may be larger than any task. A first scan finds the
block marks, a few lines of each dump; from these follow the places where the first blocks begin and end. A
second scan keeps the lines between. Lines are numbered by file split and place, and are in no exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.fixed_values import DASH, LEGACY_TABLES
from ledgerspark.functions.text import config_map
from ledgerspark.operators.merge import first_per_key
from ledgerspark.schemas import TAXPAYER, TableSpec

_HEADER = r"(?U)^COPY (?:public\.)?(\w+) "
_COLUMNS = r"^COPY [^(]*\(([^)]*)\)"
_END = "\\."
# Dumps whose blocks are broadcast together.
SLICE_FILES = 10_000


def dump_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the dumps at ``path``, also of empty ones; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.filter("not startswith(substring_index(path, '/', -1), '_')").select("path")


def dump_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of the dumps at ``path`` with their file, file split and order within the split."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def _is_header() -> Column:
    return F.col("value").rlike(_HEADER)


def _table_name(header: Column) -> Column:
    """Present name of the table a header names, null for tables that are not kept."""
    return F.try_element_at(config_map(LEGACY_TABLES), F.regexp_extract(header, _HEADER, 1))


def _block_marks(lines: DataFrame) -> DataFrame:
    """Every block header of each dump with its number and the place of the mark after it."""
    marks = lines.filter(_is_header() | (F.col("value") == _END)).select(
        "path", F.struct("split", "line").alias("begin"), F.when(_is_header(), F.col("value")).alias("header")
    )
    in_dump = Window.partitionBy("path").orderBy("begin")
    return (
        marks.withColumns(
            {"end": F.lead("begin").over(in_dump), "block_no": F.count("header").over(in_dump).cast("int")}
        )
        .filter("header is not null")
        .withColumn("table_name", _table_name(F.col("header")))
    )


def first_blocks(lines: DataFrame) -> DataFrame:
    """First block of every known table in each dump: its number within the dump, its header and its marks."""
    known = _block_marks(lines).filter("table_name is not null")
    return first_per_key(known, ["path", "table_name"], ["begin"])


def first_block_lines(spark: SparkSession, path: str, slice_files: int = SLICE_FILES) -> DataFrame:
    """Data lines of first blocks with their block's header.

    The blocks of at most ``slice_files`` dumps are broadcast at a time, no more than one per known table and
    dump, so their size is bounded and lines stay where they are read.
    """
    scans, names = [], []
    exact = F.regexp_replace("path", r"([\\\[\]{}*?])", r"\\$1")
    for row in dump_files(spark, path).select(exact).toLocalIterator():
        names.append(row[0])
        if len(names) == slice_files:
            scans.append(_lines_of_first_blocks(spark, names))
            names = []
    if names or not scans:
        scans.append(_lines_of_first_blocks(spark, names or [path]))
    return reduce(DataFrame.unionByName, scans)


def _lines_of_first_blocks(spark: SparkSession, names: list[str]) -> DataFrame:
    lines = dump_lines(spark, names)
    blocks = F.broadcast(first_blocks(lines).select(F.col("path").alias("_path"), "begin", "end", "header"))
    place = F.struct("split", "line")
    inside = (F.col("path") == F.col("_path")) & (place > F.col("begin"))
    inside = inside & (F.col("end").isNull() | (place < F.col("end")))
    rows = lines.join(blocks, inside).select("path", "value", "header")
    # A line that starts like a header is never data, also when it names no table.
    return rows.filter("not startswith(value, 'COPY ')")


def unescaped(cell: Column) -> Column:
    r"""Cell without COPY's backslash escapes; ``\N`` is null."""
    text = F.replace(cell, F.lit("\\\\"), F.lit("\x00"))
    for escape, char in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\\b", "\b"), ("\\f", "\f"), ("\\v", "\v")):
        text = F.replace(text, F.lit(escape), F.lit(char))
    return F.when(cell != "\\N", F.replace(text, F.lit("\x00"), F.lit("\\")))


def null_dashes(cells: Column) -> Column:
    """Cells with a lone dash as null; dashes inside a text stay."""
    return F.transform(cells, lambda c: F.when(c != DASH, c))


def dump_rows(spark: SparkSession, path: str) -> DataFrame:
    """Cells and column names of the first block of every known table in each dump."""
    names = F.split(F.regexp_extract("header", _COLUMNS, 1), r",\s*")
    raw = F.transform(F.split("value", "\t"), unescaped)
    return first_block_lines(spark, path).select(
        "path",
        _table_name(F.col("header")).alias("table_name"),
        F.transform(names, lambda n: F.trim(F.replace(n, F.lit('"'), F.lit("")))).alias("columns"),
        null_dashes(raw).alias("cells"),
    )


def legacy_table(rows: DataFrame, spec: TableSpec, taxpayer: Column) -> DataFrame:
    """Typed rows of one table from dump rows; dates are day-first or ISO."""
    by_name = rows.filter(F.col("table_name") == spec.name).select(
        taxpayer.alias(TAXPAYER), F.map_from_arrays("columns", "cells").alias("_m")
    )
    fields = [f for f in spec.schema if f.name != TAXPAYER]
    return by_name.select(
        TAXPAYER,
        *[
            _typed(F.try_element_at("_m", F.lit(f.name)), f.dataType).alias(f.name)
            for f in fields
        ],
    )


def _typed(cell: Column, kind) -> Column:
    if kind.typeName() != "date":
        return cell.cast(kind)
    iso = cell.rlike(r"^\d{4}-")
    return F.when(iso, cell.cast("date")).otherwise(F.to_date(cell, "d/M/yyyy"))
