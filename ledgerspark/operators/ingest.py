"""From sheet cells to typed table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.fixed_values import ANNUAL_SHEETS
from ledgerspark.functions.clean import clean_cell, missing_allowed, missing_count
from ledgerspark.functions.keys import row_key
from ledgerspark.functions.text import config_map, without_float_suffix
from ledgerspark.schemas import ANNUAL, MOVEMENTS, TAXPAYER, TRADES, TableSpec

REFERENCE_DATE_COLUMN = "data_pregao"


def sheet_of_table(table: str) -> str:
    """Sheet of the annual report that feeds ``table``; a table without one is an error."""
    for sheet, name in ANNUAL_SHEETS.items():
        if name == table:
            return sheet
    raise ValueError(f"the annual report has no sheet for table: {table}")


def route_sheets(cells: DataFrame) -> DataFrame:
    """Add ``table_name``: by sheet name in annual reports, the first sheet in the other reports.

    Sheets that feed no table are left out.
    """
    first = F.col("sheet_no") == 0
    table = (
        F.when(F.col("report") == ANNUAL, F.try_element_at(config_map(ANNUAL_SHEETS), F.col("sheet")))
        .when((F.col("report") == MOVEMENTS) & first, F.lit("b3_movimentacao"))
        .when((F.col("report") == TRADES) & first, F.lit("b3_negociacao"))
    )
    return cells.withColumn("table_name", table).filter("table_name is not null")


def positional_columns(df: DataFrame, names: list[str], keep: list[str], cells: str = "cells") -> DataFrame:
    """Name cells by position; a sheet one column short lacks the last name, which becomes null."""
    n = len(names)
    width = F.size(cells)
    wrong = F.raise_error(F.concat(F.lit(f"expected {n} columns, found "), width.cast("string")))
    checked = F.when(width.isin(n, n - 1), F.col(cells)).otherwise(wrong)
    return df.select(*keep, checked.alias("_cells")).select(
        *keep, *[F.get("_cells", F.lit(i)).alias(name) for i, name in enumerate(names)]
    )


def drop_sparse_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Leave out rows that miss more cells than a row may."""
    return df.filter(missing_count([F.col(c) for c in columns]) <= missing_allowed(len(columns)))


def with_reference_date(df: DataFrame, year: Column) -> DataFrame:
    """31 December of ``year`` as the date of annual rows, as a sheet would print it."""
    return df.withColumn(REFERENCE_DATE_COLUMN, F.concat(F.lit("31/12/"), year.cast("string")))


def typed_columns(df: DataFrame, spec: TableSpec, keep: list[str], strict: bool = True) -> DataFrame:
    """Clean every cell by its column type and cast it to that type."""
    columns = []
    for name, kind in spec.columns:
        cell = clean_cell(F.col(name), kind, strict)
        columns.append((without_float_suffix(cell) if name == "cnpj" else cell).alias(name))
    return df.select(*keep, *columns)


def cast_to_schema(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns in table order and type; columns the input lacks become typed nulls."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spec.schema
        ]
    )


def table_rows(cells: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """Typed, keyed rows of one table from its routed cells.

    ``cells`` has ``taxpayer_id``, ``path``, ``row_idx``, ``ref_year`` and ``cells``; row 0 of a
    sheet is its header. ``path`` and ``row_idx`` are kept: they are the order of arrival.
    """
    keep = [TAXPAYER, "path", "row_idx", "ref_year"]
    # The bonus table is built from the movement sheet.
    names = spec.column_names
    rows = positional_columns(cells.filter("row_idx > 0"), names, keep)
    # The date of annual rows is added after the sparse test and does not count in it.
    in_sheet = [n for n in names if not (spec.annual and n == REFERENCE_DATE_COLUMN)]
    rows = drop_sparse_rows(rows, in_sheet)
    if spec.annual:
        rows = with_reference_date(rows, F.col("ref_year"))
    typed = typed_columns(rows, spec, keep, strict)
    return typed.withColumn(spec.id_column, row_key(spec.id_column, spec.natural_key))
