"""Cleaning of text cells as they come out of the exchange's workbooks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.fixed_values import DASH, MAX_MISSING_CELLS, MISSING_CELLS, NO_DATE
from ledgerspark.functions.text import strip

# Wide enough for every declared column type; narrowed by the cast to the table's type.
PARSED_NUMBER = T.DecimalType(38, 12)


def is_missing(cell: Column) -> Column:
    # One reference to the cell: it may be an expression that costs something.
    return F.coalesce(cell, F.lit("")).isin(*MISSING_CELLS)


def missing_count(cells: list[Column]) -> Column:
    """Number of missing cells in a row."""
    return F.size(F.filter(F.array(*cells), is_missing))


def missing_allowed(n_columns: int) -> int:
    """A row may miss half of its cells, and never more than three."""
    return min(n_columns // 2, MAX_MISSING_CELLS)


def _checked(value: Column, cell: Column, dash: Column, what: str, strict: bool) -> Column:
    """``value`` where the cell could be read, ``dash`` for a dash, null for a missing cell.

    Any other cell fails the job, or is null when not ``strict``. The value is evaluated once; the
    rest only for cells that could not be read.
    """
    unread = F.when(cell == DASH, dash)
    if strict:
        message = F.concat(F.lit(f"unreadable {what}: "), cell)
        unread = unread.when(cell.isNotNull(), F.raise_error(message))
    return F.coalesce(value, unread)


def clean_number(cell: Column, strict: bool = True) -> Column:
    """``1.234,56`` as a number, a dash as 0; an unreadable cell fails the job (or is null)."""
    # Points are dropped and the comma becomes a point.
    value = F.translate(cell, ",.", ".").try_cast(PARSED_NUMBER)
    return _checked(value, cell, F.lit(0).cast(PARSED_NUMBER), "number", strict)


def clean_string(cell: Column) -> Column:
    """Cell without outer white space; a missing cell stays null."""
    return strip(cell)


def clean_date(cell: Column, strict: bool = True) -> Column:
    """``DD/MM/YYYY`` as a date, a dash as the far-future date; an impossible date fails the job."""
    return _checked(F.try_to_date(cell, "d/M/yyyy"), cell, F.lit(NO_DATE), "date", strict)


def cast_cell(value: Column, to: T.DataType) -> Column:
    """Cleaned value as a table type; whole-number types drop the fraction instead of rounding."""
    if isinstance(to, T.IntegerType):
        return value.cast("long").cast(to)
    if isinstance(to, T.DecimalType) and to.scale == 0:
        return F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast(to)
    return value.cast(to)


def clean_cell(cell: Column, to: T.DataType, strict: bool = True) -> Column:
    """Clean a text cell by the type of the table column it goes to, then cast it."""
    if isinstance(to, T.DateType):
        return clean_date(cell, strict)
    if isinstance(to, T.StringType):
        return clean_string(cell)
    return cast_cell(clean_number(cell, strict), to)
