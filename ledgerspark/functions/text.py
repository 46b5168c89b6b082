"""Text columns: product labels, tickers, tax ids and currency amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.fixed_values import PRODUCT_SEPARATOR

#: Every character that Unicode calls white space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def product_ticker(product: Column) -> Column:
    """Ticker of a ``"<ticker> - <company>"`` label."""
    return F.split_part(product, F.lit(PRODUCT_SEPARATOR), F.lit(1))


def product_company(product: Column) -> Column:
    """Company of a ``"<ticker> - <company>"`` label, empty when the label has no second part."""
    return F.split_part(product, F.lit(PRODUCT_SEPARATOR), F.lit(2))


def without_fraction_mark(ticker: Column) -> Column:
    """Ticker without one trailing ``F``, the mark of the odd-lot market."""
    return F.when(
        F.right(ticker, F.lit(1)) == "F", F.left(ticker, F.char_length(ticker) - 1)
    ).otherwise(ticker)


def without_float_suffix(text: Column) -> Column:
    """Text without the ``.0`` a number gets when a sheet stores it as float."""
    return F.regexp_replace(text, r"\.0\z", "")


def strip(text: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def format_tax_id(raw: Column) -> Column:
    """``XX.XXX.XXX/XXXX-XX``: digits padded on the left to 14, longer ones kept, none gives ``''``."""
    digits = F.regexp_replace(without_float_suffix(F.coalesce(raw, F.lit(""))), "[^0-9]", "")
    padded = F.when(F.length(digits) < 14, F.lpad(digits, 14, "0")).otherwise(digits)
    dotted = F.regexp_replace(padded, r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d*)\z", "$1.$2.$3/$4-$5")
    return F.when(digits == "", F.lit("")).otherwise(dotted)


def config_map(entries: dict[str, object]) -> Column:
    """Map literal of a configuration dictionary, whose size is that of the source code."""
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def resolve_tax_id(ticker: Column, raw: Column, registry: dict[str, str]) -> Column:
    """Formatted tax id, else the registry's for the ticker, else ``''``."""
    formatted = F.nullif(format_tax_id(raw), F.lit(""))
    known = F.try_element_at(config_map(registry), ticker) if registry else F.lit(None).cast("string")
    return F.coalesce(formatted, known, F.lit(""))


def format_amount(value: Column, places: int = 2) -> Column:
    """Decimal amount cut (never rounded) to ``places`` decimals, with a decimal comma; null is 0."""
    cut = F.floor(F.abs(F.coalesce(value, F.lit(0))), F.lit(places)).cast(T.DecimalType(38 - 10 + places, places))
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.replace(cut.cast("string"), F.lit("."), F.lit(",")))
