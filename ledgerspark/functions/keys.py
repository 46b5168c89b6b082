"""Row keys built from column values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerspark.fixed_values import SHEET_DATE_FORMAT
from ledgerspark.schemas import PRICE, TAXPAYER


def number_text(value: Column) -> Column:
    """Shortest decimal text with at least one decimal and a comma: 7 → ``7,0``, 1.50 → ``1,5``.

    Built on a fixed-scale decimal, so it never depends on how a float is printed.
    """
    plain = F.rtrim(value.cast(PRICE).cast("string"), F.lit("0"))
    text = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    return F.replace(text, F.lit("."), F.lit(","))


def _joined(*parts: Column) -> Column:
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def movement_key() -> Column:
    """Direction, date, type, product, quantity, unit price and value of a movement as one text."""
    return _joined(
        F.col("entrada_saida"),
        F.date_format("data_pregao", SHEET_DATE_FORMAT),
        F.col("movimentacao"),
        F.col("produto"),
        number_text(F.col("quantidade")),
        number_text(F.col("preco_unitario")),
        number_text(F.col("valor_operacao")),
    )


def trade_key() -> Column:
    """Date, side, ticker, quantity and price of a trade as one text."""
    return _joined(
        F.date_format("data_negocio", SHEET_DATE_FORMAT),
        F.col("tipo_movimentacao"),
        F.col("ticker"),
        F.col("quantidade").cast("string"),
        number_text(F.col("preco")),
    )


def surrogate_key(natural_key: list[str]) -> Column:
    """Id that depends only on the row's natural key, so that a repeated import agrees.

    Bars and backslashes inside a part are escaped, so different keys never make one text.
    """
    texts = [F.regexp_replace(F.col(c).cast("string"), r"([\\|])", r"\\$1") for c in [TAXPAYER, *natural_key]]
    parts = [F.coalesce(t, F.lit("\\N")) for t in texts]
    return F.sha2(F.concat_ws("|", *parts), 256)


def row_key(id_column: str, natural_key: tuple[str, ...]) -> Column:
    """Id of a table row: a readable key for movements and trades, a hash for annual tables."""
    if id_column == "pk_movimentacao":
        return movement_key()
    if id_column == "pk_negociacao":
        return trade_key()
    return surrogate_key(list(natural_key))
