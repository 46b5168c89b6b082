"""Income views and the tax categories built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.fixed_values import BONUS, CATEGORY_OF_TYPE, INCOME_TYPES, SCALAR_CATEGORIES
from ledgerspark.functions.text import config_map, product_company, product_ticker
from ledgerspark.operators.merge import first_per_key
from ledgerspark.schemas import MONEY_SUM, TAXPAYER

YEAR = "ano_base"


def of_year(date: Column, year: int | None) -> Column:
    """Rows of a year as a date range, which the Parquet scan can use; all rows without a year."""
    if year is None:
        return F.lit(True)
    start, end = (F.make_date(F.lit(y), F.lit(1), F.lit(1)) for y in (year, year + 1))
    return (date >= start) & (date < end)


def latest_position(positions: DataFrame) -> DataFrame:
    """Tax id and company of each taxpayer's newest custody row per ticker; no date counts as newest."""
    rows = positions.select(TAXPAYER, "codigo_negociacao", "cnpj", "produto", "data_pregao", "id")
    newest = first_per_key(
        rows,
        [TAXPAYER, "codigo_negociacao"],
        [F.col("data_pregao").desc_nulls_first(), F.col("id").asc_nulls_last()],
    )
    return newest.select(
        TAXPAYER,
        F.col("codigo_negociacao").alias("ticker"),
        "cnpj",
        product_company(F.col("produto")).alias("nome_compania"),
    )


def _totals(events: DataFrame, kind: str, amount: str, year: int | None, drop_zero: bool) -> DataFrame:
    """Amount per taxpayer, year, ticker, company and type."""
    totals = (
        events.filter(of_year(F.col("data_pregao"), year))
        .select(
            TAXPAYER,
            F.year("data_pregao").alias(YEAR),
            product_ticker(F.col("produto")).alias("ticker"),
            product_company(F.col("produto")).alias("nome_compania"),
            F.col(kind).alias("movimentacao"),
            F.col(amount).alias("_amount"),
        )
        .groupBy(TAXPAYER, YEAR, "ticker", "nome_compania", "movimentacao")
        .agg(F.sum("_amount").cast(MONEY_SUM).alias("valor_operacao"))
    )
    return totals.filter(F.col("valor_operacao") != 0) if drop_zero else totals


def _with_tax_ids(totals: DataFrame, positions: DataFrame) -> DataFrame:
    """Totals with the tax id of the taxpayer's newest position in the ticker.

    The tax id depends on taxpayer and ticker alone, so joining it after adding up leaves the groups
    as they are, and the join sees one row per group instead of every event.
    """
    tax_ids = latest_position(positions).select(TAXPAYER, "ticker", "cnpj")
    return totals.join(tax_ids, [TAXPAYER, "ticker"], "left").select(
        TAXPAYER,
        YEAR,
        "ticker",
        F.coalesce("cnpj", F.lit("")).alias("cnpj"),
        "nome_compania",
        "movimentacao",
        "valor_operacao",
    )


def _bonus_totals(bonus: DataFrame, year: int | None) -> DataFrame:
    rows = bonus.filter(F.col("movimentacao") == BONUS)
    return _totals(rows, "movimentacao", "valor_operacao", year, drop_zero=False)


def _income_totals(movements: DataFrame, year: int | None) -> DataFrame:
    rows = movements.filter(F.col("movimentacao").isin(*INCOME_TYPES))
    return _totals(rows, "movimentacao", "valor_operacao", year, drop_zero=True)


def bonus_income(bonus: DataFrame, positions: DataFrame, year: int | None = None) -> DataFrame:
    """Bonus value per taxpayer, year, ticker, tax id and company."""
    return _with_tax_ids(_bonus_totals(bonus, year), positions).drop("movimentacao")


def income(movements: DataFrame, positions: DataFrame, year: int | None = None) -> DataFrame:
    """Income per taxpayer, year, ticker, tax id, company and movement type; zero totals left out."""
    return _with_tax_ids(_income_totals(movements, year), positions)


def income_and_bonus(
    movements: DataFrame, bonus: DataFrame, positions: DataFrame, year: int | None = None
) -> DataFrame:
    """Income and bonus rows together, bonuses under their movement type, tax ids joined once."""
    totals = _income_totals(movements, year).unionByName(_bonus_totals(bonus, year))
    return _with_tax_ids(totals, positions)


def income_from_annual(
    received: DataFrame, reimbursed: DataFrame, positions: DataFrame, year: int | None = None
) -> DataFrame:
    """Earlier form of the income view, from the annual report's two event tables."""
    parts = [
        _totals(t, "tipo_evento", "valor_liquido", year, drop_zero=True) for t in (received, reimbursed)
    ]
    return _with_tax_ids(parts[0].unionByName(parts[1]), positions)


def view_income(movements: DataFrame, positions: DataFrame) -> DataFrame:
    """Income in the view's row order within each taxpayer."""
    return income(movements, positions).orderBy(TAXPAYER, F.desc(YEAR), "ticker", "cnpj")


def view_bonus_income(bonus: DataFrame, positions: DataFrame) -> DataFrame:
    """Bonus income in the view's row order within each taxpayer."""
    return bonus_income(bonus, positions).orderBy(TAXPAYER, "ticker", F.desc(YEAR))


def income_of_types(income_rows: DataFrame, types: list[str], year: int | None = None) -> DataFrame:
    """Income rows of some movement types, and of one year if given."""
    rows = income_rows.filter(F.col("movimentacao").isin(*types))
    return rows if year is None else rows.filter(F.col(YEAR) == year)


def _category() -> Column:
    return F.try_element_at(config_map(CATEGORY_OF_TYPE), F.col("movimentacao"))


def _summed(rows: DataFrame, key: list[str]) -> DataFrame:
    """Plain and transferred payments added up.

    The label is the smallest type, which is the plain one where both occur; the company is the
    smallest spelling.
    """
    return rows.groupBy(*key).agg(
        F.min("cnpj").alias("cnpj"),
        F.min("nome_compania").alias("nome_compania"),
        F.min("movimentacao").alias("movimentacao"),
        F.sum("valor_operacao").cast(MONEY_SUM).alias("valor_operacao"),
    )


def by_category(income_rows: DataFrame) -> DataFrame:
    """Income per taxpayer, year, ticker and tax category."""
    rows = income_rows.withColumn("category", _category())
    return _summed(rows, [TAXPAYER, YEAR, "ticker", "category"])


def of_active_tickers(rows: DataFrame, active: DataFrame) -> DataFrame:
    """Rows of tickers that the taxpayer held or lent in that year."""
    return rows.join(active, [TAXPAYER, YEAR, "ticker"], "left_semi")


def section_events(income_rows: DataFrame, active: DataFrame, types: list[str]) -> DataFrame:
    """One amount per active ticker for a section made of ``types``."""
    return of_active_tickers(by_category(income_of_types(income_rows, types)), active).drop("category")


def section_bonus(bonus_rows: DataFrame, active: DataFrame) -> DataFrame:
    """Bonus shares of active tickers, one amount per ticker."""
    rows = bonus_rows.withColumn("movimentacao", F.lit(BONUS))
    return of_active_tickers(by_category(rows), active).drop("category")


def section_total(income_rows: DataFrame, years: DataFrame, kind: str) -> DataFrame:
    """Total of one movement type for every taxpayer and year in ``years``, 0 where there is none.

    Not limited to active tickers.
    """
    totals = (
        income_of_types(income_rows, [kind])
        .groupBy(TAXPAYER, YEAR)
        .agg(F.sum("valor_operacao").cast(MONEY_SUM).alias("valor_operacao"))
    )
    return years.join(totals, [TAXPAYER, YEAR], "left").select(
        TAXPAYER,
        YEAR,
        F.coalesce("valor_operacao", F.lit(0)).cast(MONEY_SUM).alias("valor_operacao"),
    )


def declared_entries(rows: DataFrame, active: DataFrame, years: DataFrame | None = None) -> DataFrame:
    """All declared amounts in one pass: per active ticker, and one row per scalar category.

    ``rows`` are income and bonus rows. Scalar categories have an empty ticker and take every
    ticker's income; with ``years`` they have a row, of 0 if need be, in each of those.
    """
    scalar = F.col("category").isin(*SCALAR_CATEGORIES)
    flagged = rows.withColumn("category", _category()).join(
        active.withColumn("_active", F.lit(True)), [TAXPAYER, YEAR, "ticker"], "left"
    )

    def of_ticker(column: str) -> Column:
        return F.when(scalar, F.lit("")).otherwise(F.col(column)).alias(column)

    kept = flagged.filter(scalar | F.col("_active")).select(
        TAXPAYER,
        YEAR,
        "category",
        of_ticker("ticker"),
        of_ticker("cnpj"),
        of_ticker("nome_compania"),
        "movimentacao",
        "valor_operacao",
    )
    if years is not None:
        kept = kept.unionByName(_zero_totals(years))
    return _summed(kept, [TAXPAYER, YEAR, "category", "ticker"])


def _zero_totals(years: DataFrame) -> DataFrame:
    categories = F.explode(F.array(*[F.lit(c) for c in SCALAR_CATEGORIES])).alias("category")
    return years.select(TAXPAYER, YEAR, categories).select(
        "*",
        F.lit("").alias("ticker"),
        F.lit("").alias("cnpj"),
        F.lit("").alias("nome_compania"),
        F.lit(None).cast("string").alias("movimentacao"),
        F.lit(0).cast(MONEY_SUM).alias("valor_operacao"),
    )
