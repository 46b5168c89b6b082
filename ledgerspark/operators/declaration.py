"""Declared positions, active tickers and the nested declaration record."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.fixed_values import (
    BONUS,
    DELISTED_TAX_IDS,
    EXEMPT_BONUS_SHARES,
    EXEMPT_DIVIDEND,
    EXEMPT_FRACTION_AUCTION,
    EXEMPT_REIMBURSEMENT,
    INCOME_TYPES,
    TAXABLE_JCP,
    TAXABLE_LENDING,
    TAXABLE_MONETARY_UPDATE,
)
from ledgerspark.functions.numeric import AMOUNT
from ledgerspark.functions.text import product_ticker, resolve_tax_id
from ledgerspark.operators.income import YEAR, of_year
from ledgerspark.operators.merge import first_per_key
from ledgerspark.schemas import MONEY_SUM, TAXPAYER

DECLARATION_KEY = [TAXPAYER, YEAR]

EVENT_LISTS = {
    EXEMPT_DIVIDEND: "exempt_dividends",
    TAXABLE_JCP: "taxable_jcp",
    TAXABLE_MONETARY_UPDATE: "taxable_monetary_update",
    EXEMPT_FRACTION_AUCTION: "fraction_auction",
    EXEMPT_BONUS_SHARES: "bonus_shares",
}
SCALARS = {TAXABLE_LENDING: "lending_income", EXEMPT_REIMBURSEMENT: "reimbursement"}


def default_base_year() -> int:
    """The year before the current one."""
    return date.today().year - 1


def active_tickers(custody: DataFrame, loans: DataFrame, year: int | None = None) -> DataFrame:
    """Tickers a taxpayer held or lent in a year."""
    held = custody.filter(of_year(F.col("data_pregao"), year)).select(
        TAXPAYER, F.year("data_pregao").alias(YEAR), F.col("codigo_negociacao").alias("ticker")
    )
    lent = loans.filter(of_year(F.col("data_pregao"), year)).select(
        TAXPAYER, F.year("data_pregao").alias(YEAR), product_ticker(F.col("produto")).alias("ticker")
    )
    dated = held.union(lent).filter(f"{YEAR} is not null and ticker is not null and ticker <> ''")
    return dated.distinct()


def declaration_years(active: DataFrame, movements: DataFrame, bonus: DataFrame) -> DataFrame:
    """Taxpayers and years with a position, a loan, an income movement or a bonus."""
    income = movements.filter(F.col("movimentacao").isin(*INCOME_TYPES))
    extra = bonus.filter(F.col("movimentacao") == BONUS)
    dated = [
        rows.select(TAXPAYER, F.year("data_pregao").alias(YEAR)).distinct() for rows in (income, extra)
    ]
    return reduce(DataFrame.union, [active.select(*DECLARATION_KEY), *dated]).distinct()


def requested_year(taxpayers: DataFrame, year: int | None = None) -> DataFrame:
    """Every taxpayer with one base year, by default the last one: also those without any income."""
    base = default_base_year() if year is None else year
    return taxpayers.select(TAXPAYER).distinct().withColumn(YEAR, F.lit(base))


def declared_positions(
    positions: DataFrame, active: DataFrame, registry: dict[str, str] | None = None
) -> DataFrame:
    """Positions of active tickers, quantity cut to whole shares, missing numbers 0.

    One row per ticker: of several tax id or company variants the last in order stays.
    """
    registry = DELISTED_TAX_IDS if registry is None else registry
    ticker = F.col("instrumento")
    last = first_per_key(
        positions,
        [TAXPAYER, "instrumento"],
        [F.col("cnpj").desc(), F.col("nome_compania").desc(), F.col("qtd_lado").desc()],
    )
    declared = last.select(
        TAXPAYER,
        ticker.alias("ticker"),
        resolve_tax_id(ticker, F.col("cnpj"), registry).alias("cnpj"),
        F.coalesce("nome_compania", F.lit("")).alias("nome_compania"),
        F.coalesce("qtd_lado", F.lit(0)).cast("long").alias("quantidade"),
        F.coalesce("preco_medio_compra", F.lit(0).cast(AMOUNT)).alias("preco_medio_compra"),
        F.coalesce("posicao_fin", F.lit(0).cast(AMOUNT)).alias("posicao_fin"),
    )
    return active.join(declared, [TAXPAYER, "ticker"]).select(
        TAXPAYER,
        YEAR,
        "ticker",
        "cnpj",
        "nome_compania",
        "quantidade",
        "preco_medio_compra",
        "posicao_fin",
    )


def nested_declaration(
    positions: DataFrame,
    entries: DataFrame,
    years: DataFrame,
    registry: dict[str, str] | None = None,
) -> DataFrame:
    """One record per taxpayer and year: positions, five event lists and two totals.

    The lists hold one element per active ticker of one taxpayer in one year. Empty sections are
    empty arrays.
    """
    registry = DELISTED_TAX_IDS if registry is None else registry
    position = F.struct(
        "ticker", "cnpj", "nome_compania", "quantidade", "preco_medio_compra", "posicao_fin"
    )
    held = positions.groupBy(*DECLARATION_KEY).agg(
        F.array_sort(F.collect_list(position)).alias("positions")
    )
    event = F.struct(
        "ticker",
        resolve_tax_id(F.col("ticker"), F.col("cnpj"), registry).alias("cnpj"),
        "nome_compania",
        F.col("movimentacao").alias("event_type"),
        F.col("valor_operacao").alias("amount"),
    )
    lists = [
        F.array_sort(F.collect_list(F.when(F.col("category") == category, event))).alias(name)
        for category, name in EVENT_LISTS.items()
    ]
    totals = [
        F.sum(F.when(F.col("category") == category, F.col("valor_operacao")))
        .cast(MONEY_SUM)
        .alias(name)
        for category, name in SCALARS.items()
    ]
    income = entries.groupBy(*DECLARATION_KEY).agg(*lists, *totals)
    joined = years.join(held, DECLARATION_KEY, "left").join(income, DECLARATION_KEY, "left")
    empty = F.array()
    return joined.select(
        *DECLARATION_KEY,
        F.coalesce("positions", empty).alias("positions"),
        *[F.coalesce(name, empty).alias(name) for name in EVENT_LISTS.values()],
        *[F.coalesce(name, F.lit(0)).cast(MONEY_SUM).alias(name) for name in SCALARS.values()],
    )


def flat_declaration(nested: DataFrame) -> DataFrame:
    """The nested record as one row per list element, and one for every empty list and every total."""
    event = "array<struct<ticker:string,cnpj:string,nome_compania:string,event_type:string,amount:decimal(28,2),price:decimal(38,24),value:decimal(38,24)>>"
    held = F.transform(
        "positions",
        lambda e: F.struct(
            e["ticker"], e["cnpj"], e["nome_compania"], F.lit("").alias("event_type"),
            e["quantidade"].cast(MONEY_SUM).alias("amount"), e["preco_medio_compra"], e["posicao_fin"],
        ),
    )
    none = [F.lit(None).cast(AMOUNT) for _ in range(2)]
    lists = {"positions": held}
    for name in EVENT_LISTS.values():
        lists[name] = F.transform(
            name, lambda e: F.struct(e["ticker"], e["cnpj"], e["nome_compania"], e["event_type"], e["amount"], *none)
        )
    for name in SCALARS.values():
        blank = [F.lit(None).cast("string") for _ in range(4)]
        lists[name] = F.array(F.struct(*blank, F.col(name), *none))
    named = F.array(*[F.struct(F.lit(n).alias("list_name"), e.cast(event).alias("events")) for n, e in lists.items()])
    rows = nested.select(*DECLARATION_KEY, F.explode(named).alias("l"))
    return rows.select(*DECLARATION_KEY, "l.list_name", F.explode_outer("l.events").alias("e")).select(
        *DECLARATION_KEY, "list_name", "e.*"
    )
