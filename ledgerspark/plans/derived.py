"""Exchange tables derived from the star-schema test tables, as DataFrames.

The oracle has the same tables as SQL text (``plans/oracle.py``). A key modulo 200 picks one of 200
tickers and a key modulo 5 one of five taxpayers; nothing is left out of the source tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.fixed_values import (
    BONUS,
    BUY,
    CREDIT,
    DIVIDEND,
    DIVIDEND_TRANSFERRED,
    FRACTION_AUCTION,
    JCP,
    JCP_TRANSFERRED,
    LENDING,
    MONETARY_UPDATE,
    REIMBURSEMENT,
    SELL,
    SPLIT,
)
from ledgerspark.schemas import COUNT, MONEY, PRICE, TAXPAYER

MOVEMENT_TYPES = (
    MONETARY_UPDATE,
    LENDING,
    FRACTION_AUCTION,
    DIVIDEND,
    DIVIDEND_TRANSFERRED,
    JCP,
    JCP_TRANSFERRED,
    REIMBURSEMENT,
    SPLIT,
    BONUS,
    "Transferência - Liquidação",
    "Atualização",
)
# Tickers of the derived custody table that have no tax id, for the fallback registry.
REGISTRY = {"TK0003": "12.345.678/0001-95", "TK0103": "98.765.432/0001-10"}


def once(build: Callable[[Derived], DataFrame]) -> Callable[[Derived], DataFrame]:
    """Build a frame once per set of tables: a plan that uses it twice shares the description."""

    @wraps(build)
    def cached(tables: Derived) -> DataFrame:
        if build not in tables.built:
            tables.built[build] = build(tables)
        return tables.built[build]

    return cached


class Derived:
    """The exchange tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._sources: dict[str, DataFrame] = {}
        self.built: dict[Callable, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        """A source table; its footer is read once."""
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._sources[name]

    @once
    def trades(self) -> DataFrame:
        return trades_of(self.source("lineitem"))

    @once
    def movements(self) -> DataFrame:
        return movements_of(self.source("orders"))

    def movements_with(self, *extra: Column) -> DataFrame:
        """Movements with further columns of the orders they come from."""
        return movements_of(self.source("orders"), *extra)

    @once
    def custody(self) -> DataFrame:
        key = F.col("p_partkey")
        tax_id = _text((key % 200) * 1000003 + 191, ".0")
        return self.source("part").select(
            _taxpayer(F.col("p_size")),
            _text("pa-", _padded(key, 9)).alias("id"),
            _product(key).alias("produto"),
            F.col("p_brand").alias("instituicao"),
            (F.col("p_size") % 3).cast(COUNT).alias("conta"),
            _ticker(key).alias("codigo_negociacao"),
            F.when(key % 10 != 0, tax_id).alias("cnpj"),
            (F.col("p_size") * 100).cast(COUNT).alias("quantidade"),
            _year_end(1995 + F.col("p_size") % 7).alias("data_pregao"),
        )

    @once
    def loans(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.source("customer").select(
            _taxpayer(F.col("c_nationkey")),
            _text("pe-", _padded(key, 9)).alias("id"),
            _product(key).alias("produto"),
            _text("CT", key % 400).alias("num_contrato"),
            (key % 50 + 1).cast(COUNT).alias("quantidade"),
            _year_end(1995 + F.col("c_nationkey") % 7).alias("data_pregao"),
        )

    @once
    def received(self) -> DataFrame:
        return self.received_with()

    def received_with(self, *extra: Column) -> DataFrame:
        """Received income with further columns of the orders it comes from."""
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        kind = F.when(status == "F", DIVIDEND).when(status == "O", JCP).otherwise(MONETARY_UPDATE)
        return self.source("orders").select(
            _taxpayer(key),
            _text("pr-", _padded(key, 9)).alias("id"),
            _product(F.col("o_custkey")).alias("produto"),
            kind.alias("tipo_evento"),
            F.col("o_totalprice").cast(MONEY).alias("valor_liquido"),
            _year_end(F.year("o_orderdate")).alias("data_pregao"),
            *extra,
        )

    @once
    def reimbursed(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.source("customer").select(
            _taxpayer(F.col("c_nationkey")),
            _text("re-", _padded(key, 9)).alias("id"),
            _product(key).alias("produto"),
            F.lit(REIMBURSEMENT).alias("tipo_evento"),
            F.col("c_acctbal").cast(MONEY).alias("valor_liquido"),
            _year_end(1995 + F.col("c_nationkey") % 7).alias("data_pregao"),
        )

    @once
    def bonus_events(self) -> DataFrame:
        price = F.col("p_retailprice").cast(MONEY)
        return (
            self.source("part")
            .groupBy(
                _ticker(F.col("p_partkey")).alias("ticker"),
                (1995 + F.col("p_size") % 7).alias("ano_ref"),
            )
            .agg(F.max(price).cast(PRICE).alias("valor_base"))
            # Every ticker has a second event in 1997, of twice the value.
            .select(
                "ticker",
                "ano_ref",
                "valor_base",
                F.explode(F.sequence(F.lit(0), (F.col("ano_ref") == 1997).cast("int"))).alias("card_no"),
            )
            .withColumn("valor_base", (F.col("valor_base") * (F.col("card_no") + 1)).cast(PRICE))
        )

    @once
    def bonus(self) -> DataFrame:
        from ledgerspark.operators.bonus import enrich_bonus

        return enrich_bonus(self.movements(), self.bonus_events()).drop("card_no")

    def raw_movements(self, *extra: Column) -> DataFrame:
        """Movements as sheet cells ``c0``…``c7``; those with quantity 50 miss cells enough to go."""
        q = F.col("quantidade")
        day = F.date_format("data_pregao", "dd/MM/yyyy")
        rows = self.movements_with(*extra)
        return rows.select(
            TAXPAYER,
            F.when(q == 50, "-").otherwise(F.col("entrada_saida")).alias("c0"),
            F.when(q == 2, "-").otherwise(day).alias("c1"),
            _text(" ", F.col("movimentacao"), "  ").alias("c2"),
            F.when(q == 50, " ").otherwise(F.col("produto")).alias("c3"),
            F.when(q == 50, "").otherwise(F.col("instituicao")).alias("c4"),
            F.when(q == 3, "-").otherwise(q.cast("int").cast("string")).alias("c5"),
            F.when(q == 50, "-").otherwise(_comma(F.col("preco_unitario").cast(MONEY))).alias("c6"),
            _comma(F.col("valor_operacao")).alias("c7"),
            *rows.columns[9:],
        )

    def report_files(self) -> DataFrame:
        """Names and times of report files, one per order, as a binary file scan lists them.

        Some annual reports have more than the year in their name and are not to be read.
        """
        key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
        report = F.when(key % 3 == 0, "movimentacao").when(key % 3 == 1, "negociacao")
        more = F.when((key % 3 == 2) & (key % 7 != 0), "").otherwise(_text("-", _padded(key, 9)))
        return self.source("orders").select(
            _text(
                "file:/reports/", _padded(key, 9), "/", _taxpayer(key), "-",
                report.otherwise("relatorio-consolidado-anual"), "-", F.year("o_orderdate"), more, ".xlsx",
            ).alias("path"),
            (day + F.make_interval(secs=key % 1000)).alias("modificationTime"),
        )

    @once
    def bonus_pages(self) -> DataFrame:
        """Company pages with one bonus card per event, one blank value in each card; a page per year."""
        year = F.col("ano_ref").cast("string")
        value = '<strong class="d-block lh-3 fs-3 fw-700">'
        last_date = F.when(F.col("ano_ref") == 1996, F.lit("-")).otherwise(_text("04/02/", year))
        card = _text(
            '<div class="card p-2 p-xs-3"><h3 class="t">Bonificação</h3>',
            value, "01/02/", year, "</strong>",
            value, " </strong>",
            value, "02/02/", year, "</strong>",
            value, "03/02/", year, "</strong>",
            value, last_date, "</strong>",
            value, "R$ ", _comma(F.col("valor_base").cast(MONEY)), "</strong>",
            value, "10,00%</strong></div>",
        )
        cards = F.array_sort(F.collect_list(F.struct("card_no", card.alias("card"))))
        html = F.array_join(F.transform(cards, lambda c: c["card"]), "")
        return self.bonus_events().groupBy("ticker", "ano_ref").agg(html.alias("html")).select("ticker", "html")

    @once
    def taxpayers(self) -> DataFrame:
        """Taxpayers of all tables with made-up names and tax numbers."""
        found = [t.select(TAXPAYER) for t in (self.movements(), self.custody(), self.loans())]
        tp = F.col(TAXPAYER)
        return (
            reduce(DataFrame.union, found)
            .distinct()
            .select(
                TAXPAYER,
                _text("CONTRIBUTOR ", F.upper(tp)).alias("full_name"),
                _text("000.000.000-", F.lpad(F.substring(tp, 3, 9), 2, "0")).alias("cpf"),
            )
        )


def trades_of(lineitem: DataFrame) -> DataFrame:
    """Trades from order lines."""
    part = F.col("l_partkey")
    mark = F.when(F.col("l_linenumber") % 3 == 0, "F").otherwise("")
    price = F.col("l_extendedprice").cast(MONEY)
    return lineitem.select(
        _taxpayer(F.col("l_suppkey")),
        F.col("l_shipdate").cast("date").alias("data_negocio"),
        F.when(F.col("l_returnflag") == "R", SELL).otherwise(BUY).alias("tipo_movimentacao"),
        F.concat(_ticker(part), mark).alias("ticker"),
        _text("BROKER ", F.col("l_suppkey") % 7).alias("instituicao"),
        F.col("l_quantity").cast("int").alias("quantidade"),
        price.cast(PRICE).alias("preco"),
        (F.col("l_quantity").cast(MONEY) * price).cast(MONEY).alias("valor"),
    )


def movements_of(orders: DataFrame, *extra: Column) -> DataFrame:
    """Movements from orders, twelve types in turn."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    kind = F.element_at(F.array(*[F.lit(t) for t in MOVEMENT_TYPES]), (key % 12 + 1).cast("int"))
    value = F.col("o_totalprice").cast(MONEY)
    return orders.select(
        _taxpayer(key),
        F.when(key % 7 == 0, "Debito").otherwise(CREDIT).alias("entrada_saida"),
        F.col("o_orderdate").cast("date").alias("data_pregao"),
        kind.alias("movimentacao"),
        _product(customer).alias("produto"),
        _text("BROKER ", customer % 7).alias("instituicao"),
        (key % 100 + 1).cast(PRICE).alias("quantidade"),
        value.cast(PRICE).alias("preco_unitario"),
        value.alias("valor_operacao"),
        *extra,
    )


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _taxpayer(key: Column) -> Column:
    return _text("tp", key % 5).alias(TAXPAYER)


def _ticker(key: Column) -> Column:
    return _text("TK", _padded(key % 200, 3), "3")


def _product(key: Column) -> Column:
    return _text(_ticker(key), " - COMPANY ", _padded(key % 200, 3), " S.A.")


def _year_end(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))


def _comma(number: Column) -> Column:
    return F.replace(number.cast("string"), F.lit("."), F.lit(","))
