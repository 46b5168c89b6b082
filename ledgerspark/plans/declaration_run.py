"""Declaration of a base year for all taxpayers, from stored tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.fixed_values import DELISTED_TAX_IDS, ReportText
from ledgerspark.operators.declaration import (
    DECLARATION_KEY,
    active_tickers,
    declared_positions,
    default_base_year,
    nested_declaration,
    requested_year,
)
from ledgerspark.operators.income import declared_entries, income_and_bonus
from ledgerspark.operators.position import position_of_totals, ticker_totals
from ledgerspark.operators.report import report_lines, write_reports
from ledgerspark.plans.import_run import table_path
from ledgerspark.plans.totals import stored_totals
from ledgerspark.schemas import table_spec
from ledgerspark.sources.tables import read_table


class Declaration:
    """One base year of all taxpayers (or one), as lazy frames over the stored tables.

    ``taxpayers`` has ``taxpayer_id``, ``full_name`` and ``cpf``; everyone in it gets a report.
    ``bounded`` limits positions and prices to the end of the base year; by default the newest
    custody date and all trades count, whatever year is declared. ``totals`` takes prices from the stored totals per
    ticker, as the last refresh left them, instead of going through all trades; they know no bound.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables_dir: str,
        taxpayers: DataFrame,
        year: int | None = None,
        taxpayer: str | None = None,
        registry: dict[str, str] | None = None,
        bounded: bool = False,
        totals: bool = False,
    ):
        if bounded and totals:
            raise ValueError("stored totals have trades of all dates")

        def table(name: str) -> DataFrame:
            return read_table(spark, table_path(tables_dir, name), table_spec(name), taxpayer)

        self.year = default_base_year() if year is None else year
        self.registry = DELISTED_TAX_IDS if registry is None else registry
        self.taxpayers = taxpayers if taxpayer is None else taxpayers.filter(taxpayers.taxpayer_id == taxpayer)
        self.trades = table("b3_negociacao")
        self.movements = table("b3_movimentacao")
        self.bonus = table("b3_bonificacao_acoes")
        self.custody = table("b3_posicao_acoes")
        self.loans = table("b3_posicao_emprestimos")
        self.as_of = date(self.year, 12, 31) if bounded else None
        self.totals = stored_totals(spark, tables_dir, taxpayer) if totals else None
        self.years = requested_year(self.taxpayers, self.year)

    def positions(self) -> DataFrame:
        totals = self.totals
        if totals is None:
            totals = ticker_totals(self.trades, self.movements, self.bonus, self.as_of)
        held = position_of_totals(totals, self.custody, self.loans, self.as_of)
        return self._requested(declared_positions(held, self.active(), self.registry))

    def _requested(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.years, DECLARATION_KEY, "left_semi")

    def active(self) -> DataFrame:
        return active_tickers(self.custody, self.loans, self.year)

    def entries(self) -> DataFrame:
        rows = income_and_bonus(self.movements, self.bonus, self.custody, self.year)
        return self._requested(declared_entries(rows, self.active(), self.years))

    def lines(self, words: ReportText | None = None) -> DataFrame:
        return report_lines(
            self.positions(), self.entries(), self.years, self.taxpayers, words, self.registry
        )

    def record(self) -> DataFrame:
        return nested_declaration(self.positions(), self.entries(), self.years, self.registry)


def run_declaration(declaration: Declaration, path: str, words: ReportText | None = None) -> None:
    """Write one text per taxpayer of the base year."""
    write_reports(declaration.lines(words), path)
