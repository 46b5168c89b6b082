"""Declaration text: entries rendered as columns, sections put together per taxpayer and year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.fixed_values import (
    DELISTED_TAX_IDS,
    SCALAR_CATEGORIES,
    SECTION_CONTRIBUTOR,
    SECTION_OF_CATEGORY,
    SECTION_POSITIONS,
    EntryText,
    ReportText,
)
from ledgerspark.functions.text import format_amount, resolve_tax_id
from ledgerspark.operators.declaration import DECLARATION_KEY
from ledgerspark.operators.income import YEAR
from ledgerspark.schemas import TAXPAYER

# Order of the parts of one report: section, then its title (place 0), then entries by ticker.
LINE_ORDER = ["section", "place", "ticker"]
TITLE, ENTRY = 0, 1


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _filled(template: str, *values: Column) -> Column:
    """Template with its ``{}`` replaced by column values, in order."""
    pieces = template.split("{}")
    parts: list[str | Column] = [pieces[0]]
    for i, piece in enumerate(pieces[1:]):
        if i < len(values):
            parts.append(values[i])
        parts.append(piece)
    return _text(*parts)


def position_text(words: ReportText) -> Column:
    """Assets-and-rights entry of one position: nine lines and a blank one."""
    ticker = F.col("ticker")
    year_end = F.concat(F.lit("31/12/"), F.col(YEAR).cast("string"))
    price = format_amount(F.col("preco_medio_compra"), words.decimal_places)
    return _text(
        f"{words.ticker_label}", ticker, "\n",
        f"{words.group_label}{words.group}\n",
        f"{words.code_label}{words.code}\n",
        f"{words.location_label}{words.location}\n",
        words.tax_id_label, F.col("cnpj"), "\n",
        words.description_label,
        _filled(words.description, ticker, F.col("quantidade").cast("string"), price), "\n",
        f"{words.traded_label}{words.traded}\n",
        words.trading_code_label, ticker, "\n",
        _filled(words.year_end_label, year_end),
        format_amount(F.col("posicao_fin"), words.decimal_places), "\n\n",
    )


def entry_text(entry: EntryText, words: ReportText, per_ticker: bool) -> Column:
    """Income entry; a fixed payer replaces the event's, a description goes before the amount."""
    lines: list[str | Column] = []
    if per_ticker:
        lines += [words.ticker_label, F.col("ticker"), "\n"]
    lines += [f"{entry.income_type_label}{entry.income_type}\n"]
    payer_id = F.col("cnpj") if entry.payer_tax_id is None else F.lit(entry.payer_tax_id)
    payer = F.col("nome_compania") if entry.payer_name is None else F.lit(entry.payer_name)
    lines += [entry.payer_tax_id_label, payer_id, "\n", entry.payer_name_label, payer, "\n"]
    if entry.description is not None:
        lines += [entry.description_label, _filled(entry.description, F.upper("ticker")), "\n"]
    lines += [entry.amount_label, format_amount(F.col("valor_operacao"), words.decimal_places), "\n\n"]
    return _text(*lines)


def position_lines(positions: DataFrame, words: ReportText) -> DataFrame:
    """Rendered entries of declared positions."""
    return positions.select(
        *DECLARATION_KEY,
        F.lit(SECTION_POSITIONS).alias("section"),
        F.lit(ENTRY).alias("place"),
        "ticker",
        position_text(words).alias("text"),
    )


def entry_lines(entries: DataFrame, words: ReportText, registry: dict[str, str]) -> DataFrame:
    """Rendered entries of all income categories, chosen by category in one projection."""
    category = F.col("category")
    rows = entries.withColumn("cnpj", resolve_tax_id(F.col("ticker"), F.col("cnpj"), registry))
    text, section = F.lit(None).cast("string"), F.lit(None).cast("int")
    for name, entry in words.entries.items():
        rendered = entry_text(entry, words, per_ticker=name not in SCALAR_CATEGORIES)
        text = F.when(category == name, rendered).otherwise(text)
        section = F.when(category == name, F.lit(SECTION_OF_CATEGORY[name])).otherwise(section)
    return rows.select(
        *DECLARATION_KEY,
        section.alias("section"),
        F.lit(ENTRY).alias("place"),
        "ticker",
        text.alias("text"),
    )


def _contributor_text(words: ReportText) -> Column:
    name, cpf = (F.coalesce(c, F.lit("")) for c in ("full_name", "cpf"))
    return _text(words.full_name_label, name, "\n", words.cpf_label, cpf, "\n\n")


def contributor_header(years: DataFrame, taxpayers: DataFrame, words: ReportText) -> DataFrame:
    """Name and tax number of the taxpayer as the text of section 0."""
    return years.join(taxpayers, TAXPAYER, "left").select(
        *DECLARATION_KEY,
        F.lit(SECTION_CONTRIBUTOR).alias("section"),
        F.lit(ENTRY).alias("place"),
        F.lit("").alias("ticker"),
        _contributor_text(words).alias("text"),
    )


def frame_lines(years: DataFrame, taxpayers: DataFrame, words: ReportText) -> DataFrame:
    """What every report has: the section titles and the contributor, from one pass over the years."""

    def part(section: int, place: int, text: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(place).alias("place"), text.alias("text"))

    parts = [part(i, TITLE, F.lit(title)) for i, title in enumerate(words.titles)]
    parts.append(part(SECTION_CONTRIBUTOR, ENTRY, _contributor_text(words)))
    named = years.join(taxpayers, TAXPAYER, "left")
    return named.select(*DECLARATION_KEY, F.explode(F.array(*parts)).alias("p")).select(
        *DECLARATION_KEY, "p.section", "p.place", F.lit("").alias("ticker"), "p.text"
    )


def report_lines(
    positions: DataFrame,
    entries: DataFrame,
    years: DataFrame,
    taxpayers: DataFrame,
    words: ReportText | None = None,
    registry: dict[str, str] | None = None,
) -> DataFrame:
    """All parts of all reports as rows; ``LINE_ORDER`` is their order within a report.

    ``years`` names the reports; positions and entries must be of those years, and the entries must
    have both scalar categories in each.
    """
    words = words or ReportText()
    registry = DELISTED_TAX_IDS if registry is None else registry
    return (
        frame_lines(years, taxpayers, words)
        .unionByName(position_lines(positions, words))
        .unionByName(entry_lines(entries, words, registry))
    )


def assemble_reports(lines: DataFrame) -> DataFrame:
    """One text per taxpayer and year.

    A group holds nine titles and one part per active ticker and category of a single taxpayer in a
    single year. ``write_reports`` writes the same text without gathering it in a row.
    """
    ordered = F.array_sort(F.collect_list(F.struct(*LINE_ORDER, "text")))
    return lines.groupBy(*DECLARATION_KEY).agg(
        F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias("report")
    )


def write_reports(lines: DataFrame, path: str) -> None:
    """Reports as text files below ``taxpayer_id=…/ano_base=…``.

    Parts are sorted on disk within each file's task, so a report never has to fit in memory.
    """
    # A column that cannot be null lets the writer rely on this sort instead of adding its own.
    named = lines.withColumn(TAXPAYER, F.coalesce(TAXPAYER, F.lit("")))
    ordered = named.repartition(*DECLARATION_KEY).sortWithinPartitions(*DECLARATION_KEY, *LINE_ORDER)
    # The writer ends every part with a line feed of its own.
    text = F.regexp_replace("text", r"\n\z", "")
    (
        ordered.select(*DECLARATION_KEY, text.alias("value"))
        .write.mode("overwrite")
        .partitionBy(*DECLARATION_KEY)
        .text(path)
    )
