"""Bonus shares: base values from stored company pages, joined to bonus movements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.fixed_values import BONUS, CARD_CLASS, CARD_FIELDS, CARD_TITLE_WORD, CARD_VALUE_CLASS
from ledgerspark.functions.clean import clean_number
from ledgerspark.functions.text import strip
from ledgerspark.schemas import MONEY, PRICE

# Tags that decide what a page's cards hold: div boundaries, titles and value elements.
_TOKENS = r"(?is)<div\b[^>]*>|</div\s*>|<h3\b[^>]*>.*?</h3>|<strong\b[^>]*>[^<]*"


def _has_class(tag: Column, name: str) -> Column:
    quoted = [F.contains(tag, F.lit(f"class={q}{name}{q}")) for q in ("'", '"')]
    return quoted[0] | quoted[1]


def _card_step(state: Column, token: Column) -> Column:
    """Follow div nesting through a page; values count once their card has a matching title."""
    no_text = F.array().cast("array<string>")
    kind = F.lower(F.left(token, F.lit(3)))
    depth, card, texts = state["depth"], state["card"], state["texts"]
    opens, closes = kind == "<di", kind == "</d"
    starts = opens & (card == 0) & _has_class(token, CARD_CLASS)
    ends = closes & (card > 0) & (card == depth)
    title = F.lower(F.regexp_replace(token, "<[^>]*>", ""))
    titled = (
        (kind == "<h3")
        & (card > 0)
        & token.rlike(r"(?i)^<h3\b[^>]*\bclass\s*=")
        & F.contains(title, F.lit(CARD_TITLE_WORD))
    )
    is_value = (kind == "<st") & (card > 0) & _has_class(token, CARD_VALUE_CLASS)
    value = F.regexp_replace(F.regexp_replace(token, "^<[^>]*>", ""), "&nbsp;|\n", " ")
    return F.struct(
        (depth + F.when(opens, 1).when(closes, -1).otherwise(0)).alias("depth"),
        F.when(starts, depth + 1).when(ends, 0).otherwise(card).alias("card"),
        (F.when(starts | ends, F.lit(False)).otherwise(state["titled"]) | titled).alias("titled"),
        F.when(starts | ends, no_text)
        .when(is_value, F.concat(texts, F.array(strip(value))))
        .otherwise(texts)
        .alias("texts"),
        F.when(ends & state["titled"], F.concat(state["found"], texts))
        .otherwise(state["found"])
        .alias("found"),
    )


def page_values(html: Column) -> Column:
    """Non-blank value texts of all bonus cards of a page, in page order."""
    nothing = F.array().cast("array<string>")
    start = F.struct(
        F.lit(0).alias("depth"),
        F.lit(0).alias("card"),
        F.lit(False).alias("titled"),
        nothing.alias("texts"),
        nothing.alias("found"),
    )
    tokens = F.regexp_extract_all(html, F.lit(_TOKENS), F.lit(0))
    found = F.aggregate(
        tokens,
        start,
        _card_step,
        # A card the page never closes still counts.
        lambda s: F.when(s["titled"], F.concat(s["found"], s["texts"])).otherwise(s["found"]),
    )
    return F.filter(found, lambda t: F.length(t) > 0)


def page_cards(pages: DataFrame) -> DataFrame:
    """One row per bonus event of a ``(ticker, html)`` page: its six texts, by position."""
    n = len(CARD_FIELDS)
    values = pages.select("ticker", page_values(F.col("html")).alias("_values"))
    groups = F.sequence(F.lit(0), F.floor((F.size("_values") - 1) / F.lit(n)).cast("int"))
    events = values.filter(F.size("_values") > 0).select(
        "ticker", "_values", F.explode(groups).alias("card_no")
    )
    return events.select(
        "ticker",
        "card_no",
        *[F.get("_values", F.col("card_no") * n + i).alias(f) for i, f in enumerate(CARD_FIELDS)],
    )


def typed_cards(cards: DataFrame) -> DataFrame:
    """Bonus events with typed values; an unreadable date is null, the year is that of the ex-date."""
    amount = clean_number(strip(F.replace(F.col("valor_base"), F.lit("R$"), F.lit(""))))
    # A share is printed with a decimal comma and no thousands mark.
    share = F.replace(F.replace(F.col("proporcao"), F.lit("%"), F.lit("")), F.lit(","), F.lit("."))
    dates = [F.try_to_date(F.col(c), "d/M/yyyy").alias(c) for c in CARD_FIELDS[:4]]
    return cards.select(
        "ticker",
        "card_no",
        *dates,
        amount.cast(PRICE).alias("valor_base"),
        (strip(share).cast("double") / F.lit(100.0)).alias("proporcao"),
    ).withColumn("ano_ref", F.year("data_ex"))


def bonus_movements(movements: DataFrame) -> DataFrame:
    """Bonus movements with their year and ticker."""
    return movements.filter(F.col("movimentacao") == BONUS).select(
        "*",
        F.year("data_pregao").alias("ano_ref"),
        F.trim(F.split_part("produto", F.lit("-"), F.lit(1))).alias("ticker"),
    )


def lookup_tickers(movements: DataFrame) -> DataFrame:
    """Distinct tickers with bonus movements."""
    return bonus_movements(movements).select("ticker").distinct()


def pages_to_read(pages: DataFrame, movements: DataFrame) -> DataFrame:
    """Stored pages of the tickers that have bonus movements."""
    return pages.join(lookup_tickers(movements), "ticker", "left_semi")


def enrich_bonus(movements: DataFrame, events: DataFrame) -> DataFrame:
    """Bonus movements priced with the base value of their ticker and year.

    The base value becomes the unit price and quantity × base value the amount; both are null when
    no event is known. Several events in one year give one row each, told apart by ``card_no``, the
    event's place on its page.

    A plain join: Spark broadcasts the events by their true size, or else splits a ticker that many
    movements share at run time.
    """
    base = events.select("ticker", "ano_ref", "card_no", F.col("valor_base").cast(PRICE).alias("valor_base"))
    priced = bonus_movements(movements).join(base, ["ticker", "ano_ref"], "left")
    return priced.withColumns(
        {
            "preco_unitario": F.col("valor_base"),
            "valor_operacao": (F.col("quantidade") * F.col("valor_base")).cast(MONEY),
        }
    ).select(*movements.columns, "card_no")
