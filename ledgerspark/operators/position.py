"""Average buy price and positions, in the four successive forms of the position view.

Trades, movements and custody rows are added up per taxpayer and ticker before anything is joined,
so joins see one row per ticker and no fan-out occurs. Spreading a split or bonus over the buys of a
ticker and adding the buys up again gives the same totals as adding it once; that is what the price
formulas use. A part is a quotient of its own, rounded to the digits a database gives it, and counts as often as rows
get it, so totals agree with a row-by-row sum to the last digit. Row-spread forms exist as operators of their own
where the result is one row per trade.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.fixed_values import BONUS, BUY, CREDIT, SELL, SPLIT
from ledgerspark.functions.numeric import AMOUNT, PART, column, decimal, number, over, plus, product_text, times
from ledgerspark.functions.text import product_company, product_ticker, without_fraction_mark
from ledgerspark.operators.income import latest_position
from ledgerspark.schemas import COUNT_SUM, MONEY_SUM, QUANTITY_SUM, TAXPAYER

TICKER_KEY = [TAXPAYER, "ticker"]


def _until(date_column: str, as_of: date | None) -> Column:
    return F.lit(True) if as_of is None else F.col(date_column) <= F.lit(as_of)


#: Decimals of added-up quantities and of added-up money.
_OF_QUANTITY, _OF_MONEY = QUANTITY_SUM.scale, MONEY_SUM.scale


def _part(total: str, scale: int, rows: str) -> str:
    """What each of ``rows`` gets of a total, as number; null for no rows or no total."""
    return over(number(total, scale), number(rows))


def _parts(total: str, scale: int, all_rows: str, rows: str) -> str:
    """What ``rows`` of ``all_rows`` get of a total together, 0 without a total. Trades without quantity or price take
    a part but add nothing, so theirs is lost."""
    return f"coalesce({times(_part(total, scale, all_rows), number(rows))}, {number('0')})"


def trades_by_instrument(trades: DataFrame, as_of: date | None = None) -> DataFrame:
    """Trades with the ticker of the whole-lot market as ``instrumento``."""
    return trades.filter(_until("data_negocio", as_of)).withColumn(
        "instrumento", without_fraction_mark(F.col("ticker"))
    )


def net_splits(movements: DataFrame, as_of: date | None = None) -> DataFrame:
    """Shares added by splits per ticker; whatever is not a credit counts as taken away."""
    signed = F.when(F.col("entrada_saida") == CREDIT, F.col("quantidade")).otherwise(-F.col("quantidade"))
    return (
        movements.filter((F.col("movimentacao") == SPLIT) & _until("data_pregao", as_of))
        .select(TAXPAYER, product_ticker(F.col("produto")).alias("ticker"), signed.alias("_q"))
        .groupBy(*TICKER_KEY)
        .agg(F.sum("_q").cast(QUANTITY_SUM).alias("qtd_lado"))
    )


def trade_counts(trades: DataFrame, side: str | None = None, as_of: date | None = None) -> DataFrame:
    """Number of trades per ticker, of one side or of both."""
    rows = trades_by_instrument(trades, as_of)
    if side is not None:
        rows = rows.filter(F.col("tipo_movimentacao") == side)
    return (
        rows.withColumn("ticker", F.col("instrumento"))
        .groupBy(*TICKER_KEY)
        .agg(F.count(F.lit(1)).alias("n_trades"))
    )


def buy_counts(trades: DataFrame) -> DataFrame:
    """Number of buys per ticker."""
    return trade_counts(trades, BUY).withColumnRenamed("n_trades", "n_compras")


def splits_per_trade(movements: DataFrame, trades: DataFrame, side: str) -> DataFrame:
    """Split shares per trade of a side; tickers without such trades stay, with a null share."""
    splits = net_splits(movements)
    counts = trade_counts(trades, side)
    return splits.join(counts, TICKER_KEY, "left").select(
        *TICKER_KEY,
        decimal(_part("qtd_lado", _OF_QUANTITY, "n_trades"), PART).alias("qtd_lado"),
        F.col("qtd_lado").alias("qtd_lado_orig"),
    )


def trades_split_adjusted(trades: DataFrame, movements: DataFrame) -> DataFrame:
    """Every trade, buy or sell, with its quantity plus the ticker's split share per buy."""
    shares = splits_per_trade(movements, trades, BUY).select(
        TAXPAYER, F.col("ticker").alias("instrumento"), F.col("qtd_lado").alias("_share")
    )
    # Spark broadcasts the shares by their true size, or else splits a ticker with many trades at run time.
    rows = trades_by_instrument(trades).join(shares, [TAXPAYER, "instrumento"], "left")
    adjusted = F.col("quantidade").cast("decimal(10,0)") + F.coalesce("_share", F.lit(0).cast(PART))
    return rows.select(*trades.columns, "instrumento", adjusted.alias("quantidade_net"))


def bonus_totals(bonus: DataFrame, as_of: date | None = None) -> DataFrame:
    """Bonus shares, their value and their rows per ticker."""
    return (
        bonus.filter((F.col("movimentacao") == BONUS) & _until("data_pregao", as_of))
        .withColumn("ticker", product_ticker(F.col("produto")))
        .groupBy(*TICKER_KEY)
        .agg(
            F.sum("quantidade").cast(QUANTITY_SUM).alias("quantidade"),
            F.sum("valor_operacao").cast(MONEY_SUM).alias("valor_operacao"),
            F.count(F.lit(1)).alias("n_bonus"),
        )
    )


def bonus_per_buy(bonus: DataFrame, trades: DataFrame) -> DataFrame:
    """Bonus totals per ticker with value and shares per buy."""
    totals = bonus_totals(bonus).drop("n_bonus")
    return totals.join(buy_counts(trades), TICKER_KEY, "left").select(
        *TICKER_KEY,
        "quantidade",
        "valor_operacao",
        decimal(_part("valor_operacao", _OF_MONEY, "n_compras"), PART).alias("valor_bon_por_neg"),
        decimal(_part("quantidade", _OF_QUANTITY, "n_compras"), PART).alias("qtd_bon_por_neg"),
    )


def bonus_per_trade_v2(bonus: DataFrame, trades: DataFrame) -> DataFrame:
    """Second form, with its defect: totals multiplied by the ticker's trades, sells in the divisor.

    Joining every bonus row with every trade multiplies sums by the number of trades and counts their
    product; both follow from the two counts, so no row is multiplied here.
    """
    n = F.coalesce("n_trades", F.lit(0))
    times = F.greatest(n, F.lit(1))
    joined = bonus_totals(bonus).join(trade_counts(trades), TICKER_KEY, "left")
    multiplied = joined.select(
        *TICKER_KEY,
        (F.col("quantidade") * times).cast(QUANTITY_SUM).alias("quantidade"),
        (F.col("valor_operacao") * times).cast(MONEY_SUM).alias("valor_operacao"),
        (n * F.col("n_bonus")).alias("_pairs"),
    )
    return multiplied.select(
        *TICKER_KEY,
        "quantidade",
        "valor_operacao",
        decimal(_part("valor_operacao", _OF_MONEY, "_pairs"), PART).alias("valor_bon_por_neg"),
        decimal(_part("quantidade", _OF_QUANTITY, "_pairs"), PART).alias("qtd_bon_por_neg"),
    )


_TICKER = [TAXPAYER, "instrumento"]
#: Columns of the totals of a ticker, with their types. All are sums, so totals of parts can be added up; a sum
#: without a value is null.
TICKER_TOTALS = {
    "cost": QUANTITY_SUM,
    "n_priced": T.LongType(),
    "bought": QUANTITY_SUM,
    "n_sized": T.LongType(),
    "n_buys": T.LongType(),
    "n_trades": T.LongType(),
    "net": QUANTITY_SUM,
    "split": QUANTITY_SUM,
    "bonus_quantity": QUANTITY_SUM,
    "bonus_value": MONEY_SUM,
    "n_bonus": T.LongType(),
}


def _contributions(trades: DataFrame, movements: DataFrame, bonus: DataFrame, as_of: date | None) -> DataFrame:
    """What every trade, split and bonus adds to its ticker's totals, one row each."""
    quantity, one = F.col("quantidade"), F.lit(1).cast("bigint")
    bought = F.col("tipo_movimentacao") == BUY
    cost = F.when(bought, quantity * F.col("preco"))
    of_trades = trades_by_instrument(trades, as_of).select(
        *_TICKER,
        cost.alias("cost"),
        F.when(cost.isNotNull(), one).otherwise(0).alias("n_priced"),
        F.when(bought, quantity).cast(QUANTITY_SUM).alias("bought"),
        F.when(bought & quantity.isNotNull(), one).otherwise(0).alias("n_sized"),
        F.when(bought, one).otherwise(0).alias("n_buys"),
        one.alias("n_trades"),
        F.when(bought, quantity).otherwise(-quantity).cast(QUANTITY_SUM).alias("net"),
    )
    ticker = product_ticker(F.col("produto")).alias("instrumento")
    signed = F.when(F.col("entrada_saida") == CREDIT, quantity).otherwise(-quantity)
    of_splits = movements.filter((F.col("movimentacao") == SPLIT) & _until("data_pregao", as_of))
    of_bonus = bonus.filter((F.col("movimentacao") == BONUS) & _until("data_pregao", as_of))
    extras = [
        of_splits.select(TAXPAYER, ticker, signed.alias("split")),
        of_bonus.select(TAXPAYER, ticker, quantity.alias("bonus_quantity"), F.col("valor_operacao").alias("bonus_value"), one.alias("n_bonus")),
    ]
    for rows in extras:
        # A null key meets no trade.
        of_trades = of_trades.unionByName(rows.na.drop(subset=_TICKER), allowMissingColumns=True)
    return of_trades


def added_up(parts: DataFrame) -> DataFrame:
    """Totals per ticker from rows or totals of parts."""
    sums = [F.sum(name).cast(kind).alias(name) for name, kind in TICKER_TOTALS.items()]
    return parts.groupBy(*_TICKER).agg(*sums)


def ticker_totals(trades: DataFrame, movements: DataFrame, bonus: DataFrame, as_of: date | None = None) -> DataFrame:
    """All that prices and quantities of a ticker need, in one pass and one exchange of partial sums, without a join."""
    return added_up(_contributions(trades, movements, bonus, as_of))


#: Shares of the buys; quantities of trades are whole.
_BOUGHT = f"cast(bought AS {COUNT_SUM.simpleString()})"


def _average_price() -> Column:
    """Cost over shares, as number."""
    value = plus(number("cost", _OF_QUANTITY), _parts("bonus_value", _OF_MONEY, "n_buys", "n_priced"))
    extra = [_parts(name, _OF_QUANTITY, "n_buys", "n_sized") for name in ("split", "bonus_quantity")]
    return column(over(value, plus(number(_BOUGHT), *extra)))


def _prices(trades: DataFrame, movements: DataFrame, bonus: DataFrame, as_of: date | None) -> DataFrame:
    """Average buy price of every ticker that was ever bought, as number."""
    return _prices_of(ticker_totals(trades, movements, bonus, as_of))


def _prices_of(totals: DataFrame) -> DataFrame:
    return totals.filter("n_buys > 0").select(*_TICKER, _average_price().alias("_price"))


def avg_buy_price(
    trades: DataFrame, movements: DataFrame, bonus: DataFrame, as_of: date | None = None
) -> DataFrame:
    """Split- and bonus-adjusted average buy price of every ticker that was ever bought."""
    prices = _prices(trades, movements, bonus, as_of)
    return prices.select(TAXPAYER, "instrumento", decimal("_price").alias("preco_medio_compra"))


def _net_shares(bonus_quantity: Column) -> Column:
    zero = F.lit(0).cast(QUANTITY_SUM)
    total = F.col("net") + F.coalesce("split", zero) + F.coalesce(bonus_quantity, zero)
    return total.cast(QUANTITY_SUM)


def net_quantity(trades: DataFrame, movements: DataFrame, bonus: DataFrame) -> DataFrame:
    """Shares bought minus sold, plus splits and bonuses, per ticker."""
    totals = ticker_totals(trades, movements, bonus).filter("n_trades > 0")
    return totals.select(*_TICKER, _net_shares(F.col("bonus_quantity")).alias("qtd_lado"))


def year_end_dates(custody: DataFrame, loans: DataFrame, as_of: date | None = None) -> DataFrame:
    """Newest custody date and newest loan date of each taxpayer."""
    custody_dates = _newest_date(custody, as_of).withColumnRenamed("dt", "dt_custody")
    loan_dates = _newest_date(loans, as_of).withColumnRenamed("dt", "dt_loans")
    return custody_dates.join(loan_dates, TAXPAYER, "full_outer")


def _newest_date(rows: DataFrame, as_of: date | None) -> DataFrame:
    return rows.filter(_until("data_pregao", as_of)).groupBy(TAXPAYER).agg(F.max("data_pregao").alias("dt"))


def _at_newest_date(rows: DataFrame, as_of: date | None) -> DataFrame:
    """Rows of each taxpayer's newest date.

    There is one date per taxpayer, so the history goes before anything is added up: while the dates are
    few they are broadcast and the rows are not shuffled.
    """
    bounded = rows.filter(_until("data_pregao", as_of))
    newest = _newest_date(rows, as_of).withColumnRenamed("dt", "data_pregao")
    return bounded.join(newest, [TAXPAYER, "data_pregao"], "left_semi")


def year_end_custody(custody: DataFrame, as_of: date | None = None) -> DataFrame:
    """Shares in custody per ticker, tax id and company at the taxpayer's newest date."""
    return (
        _at_newest_date(custody, as_of)
        .select(
            TAXPAYER,
            F.col("codigo_negociacao").alias("ticker"),
            "cnpj",
            product_company(F.col("produto")).alias("nome_compania"),
            "quantidade",
        )
        .groupBy(TAXPAYER, "ticker", "cnpj", "nome_compania")
        .agg(F.sum("quantidade").cast(COUNT_SUM).alias("quantidade"))
    )


def year_end_loans(loans: DataFrame, as_of: date | None = None) -> DataFrame:
    """Shares lent per ticker at the taxpayer's newest loan date."""
    # Companies are grouped first: a maximum of texts over single rows would sort them all.
    by_company = (
        _at_newest_date(loans, as_of)
        .select(
            TAXPAYER,
            product_ticker(F.col("produto")).alias("ticker"),
            product_company(F.col("produto")).alias("_company"),
            "quantidade",
        )
        .groupBy(TAXPAYER, "ticker", "_company")
        .agg(F.sum("quantidade").alias("_quantity"))
    )
    return by_company.groupBy(TAXPAYER, "ticker").agg(
        F.max("_company").alias("nome_compania"),
        F.sum("_quantity").cast(COUNT_SUM).alias("quantidade"),
    )


def year_end_position(custody: DataFrame, loans: DataFrame, as_of: date | None = None) -> DataFrame:
    """Custody plus loans per ticker; each tax id or company variant of a ticker gets the whole loan."""
    held = year_end_custody(custody, as_of)
    lent = year_end_loans(loans, as_of).select(
        *TICKER_KEY, F.col("quantidade").alias("_lent"), F.col("nome_compania").alias("_company")
    )
    zero = F.lit(0).cast(COUNT_SUM)
    total = F.coalesce("quantidade", zero) + F.coalesce("_lent", zero)
    return held.join(lent, TICKER_KEY, "full_outer").select(
        *TICKER_KEY,
        total.cast(COUNT_SUM).alias("qtd_lado"),
        "cnpj",
        F.coalesce("nome_compania", "_company").alias("nome_compania"),
    )


def _valued(rows: DataFrame, as_text: bool = False) -> DataFrame:
    """Open positions with their value, in the columns of the position view, from the number ``_price``.

    With ``as_text`` the value stays text: it may have more digits than a decimal.
    """
    held = number("qtd_lado", rows.schema["qtd_lado"].dataType.scale)
    value = product_text(held, "_price")
    return rows.filter("qtd_lado > 0").select(
        TAXPAYER,
        "instrumento",
        decimal("_price").alias("preco_medio_compra"),
        "qtd_lado",
        (value if as_text else value.cast(AMOUNT)).alias("posicao_fin"),
        F.coalesce("cnpj", F.lit("")).alias("cnpj"),
        F.coalesce("nome_compania", "instrumento").alias("nome_compania"),
    )


def position(
    trades: DataFrame,
    movements: DataFrame,
    bonus: DataFrame,
    custody: DataFrame,
    loans: DataFrame,
    as_of: date | None = None,
) -> DataFrame:
    """Current form: year-end custody and loans valued at the average buy price.

    Without ``as_of`` the newest date and all trades count, whatever year is declared.
    """
    return position_of_totals(ticker_totals(trades, movements, bonus, as_of), custody, loans, as_of)


def position_of_totals(totals: DataFrame, custody: DataFrame, loans: DataFrame, as_of: date | None = None) -> DataFrame:
    """The current form from totals per ticker, which may be stored and kept up to date."""
    shares = year_end_position(custody, loans, as_of).withColumnRenamed("ticker", "instrumento")
    return _valued(shares.join(_prices_of(totals), _TICKER, "left"))


def view_position(*tables: DataFrame) -> DataFrame:
    """Position in the view's row order within each taxpayer."""
    return position(*tables).orderBy(TAXPAYER, "instrumento")


def _with_company(rows: DataFrame, custody: DataFrame) -> DataFrame:
    newest = latest_position(custody).withColumnRenamed("ticker", "instrumento")
    return rows.join(newest, [TAXPAYER, "instrumento"], "left")


def view_position_v1(trades: DataFrame, custody: DataFrame) -> DataFrame:
    """First form: trades alone, without splits and bonuses; price 0 where nothing was bought."""
    quantity = F.col("quantidade")
    side = F.col("tipo_movimentacao")
    bought = F.sum(F.when(side == BUY, quantity).otherwise(0)).cast(QUANTITY_SUM)
    sold = F.sum(F.when(side == SELL, quantity).otherwise(0)).cast(QUANTITY_SUM)
    cost = F.sum(F.when(side == BUY, quantity * F.col("preco")).otherwise(0)).cast(QUANTITY_SUM)
    totals = (
        trades_by_instrument(trades)
        .groupBy(TAXPAYER, "instrumento")
        .agg(bought.alias("_bought"), cost.alias("_cost"), (bought - sold).cast(QUANTITY_SUM).alias("qtd_lado"))
    )
    price = over(number("_cost", _OF_QUANTITY), number(f"cast(_bought AS {COUNT_SUM.simpleString()})"))
    priced = totals.withColumn("_price", column(f"if(_bought > 0, {price}, {number('0')})"))
    return _valued(_with_company(priced, custody))


def view_position_v2(
    trades: DataFrame, movements: DataFrame, bonus: DataFrame, custody: DataFrame
) -> DataFrame:
    """Second form, with its defect: bonus shares multiplied by the ticker's trades.

    Multiplied shares grow with the square of the rows, so ``posicao_fin`` is text with 24 decimals.
    """
    # Bonus totals as the join multiplies them.
    many = {
        "many_value": (F.col("bonus_value") * F.col("n_trades")).cast(MONEY_SUM),
        "many_shares": (F.col("bonus_quantity") * F.col("n_trades")).cast(QUANTITY_SUM),
        "pairs": F.col("n_bonus") * F.col("n_trades"),
    }
    rows = ticker_totals(trades, movements, bonus).withColumns(many)
    cost = plus(number("cost", _OF_QUANTITY), _parts("many_value", _OF_MONEY, "pairs", "n_priced"))
    shares = plus(
        number(_BOUGHT),
        _parts("split", _OF_QUANTITY, "n_buys", "n_sized"),
        _parts("many_shares", _OF_QUANTITY, "pairs", "n_sized"),
    )
    priced = rows.filter("n_buys > 0").select(
        TAXPAYER,
        "instrumento",
        column(over(cost, shares)).alias("_price"),
        _net_shares(F.col("many_shares")).alias("qtd_lado"),
    )
    return _valued(_with_company(priced, custody), as_text=True).orderBy(TAXPAYER, "instrumento")


def view_position_v3(
    trades: DataFrame, movements: DataFrame, bonus: DataFrame, custody: DataFrame
) -> DataFrame:
    """Third form: bonuses added up before the join, quantity still from trades."""
    priced = (
        ticker_totals(trades, movements, bonus)
        .filter("n_buys > 0")
        .select(
            TAXPAYER,
            "instrumento",
            _average_price().alias("_price"),
            _net_shares(F.col("bonus_quantity")).alias("qtd_lado"),
        )
    )
    return _valued(_with_company(priced, custody)).orderBy(TAXPAYER, "instrumento")
