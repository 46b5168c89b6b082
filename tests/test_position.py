"""Position forms against a brute-force evaluation with one row per trade."""

from collections import defaultdict
from datetime import date
from decimal import ROUND_DOWN, Decimal, localcontext

import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_numeric import quotient

from ledgerspark.functions.text import format_amount
from ledgerspark.operators import position
from ledgerspark.plans.derived import Derived

D1, D2 = date(2022, 12, 31), date(2023, 12, 31)


def trade(ticker, quantity, price, side="Compra", day=D1, **more):
    return {"ticker": ticker, "quantidade": quantity, "preco": price, "tipo_movimentacao": side, "data_negocio": day, **more}


def split(ticker, quantity, direction="Credito", kind="Desdobro", **more):
    return {"produto": f"{ticker} - C", "quantidade": quantity, "entrada_saida": direction, "movimentacao": kind, "data_pregao": D1, **more}


def bonus(ticker, quantity, value):
    return split(ticker, quantity, kind="Bonificação em Ativos", valor_operacao=value)


@pytest.fixture(scope="module")
def small(table):
    trades = table(
        "b3_negociacao",
        trade("A3", 100, 10),
        trade("A3F", 7, 11),
        trade("A3", 30, 12, "Venda"),
        trade("A3", None, 5),
        trade("A3", 5, None),
        trade("B3", 10, 3),
        trade("B3", 10, 4, "Outro"),
        trade("C3", 10, 4, "Venda"),
        trade("E3", 0, 4),
        trade(None, 4, 4),
    )
    movements = table(
        "b3_movimentacao",
        split("A3", 50),
        split("A3", 7, "Debito"),
        split("A3", 1, None),
        split("N3", 9),
        split("C3", 2),
        split("A3", 1000, kind="Outro"),
    )
    extra = table("b3_bonificacao_acoes", bonus("A3", 10, 20), bonus("A3", 3, None), bonus("B3", 1, 5), bonus("M3", 1, 1))
    return trades, movements, extra


def exactly(compute):
    def run(*args, **options):
        with localcontext() as context:
            context.prec = 120
            return compute(*args, **options)

    return run


@exactly
def brute(trades, movements, extra, fan_out):
    """Average price and net quantity by instrument, trade by trade, with a database's quotients."""
    rows = [r.asDict() for r in trades.collect()]
    for r in rows:
        t = r["ticker"]
        r["i"] = t[:-1] if t and t.endswith("F") else t
    splits, gains = defaultdict(Decimal), defaultdict(list)
    for m in movements.collect():
        if m.movimentacao == "Desdobro":
            splits[m.produto.split(" - ")[0]] += m.quantidade if m.entrada_saida == "Credito" else -m.quantidade
    for b in extra.collect():
        gains[b.produto.split(" - ")[0]].append((b.quantidade, b.valor_operacao))
    part = lambda total, scale, n: quotient(total, scale, Decimal(n), 0) if n else Decimal(0)
    decimals = lambda x: max(0, -x.as_tuple().exponent)
    prices, nets = {}, {}
    for i in {r["i"] for r in rows}:
        mine = [r for r in rows if r["i"] == i]
        buys = [r for r in mine if r["tipo_movimentacao"] == "Compra"]
        found = gains.get(i, [])
        pairs = found * len(mine) if fan_out else found
        quantity = sum((q for q, _ in pairs), Decimal(0))
        value = sum((v for _, v in pairs if v is not None), Decimal(0))
        n = len(pairs) if fan_out else len(buys)
        of_value = part(value, 2, n) if any(v is not None for _, v in pairs) else Decimal(0)
        of_gain = part(quantity, 6, n) if pairs else Decimal(0)
        of_split = part(splits[i], 6, len(buys)) if i in splits else Decimal(0)
        cost = shares = None
        for r in buys:
            q, p = r["quantidade"], r["preco"]
            if q is not None and p is not None:
                cost = (cost or 0) + q * p + of_value
            if q is not None:
                shares = (shares or 0) + q + of_split + of_gain
        if buys:
            known = cost is not None and shares
            prices[i] = quotient(cost, max(6, decimals(of_value)), shares, max(decimals(of_split), decimals(of_gain))) if known else None
        signed = [r["quantidade"] if r["tipo_movimentacao"] == "Compra" else -r["quantidade"] for r in mine if r["quantidade"] is not None]
        nets[i] = sum(signed) + splits.get(i, 0) + quantity
    return prices, nets


def test_average_price_and_net_quantity(small):
    prices, nets = brute(*small, fan_out=False)
    assert {r.instrumento: r.preco_medio_compra for r in position.avg_buy_price(*small).collect()} == prices
    assert {r.instrumento: r.qtd_lado for r in position.net_quantity(*small).collect()} == nets


@pytest.mark.parametrize(("build", "fan_out"), [(position.view_position_v2, True), (position.view_position_v3, False)])
def test_second_and_third_form(small, table, build, fan_out):
    prices, nets = brute(*small, fan_out=fan_out)
    found = {r.instrumento: r for r in build(*small, table("b3_posicao_acoes")).collect()}
    assert {i: (r.preco_medio_compra, r.qtd_lado) for i, r in found.items()} == {i: (prices[i], nets[i]) for i in prices if nets[i] > 0}


def test_values_of_second_form_may_have_more_than_38_digits(table):
    trades = table("b3_negociacao", *[trade("A3", 2 * 10**9, 10**11) for _ in range(3)], *[trade("B3", 100, 10**6) for _ in range(2)])
    movements = table("b3_movimentacao", split("A3", 7))
    extra = table("b3_bonificacao_acoes", bonus("A3", 10**9, 20), bonus("B3", 10**11, 10))
    prices, nets = brute(trades, movements, extra, fan_out=True)
    rows = position.view_position_v2(trades, movements, extra, table("b3_posicao_acoes")).collect()
    assert {r.instrumento for r in rows} == {"A3", "B3"}
    for r in rows:
        assert (r.preco_medio_compra, r.qtd_lado) == (prices[r.instrumento], nets[r.instrumento])
        with localcontext() as context:
            context.prec = 120
            value = prices[r.instrumento] * nets[r.instrumento]
            assert Decimal(r.posicao_fin) == value.quantize(Decimal(1).scaleb(-24), ROUND_DOWN)


def test_periodic_prices_are_cut_to_the_cents_of_a_database(table):
    # 100/3 has 16 decimals; three shares are 99.9999999999999999, in text 99,99. A double gives 100,00.
    trades = table("b3_negociacao", trade("P3", 2, 25), trade("P3", 1, 50), trade("Q3", 1, 200), trade("Q3", 1, 0), trade("Q3", 1, 0))
    none = [table(n) for n in ("b3_movimentacao", "b3_bonificacao_acoes")]
    custody = table("b3_posicao_acoes", held("P3", 3), held("Q3", 3))
    rows = position.view_position(trades, *none, custody, table("b3_posicao_emprestimos"))
    shown = rows.select("instrumento", "preco_medio_compra", format_amount(F.col("posicao_fin")).alias("valor"))
    assert {r[0]: (str(r[1])[:22], r[2]) for r in shown.collect()} == {
        "P3": ("33.3333333333333333000", "99,99"),
        "Q3": ("66.6666666666666667000", "200,00"),
    }


def test_fan_out_multiplies_bonus_shares(small):
    trades, _, extra = small
    second = {r.ticker: r.quantidade for r in position.bonus_per_trade_v2(extra, trades).collect()}
    third = {r.ticker: r.quantidade for r in position.bonus_per_buy(extra, trades).collect()}
    assert second["A3"] == 13 * 5 and third["A3"] == 13
    assert all(second[t] >= third[t] for t in third)


def test_first_form(small, table):
    found = {r.instrumento: r for r in position.view_position_v1(small[0], table("b3_posicao_acoes")).collect()}
    assert float(found["A3"].qtd_lado) == 82 and float(found["A3"].preco_medio_compra) == pytest.approx(1077 / 112)
    assert "C3" not in found and "E3" not in found
    assert float(found["B3"].qtd_lado) == 10


def test_split_without_buys_has_a_null_share(small):
    trades, movements, _ = small
    shares = {r.ticker: r for r in position.splits_per_trade(movements, trades, "Compra").collect()}
    assert shares["N3"].qtd_lado is None and float(shares["N3"].qtd_lado_orig) == 9
    assert shares["C3"].qtd_lado is None
    assert shares["A3"].qtd_lado == Decimal("10.5")
    sells = {r.ticker: r for r in position.splits_per_trade(movements, trades, "Venda").collect()}
    assert sells["A3"].qtd_lado == 42


def test_every_trade_of_a_ticker_gets_the_share(small):
    trades, movements, _ = small
    rows = position.trades_split_adjusted(trades, movements)
    assert rows.count() == trades.count()
    adjusted = {(r.ticker, r.quantidade): r.quantidade_net for r in rows.collect()}
    assert adjusted["A3", 30] == Decimal("40.5") and adjusted["A3F", 7] == Decimal("17.5")
    assert adjusted["B3", 10] == 10 and adjusted["A3", None] is None


def held(ticker, quantity, day=D2, company="C", **more):
    return {"codigo_negociacao": ticker, "quantidade": quantity, "data_pregao": day, "produto": f"{ticker} - {company}", **more}


def lent(ticker, quantity, day=D2, company="C", **more):
    return {"quantidade": quantity, "data_pregao": day, "produto": f"{ticker} - {company}", **more}


def test_current_form(small, table):
    custody = table(
        "b3_posicao_acoes",
        held("A3", 5, cnpj="1"),
        held("A3", 6, cnpj="1"),
        held("A3", 7, company="OTHER", cnpj="1"),
        held("B3", 100, D1),
        held("Z3", 0),
        held("B3", 8, D1, taxpayer_id="other"),
    )
    loans = table("b3_posicao_emprestimos", lent("A3", 3), lent("L3", 4), lent("L3", 1, company="B"), lent("B3", 9, D1))
    found = position.view_position(*small, custody, loans)
    rows = {(r.taxpayer_id, r.instrumento, r.nome_compania): r for r in found.collect()}
    assert set(rows) == {("other", "B3", "C"), ("tp", "A3", "C"), ("tp", "A3", "OTHER"), ("tp", "L3", "C")}
    main = rows["tp", "A3", "C"]
    assert int(main.qtd_lado) == 14 and main.posicao_fin == exactly(lambda: 14 * main.preco_medio_compra)()
    assert rows["tp", "L3", "C"].preco_medio_compra is None


def test_as_of_bounds_positions_and_trades(table):
    trades = table("b3_negociacao", trade("A3", 1, 10, day=D1), trade("A3", 1, 30, day=D2))
    custody = table("b3_posicao_acoes", held("A3", 1, D1), held("A3", 2, D2))
    none = [table(n) for n in ("b3_movimentacao", "b3_bonificacao_acoes")]
    loans = table("b3_posicao_emprestimos")
    (now,) = position.position(trades, *none, custody, loans).collect()
    (then,) = position.position(trades, *none, custody, loans, as_of=D1).collect()
    assert (int(now.qtd_lado), now.preco_medio_compra) == (2, 20)
    assert (int(then.qtd_lado), then.preco_medio_compra) == (1, 10)


def test_position_is_custody_plus_loans(spark):
    d = Derived(spark, SF)
    parts = [position.year_end_custody(d.custody()), position.year_end_loans(d.loans())]
    expected = sum(r.quantidade for p in parts for r in p.collect())
    total = position.year_end_position(d.custody(), d.loans())
    assert sum(r.qtd_lado for r in total.collect()) == expected
