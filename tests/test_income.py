from datetime import date
from decimal import Decimal

from conftest import SF, rows_of
from pyspark.sql import functions as F

from ledgerspark.fixed_values import INCOME_TYPES
from ledgerspark.operators import bonus, declaration, income
from ledgerspark.plans.derived import Derived

DAY = date(2024, 5, 1)


def movement(kind, value, product="A3 - ACME", day=DAY, **more):
    return {"movimentacao": kind, "valor_operacao": value, "produto": product, "data_pregao": day, **more}


def custody(ticker, cnpj, day, id="1", **more):
    return {"codigo_negociacao": ticker, "cnpj": cnpj, "data_pregao": day, "id": id, "produto": f"{ticker} - ACME", **more}


def test_newest_position_and_missing_date_first(table):
    rows = table(
        "b3_posicao_acoes",
        custody("A3", "old", date(2022, 12, 31)),
        custody("A3", "new", date(2023, 12, 31)),
        custody("B3", "dated", date(2023, 12, 31)),
        custody("B3", "undated", None),
        custody("C3", "second", DAY, "2"),
        custody("C3", "first", DAY, "1"),
    )
    found = rows_of(income.latest_position(rows), "ticker", "cnpj")
    assert found == [("A3", "new"), ("B3", "undated"), ("C3", "first")]


def test_income_groups_and_leaves_out_zero_totals(table):
    moves = table(
        "b3_movimentacao",
        movement("Dividendo", 10),
        movement("Dividendo", "2.5"),
        movement("Dividendo", 1, "A3 - OTHER NAME"),
        movement("Rendimento", 5),
        movement("Rendimento", -5),
        movement("Atualização", 99),
        movement("Reembolso", 4, "B3 - B", date(2023, 1, 1)),
    )
    held = table("b3_posicao_acoes", custody("A3", "191.0", DAY))
    found = rows_of(income.income(moves, held), "ano_base", "ticker", "cnpj", "nome_compania", "movimentacao", "valor_operacao")
    assert found == [
        (2023, "B3", "", "B", "Reembolso", Decimal("4.00")),
        (2024, "A3", "191.0", "ACME", "Dividendo", Decimal("12.50")),
        (2024, "A3", "191.0", "OTHER NAME", "Dividendo", Decimal("1.00")),
    ]
    assert income.income(moves, held, year=2023).count() == 1


def test_income_total_equals_movement_total(spark):
    d = Derived(spark, SF)
    moves = d.movements()
    expected = moves.filter(F.col("movimentacao").isin(*INCOME_TYPES)).agg(F.sum("valor_operacao")).first()[0]
    assert income.income(moves, d.custody()).agg(F.sum("valor_operacao")).first()[0] == expected


def test_annual_form_unites_both_tables(table):
    row = {"produto": "A3 - ACME", "data_pregao": DAY, "tipo_evento": "Dividendo", "valor_liquido": 3}
    one, two = table("b3_proventos_recebidos", row), table("b3_reembolso_emprestimos", row)
    found = income.income_from_annual(one, two, table("b3_posicao_acoes"))
    assert [r.valor_operacao for r in found.collect()] == [Decimal(3), Decimal(3)]


def test_plain_and_transferred_payments_are_added_up(table):
    moves = table("b3_movimentacao", movement("Dividendo - Transferido", 7), movement("Dividendo", 10))
    rows = income.by_category(income.income(moves, table("b3_posicao_acoes")))
    assert rows_of(rows, "category", "movimentacao", "valor_operacao") == [("exempt_dividend", "Dividendo", Decimal(17))]


def test_sections_need_an_active_ticker_but_totals_do_not(table, frame):
    moves = table(
        "b3_movimentacao",
        movement("Dividendo", 10),
        movement("Dividendo", 11, "X3 - NOT HELD"),
        movement("Empréstimo", 12, "X3 - NOT HELD"),
    )
    active = frame([("tp", 2024, "A3")], "taxpayer_id string, ano_base int, ticker string")
    rows = income.income(moves, table("b3_posicao_acoes"))
    both = income.income_and_bonus(moves, table("b3_bonificacao_acoes"), table("b3_posicao_acoes"))
    entries = income.declared_entries(both, active)
    assert rows_of(entries, "category", "ticker", "valor_operacao") == [
        ("exempt_dividend", "A3", Decimal(10)),
        ("taxable_lending", "", Decimal(12)),
    ]
    years = frame([("tp", 2024), ("tp", 2020)], "taxpayer_id string, ano_base int")
    with_zeros = income.declared_entries(both, active, years).filter("ticker = ''")
    assert rows_of(with_zeros, "ano_base", "category", "valor_operacao") == [
        (2020, "exempt_reimbursement", Decimal(0)),
        (2020, "taxable_lending", Decimal(0)),
        (2024, "exempt_reimbursement", Decimal(0)),
        (2024, "taxable_lending", Decimal(12)),
    ]
    totals = income.section_total(rows, years, "Empréstimo")
    assert rows_of(totals, "ano_base", "valor_operacao") == [(2020, Decimal(0)), (2024, Decimal(12))]


def test_active_tickers(table):
    held = table("b3_posicao_acoes", custody("A3", None, DAY), custody(None, None, DAY), custody("", None, DAY))
    lent = table(
        "b3_posicao_emprestimos",
        {"produto": "B3 - B", "data_pregao": DAY},
        {"produto": "A3 - A", "data_pregao": DAY},
        {"produto": None, "data_pregao": DAY},
        {"produto": "C3 - C", "data_pregao": date(2020, 1, 1)},
    )
    found = declaration.active_tickers(held, lent)
    assert rows_of(found) == [("tp", 2020, "C3"), ("tp", 2024, "A3"), ("tp", 2024, "B3")]
    assert rows_of(declaration.active_tickers(held, lent, 2024)) == [("tp", 2024, "A3"), ("tp", 2024, "B3")]


def test_bonus_rows_take_the_base_value_of_their_year(table, spark):
    moves = table(
        "b3_movimentacao",
        movement("Bonificação em Ativos", 1, quantidade=10, preco_unitario=1),
        movement("Bonificação em Ativos", 1, "NONE3 - N", quantidade=10),
        movement("Dividendo", 1),
    )
    events = spark.createDataFrame(
        [("A3", 2024, 2.5, 0), ("A3", 2024, 3.0, 1), ("A3", 2023, 9.0, 2)],
        "ticker string, ano_ref int, valor_base double, card_no int",
    )
    found = rows_of(bonus.enrich_bonus(moves, events), "produto", "preco_unitario", "valor_operacao")
    assert found == [
        ("A3 - ACME", Decimal("2.500000"), Decimal("25.00")),
        ("A3 - ACME", Decimal("3.000000"), Decimal("30.00")),
        ("NONE3 - N", None, None),
    ]
