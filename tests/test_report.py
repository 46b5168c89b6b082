from decimal import Decimal

import pytest
from conftest import rows_of

from ledgerspark.fixed_values import ReportText
from ledgerspark.operators import declaration, report

POSITION = "taxpayer_id string, ano_base int, ticker string, cnpj string, nome_compania string, quantidade long, preco_medio_compra decimal(38,24), posicao_fin decimal(38,24)"
ENTRY = "taxpayer_id string, ano_base int, category string, ticker string, cnpj string, nome_compania string, movimentacao string, valor_operacao decimal(28,2)"


@pytest.fixture(scope="module")
def parts(frame):
    positions = frame([("tp", 2024, "PETR4", "33.000.167/0001-01", "PETROBRAS", 100, Decimal(30), Decimal(3000))], POSITION)
    entries = frame(
        [
            ("tp", 2024, "exempt_dividend", "ITUB4", "60872504000123", "ITAU", "Dividendo", Decimal("150.00")),
            ("tp", 2024, "exempt_dividend", "BBAS3", "191", "BANCO", "Dividendo", Decimal("1.00")),
            ("tp", 2024, "taxable_jcp", "BBAS3", "191", "BANCO", "Juros", Decimal("75.50")),
            ("tp", 2024, "exempt_fraction_auction", "Bbas3", "191", "BANCO", "Leilão", Decimal("2.00")),
            ("tp", 2024, "exempt_bonus_shares", "KLBN11", "", "KLABIN", "Bonificação", None),
            ("tp", 2024, "taxable_monetary_update", "BBAS3", "191", "BANCO", "Rendimento", Decimal("3.00")),
            ("tp", 2024, "taxable_lending", "", "", "", "Empréstimo", Decimal("50.00")),
            ("tp", 2024, "exempt_reimbursement", "", "", "", None, Decimal(0)),
            ("empty", 2024, "taxable_lending", "", "", "", None, Decimal(0)),
            ("empty", 2024, "exempt_reimbursement", "", "", "", None, Decimal(0)),
        ],
        ENTRY,
    )
    years = frame([("tp", 2024), ("empty", 2024)], "taxpayer_id string, ano_base int")
    taxpayers = frame([("tp", "Test User", "000.000.000-00")], "taxpayer_id string, full_name string, cpf string")
    return positions, entries, years, taxpayers


@pytest.fixture(scope="module")
def texts(parts):
    lines = report.report_lines(*parts)
    return {r.taxpayer_id: r.report for r in report.assemble_reports(lines).collect()}


def test_whole_report(texts):
    stars = "*" * 16
    payer = "CNPJ da Fonte Pagadora: 00.000.000/0001-91\nNome da Fonte Pagadora: BANCO\n"
    exchange = "CNPJ da Fonte Pagadora: 09.346.601/0001-25\nNome da Fonte Pagadora: B3 S.A. - BRASIL. BOLSA. BALCAO\n"
    assert texts["tp"] == (
        f"{stars} 0. DADOS DO CONTRIBUINTE {stars}\n\n"
        "Nome Completo Contribuinte: Test User\nCPF Contribuinte: 000.000.000-00\n\n"
        f"{stars} 1. BENS E DIREITOS {stars}\n\n"
        "\\\\ TICKER: PETR4\nGrupo: 03 - Participações Societárias\nCódigo: 01 - Ações (inclusive as listadas em bolsa)\n"
        "Localização (País): 105 - Brasil\nCNPJ: 33.000.167/0001-01\n"
        "Discriminação: PETR4 100 QUANTIDADES, ADQUIRIDAS A UM PRECO MEDIO DE R$ 30,00\nNegociados em Bolsa? Sim\n"
        "Código de Negociação: PETR4\nSituação em 31/12/2024 (R$): 3000,00\n\n"
        f"\n\n{stars} 2. DIVIDENDOS - RENDIMENTOS ISENTOS E NÃO TRIBUTÁVEIS {stars}\n\n"
        f"\\\\ TICKER: BBAS3\nTipo de Rendimento: 09 - Lucros e dividendos recebidos\n{payer}Valor: 1,00\n\n"
        "\\\\ TICKER: ITUB4\nTipo de Rendimento: 09 - Lucros e dividendos recebidos\n"
        "CNPJ da Fonte Pagadora: 60.872.504/0001-23\nNome da Fonte Pagadora: ITAU\nValor: 150,00\n\n"
        f"\n\n{stars} 3. JCP - RENDIMENTOS SUJEITOS À TRIBUTAÇÃO EXCLUSIVA/DEFINITVA {stars}*\n\n"
        f"\\\\ TICKER: BBAS3\nTipo de Rendimento: 10 - Juros sobre capital próprio\n{payer}Valor: 75,50\n\n"
        f"\n\n{stars} 4. LEILÃO DE FRAÇÃO DE AÇÕES - RENDIMENTOS ISENTOS E NÃO TRIBUTÁVEIS {stars}\n\n"
        f"\\\\ TICKER: Bbas3\nTipo de Rendimento: 99 - Outros\n{payer}"
        "Descrição: VENDA DE FRACAO DE ACAO EM LEILAO - BBAS3\nValor: 2,00\n\n"
        f"\n\n{stars} 5. BONIFICAÇÃO EM AÇÕES - RENDIMENTOS ISENTOS E NÃO TRIBUTÁVEIS {stars}\n\n"
        "\\\\ TICKER: KLBN11\nTipo de Rendimento: 18 - Incorporação de reservas ao capital / Bonficações em ações\n"
        "CNPJ da Fonte Pagadora: 89.637.490/0001-45\nNome da Fonte Pagadora: KLABIN\nValor: 0,00\n\n"
        f"\n\n{stars} 6. RENDIMENTOS DE ATUALIZAÇÕES DE BASES MONETÁRIAS - RENDIMENTOS SUJEITOS À TRIBUTAÇÃO EXCLUSIVA/DEFINITVA {stars}\n\n"
        f"\\\\ TICKER: BBAS3\nTipo de Rendimento: 06 - Rendimentos de aplicações financeiras\n{payer}Valor: 3,00\n\n"
        f"\n\n{stars} 7. RENDIMENTOS COM ALUGUEL DE AÇÕES  - RENDIMENTOS SUJEITOS À TRIBUTAÇÃO EXCLUSIVA / DEFINITIVA{stars}\n\n"
        f"Tipo de Rendimento: 06 - Rendimentos de aplicações financeiras\n{exchange}Valor: 50,00\n\n"
        f"\n\n{stars} 8. RENDIMENTOS COM REEMBOLSO DE PROVENTOS  - RENDIMENTOS ISENTOS E NÃO TRIBUTÁVEIS {stars}\n\n"
        f"Tipo de Rendimento: 99 - Outros\n{exchange}Descrição: REEMBOLSO DE PROVENTOS REFERENTES A ACOES ALUGADAS\nValor: 0,00\n\n"
    )


def test_report_without_any_income(texts):
    assert "Nome Completo Contribuinte: \nCPF Contribuinte: \n" in texts["empty"]
    assert texts["empty"].count("Valor: 0,00") == 2 and "TICKER" not in texts["empty"]


def test_written_report_equals_the_assembled_one(parts, texts, tmp_path):
    report.write_reports(report.report_lines(*parts), str(tmp_path / "out"))
    for taxpayer, text in texts.items():
        (file,) = (tmp_path / "out" / f"taxpayer_id={taxpayer}" / "ano_base=2024").glob("*.txt")
        assert file.read_text() == text


def test_own_wording(parts):
    words = ReportText(titles=("A\n", *["-\n"] * 8), decimal_places=1, description="{} x {} @ {}", full_name_label="N: ")
    lines = report.report_lines(*parts, words=words)
    text = {r.taxpayer_id: r.report for r in report.assemble_reports(lines).collect()}["tp"]
    assert text.startswith("A\nN: Test User\n") and "PETR4 x 100 @ 30,0" in text


def test_nested_record_keeps_empty_sections(parts):
    positions, entries, years, _ = parts
    nested = declaration.nested_declaration(positions, entries, years)
    record = {r.taxpayer_id: r for r in nested.collect()}
    assert [e.ticker for e in record["tp"].exempt_dividends] == ["BBAS3", "ITUB4"]
    assert record["tp"].positions[0].quantidade == 100
    assert (record["tp"].lending_income, record["tp"].reimbursement) == (Decimal(50), Decimal(0))
    assert record["empty"].positions == [] and record["empty"].bonus_shares == []
    flat = declaration.flat_declaration(nested)
    assert flat.filter("ticker is not null").count() == 7
    # Empty lists and totals have a row too.
    assert flat.filter("taxpayer_id = 'empty'").count() == 8
    assert ("KLBN11", "89.637.490/0001-45") in rows_of(flat, "ticker", "cnpj")


def test_declared_position_of_a_ticker_with_variants(frame):
    held = frame(
        [("tp", "A3", None, Decimal("1.9"), None, "1", "X"), ("tp", "A3", Decimal(2), Decimal(3), Decimal(6), "1", "Y"), ("tp", "B3", Decimal(1), Decimal(1), Decimal(1), "", "B")],
        "taxpayer_id string, instrumento string, preco_medio_compra decimal(38,24), qtd_lado decimal(28,6), posicao_fin decimal(38,24), cnpj string, nome_compania string",
    )
    active = frame([("tp", 2023, "A3"), ("tp", 2024, "A3")], "taxpayer_id string, ano_base int, ticker string")
    found = declaration.declared_positions(held, active)
    assert rows_of(found, "ano_base", "ticker", "nome_compania", "quantidade") == [(2023, "A3", "Y", 3), (2024, "A3", "Y", 3)]


def test_requested_year_defaults_to_the_last(frame):
    from datetime import date

    people = frame([("a",), ("a",), ("b",)], "taxpayer_id string")
    last = date.today().year - 1
    assert rows_of(declaration.requested_year(people)) == [("a", last), ("b", last)]
