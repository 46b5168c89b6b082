import re
from datetime import date
from decimal import Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ledgerspark.functions import clean, keys, text
from ledgerspark.operators import ingest
from ledgerspark.schemas import TABLES

SHEET = ["entrada_saida", "data_pregao", "movimentacao", "produto"]


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def one(frame, cells, make):
    df = frame([(c,) for c in cells], "c string")
    return values(df, make(F.col("c")))


def test_numbers_in_brazilian_notation(frame):
    cells = ["1.234,56", "-", "7", "-0,5", "1.000.000", None, "0,000001"]
    found = one(frame, cells, clean.clean_number)
    expected = ["1234.56", "0", "7", "-0.5", "1000000", None, "0.000001"]
    assert found == [None if e is None else Decimal(e) for e in expected]


@pytest.mark.parametrize("cell", ["abc", " ", "1,2,3", ""])
def test_unreadable_number_fails_the_job(frame, cell):
    with pytest.raises(Exception, match="unreadable number"):
        one(frame, [cell], clean.clean_number)
    assert one(frame, [cell], lambda c: clean.clean_number(c, strict=False)) == [None]


def test_dates(frame):
    cells = ["29/02/2024", "-", None, "1/2/2024"]
    expected = [date(2024, 2, 29), date(2100, 1, 1), None, date(2024, 2, 1)]
    assert one(frame, cells, clean.clean_date) == expected


def test_impossible_date_fails_the_job(frame):
    with pytest.raises(Exception, match="unreadable date: 31/02/2024"):
        one(frame, ["31/02/2024"], clean.clean_date)


def test_strings_keep_null_and_inner_space(frame):
    assert one(frame, ["\t a  b \n", None, "-"], clean.clean_string) == ["a  b", None, "-"]


def test_whole_number_columns_drop_the_fraction(frame):
    kind = dict(TABLES["b3_posicao_acoes"].columns)["quantidade"]
    found = one(frame, ["7,9", "-7,9", "-"], lambda c: clean.clean_cell(c, kind))
    assert found == [Decimal(7), Decimal(-7), Decimal(0)]


@pytest.mark.parametrize(("columns", "allowed"), [(1, 0), (3, 1), (4, 2), (6, 3), (8, 3), (15, 3)])
def test_missing_cells_allowed(columns, allowed):
    assert clean.missing_allowed(columns) == allowed


def test_sparse_rows_go(frame):
    rows = [("a", "b", "c", "d"), ("a", "b", "-", None), ("a", "", " ", "-"), ("a", "b", " - ", "d")]
    kept = ingest.drop_sparse_rows(frame(rows, "p string, q string, r string, s string"), list("pqrs"))
    assert [r[0:3] for r in rows_of(kept)] == [("a", "b", " - "), ("a", "b", "-"), ("a", "b", "c")]


def test_short_sheet_gets_a_null_last_column(frame):
    df = frame([("x", ["1", "2", "3"]), ("y", ["1", "2", "3", "4"])], "k string, cells array<string>")
    named = ingest.positional_columns(df, ["a", "b", "c", "d"], ["k"])
    assert rows_of(named) == [("x", "1", "2", "3", None), ("y", "1", "2", "3", "4")]


def test_wrong_width_fails_the_job(frame):
    df = frame([("x", ["1", "2"])], "k string, cells array<string>")
    with pytest.raises(Exception, match="expected 4 columns, found 2"):
        ingest.positional_columns(df, ["a", "b", "c", "d"], ["k"]).collect()


def test_sheet_routing(frame):
    rows = [
        ("relatorio-consolidado-anual", 3, "Posição - Ações"),
        ("relatorio-consolidado-anual", 0, "Posição - ETF"),
        ("movimentacao", 0, "Plan1"),
        ("movimentacao", 1, "Plan2"),
        ("negociacao", 0, "x"),
    ]
    routed = ingest.route_sheets(frame(rows, "report string, sheet_no int, sheet string"))
    assert rows_of(routed, "sheet", "table_name") == [
        ("Plan1", "b3_movimentacao"),
        ("Posição - Ações", "b3_posicao_acoes"),
        ("x", "b3_negociacao"),
    ]
    assert ingest.sheet_of_table("b3_proventos_recebidos") == "Proventos Recebidos"
    with pytest.raises(ValueError, match="b3_negociacao"):
        ingest.sheet_of_table("b3_negociacao")


def test_tax_ids(frame):
    cells = ["191", "191.0", "123456789012345", "", None, "00.000.000/0001-91", "abc", "33000167000101"]
    assert one(frame, cells, text.format_tax_id) == [
        "00.000.000/0001-91",
        "00.000.000/0001-91",
        "12.345.678/9012-345",
        "",
        "",
        "00.000.000/0001-91",
        "",
        "33.000.167/0001-01",
    ]


def test_tax_id_falls_back_to_the_registry(frame):
    df = frame([("KLBN11", None), ("KLBN11", "191"), ("XXXX3", "")], "t string, c string")
    found = values(df, text.resolve_tax_id(F.col("t"), F.col("c"), {"KLBN11": "known"}))
    assert found == ["known", "00.000.000/0001-91", ""]


def test_amounts_are_cut_not_rounded(frame):
    cells = ["1.999", "-1.999", "-0.001", "0", "1234567.5", None]
    df = frame([(None if c is None else Decimal(c),) for c in cells], "c decimal(18,6)")
    assert values(df, text.format_amount(F.col("c"))) == ["1,99", "-1,99", "-0,00", "0,00", "1234567,50", "0,00"]
    assert values(df, text.format_amount(F.col("c"), 0))[:2] == ["1", "-1"]


def test_amounts_keep_all_their_digits(frame):
    df = frame([(Decimal("99.999999999999999999999999"),), (Decimal("66528298.77"),), (None,)], "c decimal(38,24)")
    assert values(df, text.format_amount(F.col("c"))) == ["99,99", "66528298,77", "0,00"]


def test_number_text_in_keys(frame):
    df = frame([(Decimal(v),) for v in ("7", "10000000", "1.5", "0.000001", "0")], "c decimal(18,6)")
    assert values(df, keys.number_text(F.col("c"))) == ["7,0", "10000000,0", "1,5", "0,000001", "0,0"]


def test_movement_and_trade_keys(table):
    move = table(
        "b3_movimentacao",
        {
            "entrada_saida": "Credito",
            "data_pregao": date(2024, 3, 1),
            "movimentacao": "Dividendo",
            "produto": "A3 - X",
            "quantidade": 10,
            "preco_unitario": "1.5",
            "valor_operacao": 15,
        },
    )
    assert values(move, keys.movement_key()) == ["Credito01/03/2024DividendoA3 - X10,01,515,0"]
    trade = table(
        "b3_negociacao",
        {"data_negocio": date(2024, 3, 1), "tipo_movimentacao": "Compra", "ticker": "A3", "quantidade": 10, "preco": "1.5"},
    )
    assert values(trade, keys.trade_key()) == ["01/03/2024CompraA3101,5"]


def test_surrogate_key_depends_on_the_natural_key_alone(table):
    spec = TABLES["b3_proventos_recebidos"]
    rows = table(
        spec.name,
        {"id": "1", "produto": "A", "tipo_evento": "x", "valor_liquido": 1},
        {"id": "2", "produto": "A", "tipo_evento": "x", "valor_liquido": 2},
        {"id": "3", "produto": "A", "tipo_evento": None},
    )
    found = values(rows, keys.surrogate_key(list(spec.natural_key)))
    assert found[0] == found[1] != found[2]


def test_fraction_mark(frame):
    assert one(frame, ["BBAS3F", "F", "FFFF", "A3", None], text.without_fraction_mark) == ["BBAS3", "", "FFF", "A3", None]


def test_product_label_without_company(frame):
    df = frame([("A3 - B - C",), ("A3",), (None,)], "c string")
    assert values(df, text.product_company(F.col("c"))) == ["B", "", None]
    assert values(df, text.product_ticker(F.col("c"))) == ["A3", "A3", None]


def test_white_space_is_what_unicode_calls_so(spark):
    codes = [c for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(f"{chr(c)}a {chr(c)} b{chr(c)}{chr(c)}",) for c in codes], "t string")
    assert df.filter(~text.strip(F.col("t")).eqNullSafe(F.regexp_replace("t", r"(?U)^\s+|\s+\z", ""))).collect() == []


@pytest.mark.parametrize("name", TABLES)
def test_methods_of_a_table_can_be_compiled(spark, name):
    """HotSpot leaves methods of 8000 bytes and more to its interpreter."""
    cells = spark.range(1).selectExpr(
        "'ana' AS taxpayer_id", "'p' AS path", "cast(id as int) AS row_idx", "2024 AS ref_year", "array(cast(id as string)) AS cells"
    )
    plan = ingest.table_rows(cells, TABLES[name])._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    assert sizes and max(sizes) < 8000
