"""From report files to declaration text."""

import os
from datetime import date

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ledgerspark.fixed_values import ANNUAL_SHEETS
from ledgerspark.plans.declaration_run import Declaration, run_declaration
from ledgerspark.plans.files import workbook_bytes
from ledgerspark.plans.import_run import run_import, run_legacy_load
from ledgerspark.schemas import TABLES
from ledgerspark.sources.tables import read_table

PAGE = (
    '<div class="card p-2 p-xs-3"><h3 class="t">Bonificação</h3>'
    + "".join(
        f'<strong class="d-block lh-3 fs-3 fw-700">{v}</strong>'
        for v in ("01/02/2024", "02/02/2024", "03/02/2024", "-", "R$ 12,50", "10,00%")
    )
    + "</div>"
)


def movement_book(rows):
    return workbook_bytes([("Movimentação", [TABLES["b3_movimentacao"].column_names, *rows])])


MOVES = [
    ["Credito", "05/03/2024", "Dividendo ", "ACME3 - ACME S.A.", "BROKER", "-", "-", 100.5],
    ["Credito", "05/03/2024", "Dividendo", "ACME3 - ACME S.A.", "BROKER", "-", "-", 100.5],
    ["Credito", "06/03/2024", "Empréstimo", "ACME3 - ACME S.A.", "BROKER", 1, "2,00", "1.002,00"],
    ["Credito", "07/03/2024", "Bonificação em Ativos", "ACME3 - ACME S.A.", "BROKER", 10, "-", "-"],
    ["Credito", "08/03/2024", "Desdobro", "ACME3 - ACME S.A.", "BROKER", 90, "-", "-"],
    ["-", "-", "-", "-", None, None, None, None],
]
TRADES = [
    ["01/02/2024", "Compra", "Mercado à Vista", "-", "BROKER", "ACME3", 90, "10,00", 900],
    ["01/02/2024", "Compra", "Mercado Fracionário", "-", "BROKER", "ACME3F", 10, 9.5, 95],
]
CUSTODY = [
    ["ACME3 - ACME S.A.", "BROKER", 123, "ACME3", 191, "BRACME", "ON", "ESCR", 180, 180, "-", "-", 11, "1.980,00"],
]
LOANS = [
    ["ACME3 - ACME S.A.", "BROKER", "Doador", "CT-1", "x", "-", "Sim", "0,5", "0,1", "01/03/2023", "01/06/2024", 20, 11, 220],
]
EVENTS = [["ACME3 - ACME S.A.", "Dividendo", "100,50"]]


@pytest.fixture(scope="module")
def imported(spark, tmp_path_factory):
    folder, tables = tmp_path_factory.mktemp("reports"), str(tmp_path_factory.mktemp("tables"))
    sheets = {
        "b3_posicao_acoes": CUSTODY,
        "b3_posicao_emprestimos": LOANS,
        "b3_proventos_recebidos": EVENTS,
        "b3_reembolso_emprestimos": EVENTS,
    }
    annual = [
        (sheet, [TABLES[t].column_names[:-1], *sheets[t]]) for sheet, t in ANNUAL_SHEETS.items()
    ]
    trades = workbook_bytes([("Negociação", [TABLES["b3_negociacao"].column_names, *TRADES])])
    for who in ("ana", "bia"):
        (folder / f"{who}-movimentacao-2024.xlsx").write_bytes(movement_book(MOVES))
        (folder / f"{who}-negociacao-2024.xlsx").write_bytes(trades)
        (folder / f"{who}-relatorio-consolidado-anual-2023.xlsx").write_bytes(
            workbook_bytes([("Outra", [["x"], ["y"]]), *annual])
        )
    pages = spark.createDataFrame([("ACME3", PAGE), ("ZZZZ3", PAGE)], "ticker string, html string")
    first = run_import(spark, str(folder), tables, "one", pages, year=2024).collect()
    # A later export of one taxpayer repeats the old rows and has a new one.
    more = [*MOVES, ["Credito", "09/03/2024", "Rendimento", "ACME3 - ACME S.A.", "BROKER", "-", "-", 7]]
    (folder / "ana-movimentacao-2024-later.xlsx").write_bytes(movement_book(more))
    second = run_import(spark, str(folder), tables, "two", pages, year=2024).collect()
    return tables, first, second


def test_import_counts(imported):
    _, first, second = imported
    counts = {r.table_name: (r.rows_processed, r.rows_inserted) for r in first}
    assert counts == {
        "b3_movimentacao": (10, 8),
        "b3_negociacao": (4, 4),
        "b3_posicao_acoes": (2, 2),
        "b3_posicao_emprestimos": (2, 2),
        "b3_proventos_recebidos": (2, 2),
        "b3_reembolso_emprestimos": (2, 2),
        "b3_bonificacao_acoes": (2, 2),
    }
    added = {r.table_name: r.rows_inserted for r in second}
    assert added.pop("b3_movimentacao") == 1 and set(added.values()) == {0}


def test_imported_rows(spark, imported):
    tables, _, _ = imported

    def stored(name, *columns):
        return rows_of(read_table(spark, f"{tables}/{name}", TABLES[name], "bia").select(*columns))

    (row,) = stored("b3_posicao_acoes", "taxpayer_id", "cnpj", "conta", "quantidade_indisp", "data_pregao", "valor_atualizado")
    assert row[:2] == ("bia", "191") and row[4] == date(2023, 12, 31)
    assert [int(v) for v in (row[2], row[3], row[5])] == [123, 0, 1980]
    (row,) = stored("b3_bonificacao_acoes", "quantidade", "preco_unitario", "valor_operacao")
    assert [float(v) for v in row] == [10, 12.5, 125]
    trades = stored("b3_negociacao", "ticker", "quantidade", "prazo_vencimento", "pk_negociacao")
    assert trades == [
        ("ACME3", 90, date(2100, 1, 1), "01/02/2024CompraACME39010,0"),
        ("ACME3F", 10, date(2100, 1, 1), "01/02/2024CompraACME3F109,5"),
    ]
    assert len(stored("b3_movimentacao", "pk_movimentacao")) == 4


def test_import_of_no_tables(spark, tmp_path):
    (tmp_path / "ana-movimentacao-2024.xlsx").write_bytes(movement_book(MOVES))
    pages = spark.createDataFrame([], "ticker string, html string")
    assert run_import(spark, str(tmp_path), str(tmp_path / "t"), "x", pages, tables=[]).collect() == []


def test_declaration_of_all_taxpayers(spark, imported, tmp_path):
    tables, _, _ = imported
    people = spark.createDataFrame(
        [("ana", "ANA", "1"), ("bia", "BIA", "2"), ("cid", "CID", "3")], "taxpayer_id string, full_name string, cpf string"
    )
    run_declaration(Declaration(spark, tables, people, 2023), str(tmp_path / "out"))
    texts = {
        f.parent.parent.name.removeprefix("taxpayer_id="): f.read_text() for f in (tmp_path / "out").glob("*/*/*.txt")
    }
    assert set(texts) == {"ana", "bia", "cid"}
    # (90·10 + 10·9.5 + 125) / (100 + 90 + 10) a share, for 180 in custody and 20 lent.
    assert "ACME3 200 QUANTIDADES, ADQUIRIDAS A UM PRECO MEDIO DE R$ 5,60" in texts["bia"]
    assert "Situação em 31/12/2023 (R$): 1120,00" in texts["bia"] and "CNPJ: 00.000.000/0001-91" in texts["bia"]
    assert "TICKER" not in texts["cid"] and "CPF Contribuinte: 3" in texts["cid"]
    bounded = Declaration(spark, tables, people, 2023, taxpayer="bia", bounded=True)
    (row,) = bounded.positions().collect()
    assert (row.taxpayer_id, row.quantidade, row.preco_medio_compra) == ("bia", 200, 0.0)


def test_income_of_the_year_goes_to_active_tickers(spark, imported):
    tables, _, _ = imported
    people = spark.createDataFrame([("ana", "ANA", "1")], "taxpayer_id string, full_name string, cpf string")
    entries = Declaration(spark, tables, people, 2024).entries()
    # No annual report of 2024 yet: no active ticker, but lending income counts.
    assert rows_of(entries.select("taxpayer_id", "category", F.col("valor_operacao").cast("double"))) == [
        ("ana", "exempt_reimbursement", 0.0),
        ("ana", "taxable_lending", 1002.0),
    ]


def test_legacy_load_replaces_its_taxpayers_only(spark, table, tmp_path):
    from ledgerspark.sources.tables import BUCKET, bucket_of, write_table

    spec, other = TABLES["b3_proventos_recebidos"], TABLES["b3_reembolso_emprestimos"]
    people = ["ana", "tp", *[f"p{i}" for i in range(200)]]
    buckets = dict(rows_of(spark.createDataFrame([(p,) for p in people], "p string").select("p", bucket_of(F.col("p")))))
    mate = next(p for p in people[2:] if buckets[p] == buckets["ana"])
    lone = next(p for p in people if list(buckets.values()).count(buckets[p]) == 1 or p == "tp")
    for s in (spec, other):
        rows = [{"taxpayer_id": p, "id": f"old-{p}"} for p in dict.fromkeys(("ana", mate, lone)) for _ in "xy"]
        write_table(table(s.name, *rows), str(tmp_path / "t" / s.name), s)
    far = tmp_path / "t" / spec.name / f"{BUCKET}={buckets[lone]}"
    before = sorted(f.name for f in far.iterdir())
    text = "COPY public.proventos_recebidos (id, produto, data_pregao) FROM stdin;\nnew\t-\t01/02/2024\n\\.\n"
    (tmp_path / "d.sql").write_text(text)
    run_legacy_load(spark, str(tmp_path / "d.sql"), str(tmp_path / "t"), F.lit("ana"))
    kept = [(p, f"old-{p}") for p in (mate, lone) for _ in "xy"]
    loaded = read_table(spark, str(tmp_path / "t" / spec.name), spec)
    assert rows_of(loaded, "taxpayer_id", "id") == sorted([("ana", "new"), *kept], key=repr)
    assert rows_of(loaded.filter("id = 'new'"), "produto", "data_pregao") == [(None, date(2024, 2, 1))]
    assert rows_of(read_table(spark, str(tmp_path / "t" / other.name), other), "taxpayer_id", "id") == sorted(kept, key=repr)
    # Buckets without a loaded taxpayer are not written.
    assert sorted(f.name for f in far.iterdir()) == before
    # A taxpayer who is alone in a bucket goes when the dump has nothing.
    (tmp_path / "e.sql").write_text("SELECT 1;\n")
    run_legacy_load(spark, str(tmp_path / "e.sql"), str(tmp_path / "t"), F.lit(lone))
    assert rows_of(read_table(spark, str(tmp_path / "t" / other.name), other), "taxpayer_id") == [(mate,), (mate,)]


def test_two_bonus_events_of_a_year_import_alike(spark, tmp_path):
    two = PAGE + PAGE.replace("12,50", "99,00")
    folder, pages = tmp_path / "in", spark.createDataFrame([("ACME3", two)], "ticker string, html string")
    folder.mkdir()
    (folder / "ana-movimentacao-2024.xlsx").write_bytes(movement_book(MOVES))
    names = ["b3_bonificacao_acoes"]
    summary = run_import(spark, str(folder), str(tmp_path / "t"), "x", pages, tables=names).collect()
    assert [tuple(r) for r in summary] == [("b3_bonificacao_acoes", 2, 1, "ok")]
    spec = TABLES["b3_bonificacao_acoes"]
    assert [float(r[0]) for r in rows_of(read_table(spark, str(tmp_path / "t" / spec.name), spec), "preco_unitario")] == [12.5]


def _row(value):
    return ["Credito", "09/03/2024", "Rendimento", "ACME3 - A", "B", "-", "-", value]


def _stored(spark, tables):
    return {
        name: sorted(map(str, read_table(spark, f"{tables}/{name}", spec).collect()))
        for name, spec in TABLES.items()
    }


def _report(folder, name, rows, time):
    (folder / name).write_bytes(movement_book(rows))
    os.utime(folder / name, (1_700_000_000 + time, 1_700_000_000 + time))


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_stream_and_batch_import_give_equal_tables(spark, tmp_path, files_per_batch):
    """Run by run, whatever the order in which the files of a folder come and however they are cut into batches."""
    from ledgerspark.streaming.incremental import import_new_reports

    folder, pages = tmp_path / "in", spark.createDataFrame([("ACME3", PAGE)], "ticker string, html string")
    folder.mkdir()
    stream = (str(folder), str(tmp_path / "stream"), str(tmp_path / "c"))
    runs = [
        [("ana-movimentacao-2024-a.xlsx", MOVES, 5), ("ana-movimentacao-2024-b.xlsx", [_row(7)], 3), ("bia-movimentacao-2024.xlsx", [_row(8)], 1)],
        # A correction, and a file that comes late but is older than the one known.
        [("ana-movimentacao-2024-c.xlsx", [*MOVES, _row(9)], 8), ("bia-movimentacao-2024-old.xlsx", [_row(10)], 0)],
        [],
        [("bia-movimentacao-2024-x.xlsx", [_row(11)], 1), ("bia-movimentacao-2024-new.xlsx", [_row(12)], 2)],
    ]
    added = []
    for n, files in enumerate(runs):
        for file in files:
            _report(folder, *file)
        summary = import_new_reports(spark, *stream, f"run{n}", pages, files_per_batch)
        added.append(None if summary is None else sum(r.rows_inserted for r in summary.collect()))
        run_import(spark, str(folder), str(tmp_path / "batch"), f"run{n}", pages)
        assert _stored(spark, stream[1]) == _stored(spark, str(tmp_path / "batch"))
    assert added == [6, 1, None, 1]
    values = {r[0] for r in rows_of(read_table(spark, f"{stream[1]}/b3_movimentacao", TABLES["b3_movimentacao"]), "valor_operacao")}
    assert not values & {7, 10, 11} and values >= {8, 9, 12}


def test_stream_imports_what_a_failed_run_left(spark, tmp_path, monkeypatch):
    from ledgerspark.streaming import incremental

    folder, pages = tmp_path / "in", spark.createDataFrame([], "ticker string, html string")
    folder.mkdir()
    _report(folder, "ana-movimentacao-2024.xlsx", MOVES, 1)
    where = (str(folder), str(tmp_path / "t"), str(tmp_path / "c"))

    def fail(*args, **options):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(incremental, "import_cells", fail)
        with pytest.raises(RuntimeError, match="lost"):
            incremental.import_new_reports(spark, *where, "one", pages)
    assert incremental.import_new_reports(spark, *where, "two", pages) is not None
    spec = TABLES["b3_movimentacao"]
    assert read_table(spark, f"{where[1]}/{spec.name}", spec).count() == 4
    assert incremental.import_new_reports(spark, *where, "three", pages) is None


def test_new_rows_are_written_and_counted_once(spark, tmp_path):
    """The count of an append is that of the rows its table has more, and no scratch copy of them is made."""
    from ledgerspark.operators.merge import append_new_rows

    spec, path = TABLES["b3_movimentacao"], str(tmp_path / "t")
    names = [f"cast(null AS {f.dataType.simpleString()}) AS {f.name}" for f in spec.schema]
    rows = spark.range(50).selectExpr("id AS n", *names).withColumn("taxpayer_id", F.concat(F.lit("t"), F.col("n") % 7))
    rows = rows.withColumn("pk_movimentacao", (F.col("n") % 40).cast("string")).drop("n")
    counts = []
    for part in (rows.limit(0), rows, rows):
        before = read_table(spark, path, spec).count()
        added = append_new_rows(part, path, spec, ["taxpayer_id"], "r")
        counts.append((added, read_table(spark, path, spec).count() - before))
    n = rows.select("taxpayer_id", "pk_movimentacao").distinct().count()
    assert counts == [(0, 0), (n, n), (0, 0)]


def test_totals_follow_the_imports(spark, tmp_path):
    """After every import the totals give what a pass over all trades gives, and no trade is read for them."""
    from ledgerspark.plans.totals import drop_totals, refresh_totals, stored_totals

    folder, tables = tmp_path / "in", str(tmp_path / "t")
    folder.mkdir()
    pages = spark.createDataFrame([("ACME3", PAGE)], "ticker string, html string")
    people = spark.createDataFrame([("ana", "Ana", "1"), ("bia", "Bia", "2")], "taxpayer_id string, full_name string, cpf string")
    header = TABLES["b3_negociacao"].column_names
    sheets = {"b3_posicao_acoes": CUSTODY, "b3_posicao_emprestimos": LOANS}
    annual = [(sheet, [TABLES[t].column_names[:-1], *sheets.get(t, EVENTS)]) for sheet, t in ANNUAL_SHEETS.items()]

    def declared(**options):
        return rows_of(Declaration(spark, tables, people, 2023, **options).positions())

    with pytest.raises(FileNotFoundError):
        Declaration(spark, tables, people, 2023, totals=True)
    more = [["02/02/2024", "Compra", "M", "-", "B", "ACME3", n, 7, 7 * n] for n in (1, 2, 4)]
    for n in range(3):
        for who in ("ana", "bia"):
            rows = TRADES + more[:n] if who == "ana" else TRADES
            (folder / f"{who}-negociacao-2024-{n}.xlsx").write_bytes(workbook_bytes([("N", [header, *rows])]))
            (folder / f"{who}-movimentacao-2024-{n}.xlsx").write_bytes(movement_book(MOVES))
            (folder / f"{who}-relatorio-consolidado-anual-2023.xlsx").write_bytes(workbook_bytes(annual))
        for i, f in enumerate(sorted(folder.iterdir())):
            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
        run_import(spark, str(folder), tables, f"run{n}", pages)
        assert refresh_totals(spark, tables) == 1 and refresh_totals(spark, tables) == 0
        assert declared(totals=True) == declared() != []
    assert declared(totals=True, taxpayer="bia") == declared(taxpayer="bia")
    plan = Declaration(spark, tables, people, 2023, totals=True).positions()._jdf.queryExecution().executedPlan().toString()
    assert "totais_por_ticker" in plan and "b3_negociacao" not in plan and "b3_movimentacao" not in plan
    with pytest.raises(ValueError, match="run2"):
        run_import(spark, str(folder), tables, "run2", pages)
    before = rows_of(stored_totals(spark, tables))
    drop_totals(spark, tables)
    assert refresh_totals(spark, tables) == 3 and rows_of(stored_totals(spark, tables)) == before


def test_cells_of_a_job_that_is_alone_are_not_stored(spark, tmp_path, monkeypatch):
    from ledgerspark.plans import import_run

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "ana-movimentacao-2024.xlsx").write_bytes(movement_book(MOVES))
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(import_run, "scratch_dir", lambda spark, name: str(scratch))
    monkeypatch.setattr(import_run, "remove_dir", lambda spark, path: None)
    pages = spark.createDataFrame([], "ticker string, html string")
    run_import(spark, str(folder), str(tmp_path / "t"), "x", pages, tables=["b3_movimentacao"])
    assert sorted(p.name for p in scratch.iterdir()) == ["b3_movimentacao"]
