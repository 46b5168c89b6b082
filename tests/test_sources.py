import io
import os
import random
from datetime import datetime
from xml.etree import ElementTree

import pyarrow as pa
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ledgerspark.operators.bonus import page_cards, typed_cards
from ledgerspark.plans import files
from ledgerspark.plans.files import workbook_bytes
from ledgerspark.schemas import TABLES
from ledgerspark.session import scratch_dir
from ledgerspark.sources import legacy_dump, reports, tables, workbook
from ledgerspark.sources.workbook import opened_by_tasks, store_of, workbook_cells


def test_workbook_cells_from_files(spark, tmp_path):
    book = workbook_bytes(
        [
            ("Um", [["h1", "h2", "h3"], ["á & <b>", 1234.5, None], [None, 191.0, "1.234,56"]]),
            ("Dois", [["h"], [33000167000101], [1e-07]]),
        ]
    )
    (tmp_path / "tp1-movimentacao-2024-a.xlsx").write_bytes(book)
    (tmp_path / "notes.txt").write_text("no workbook")
    cells = workbook_cells(reports.binary_files(spark, str(tmp_path)))
    assert rows_of(cells, "sheet_no", "sheet", "row_idx", "cells") == [
        (0, "Um", 0, ["h1", "h2", "h3"]),
        (0, "Um", 1, ["á & <b>", "1234,5", None]),
        (0, "Um", 2, [None, "191", "1.234,56"]),
        (1, "Dois", 0, ["h"]),
        (1, "Dois", 1, ["33000167000101"]),
        (1, "Dois", 2, ["0,0000001"]),
    ]


def test_workbook_with_shared_texts(spark):
    import io
    import zipfile

    out = io.BytesIO(workbook_bytes([("S", [["h"]])]))
    source = zipfile.ZipFile(out)
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    changed = io.BytesIO()
    with zipfile.ZipFile(changed, "w") as book:
        for name in source.namelist():
            if "worksheets" not in name:
                book.writestr(name, source.read(name))
        book.writestr(
            "xl/sharedStrings.xml", f'<sst xmlns="{ns}"><si><t>a</t></si><si><r><t>b</t></r><r><t>c</t></r></si></sst>'
        )
        book.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet xmlns="{ns}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="AB1" t="s"><v>1</v></c></row>'
            '<row><c r="A2" t="e"><v>#N/A</v></c><c r="B2"/><c r="AD2" s="3"/></row></sheetData></worksheet>',
        )
    files = spark.createDataFrame([("p", bytearray(changed.getvalue()))], "path string, content binary")
    first, second = workbook_cells(files).collect()
    assert first.cells == ["a"] + [None] * 26 + ["bc"]
    assert second.cells == [None] * 28


MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
PLAIN_CELLS = [
    '<c r="A1"><v>1.50</v></c>',
    '<c r="B1" t="inlineStr"><is><t xml:space="preserve"> é </t></is></c>',
    '<c r="D1" s="2" t="s"><v>1</v></c>',
    '<c r="AB1" t="str"><v>ab</v></c>',
    '<c t="e"><v>#N/A</v></c>',
    '<c s="1"/>',
    '<c t="inlineStr"><v>z</v></c>',
]
OTHER_CELLS = [
    '<c t="inlineStr"><is><t>a &amp; b&#233;</t></is></c>',
    '<c t="inlineStr"><is><r><t>x</t></r><r><t>y</t></r></is></c>',
    '<c t="inlineStr"><is><t><![CDATA[</row><row>]]></t></is></c>',
    "<c r='B1' t='str'><v>q</v></c>",
    '<c><f>A1</f><v>1E3</v></c>',
    '<c t="str"><v>a\r\nb > c</v></c>',
    "<!-- <row><c><v>1</v></c></row> -->",
    '<x:c t="str"><x:v>k</x:v></x:c>',
    "<c><v>&u;</v></c>",
    "\n ",
]


def _sheet(rng, cells):
    head = rng.choice(["", '<?xml version="1.0" encoding="UTF-8"?>', "\ufeff"])
    body = "".join(
        rng.choice(["", "", '<row r="7"/>'])
        + rng.choice(["<row>", '<row r="1" spans="1:8">'])
        + "".join(rng.choice(cells) for _ in range(rng.randrange(5)))
        + "</row>"
        for _ in range(rng.randrange(5))
    )
    return f'{head}<worksheet xmlns="{MAIN}" xmlns:x="u"><sheetData>{body}</sheetData><rowBreaks/></worksheet>'.encode()


class _Book:
    def __init__(self, part):
        self.part = part

    def open(self, _):
        return io.BytesIO(self.part)


def _rows_or_error(rows):
    try:
        return list(rows)
    except ElementTree.ParseError:
        return "unreadable"


def test_sheets_of_any_form_read_as_the_parser_does(monkeypatch):
    rng, shared = random.Random(3), ["s0", "s1"]
    for n in range(2000):
        part = _sheet(rng, PLAIN_CELLS + OTHER_CELLS if n % 2 else PLAIN_CELLS)
        monkeypatch.setattr(workbook, "_PART_BYTES", rng.choice([90, 1 << 20]))
        parsed = _rows_or_error(workbook._parsed_rows(io.BytesIO(part), shared))
        assert _rows_or_error(workbook._part_rows(_Book(part), "p", shared)) == parsed, part


def test_plain_rows_are_not_parsed(monkeypatch):
    rng, shared = random.Random(4), ["s0", "s1"]
    parts = [_sheet(rng, PLAIN_CELLS) for _ in range(50)]
    found = [list(workbook._parsed_rows(io.BytesIO(p), shared)) for p in parts]
    monkeypatch.setattr(workbook, "_row_cells", lambda row, shared: [] if len(row) == 0 else pytest.fail("parsed"))
    assert [list(workbook._part_rows(_Book(p), "p", shared)) for p in parts] == found


def test_rows_made_by_columns_are_those_made_one_by_one():
    rng, texts = random.Random(5), [None, "", "a&b<c>d", "&amp;", "007", "12", " x ", "1,50", "é"]
    columns = [[rng.choice(texts) for _ in range(300)] for _ in range(8)]
    made = files._rows([pa.chunked_array([pa.array(c, pa.string())]) for c in columns], 2, {5})
    columns[5] = [int(q) if q and q.isdigit() else q for q in columns[5]]
    assert made == [files._row(n, list(row)) for n, row in enumerate(zip(*columns, strict=True), 2)]


def test_owner_is_found_once_per_file(spark, tmp_path):
    (tmp_path / "ana-movimentacao-2024.xlsx").write_bytes(workbook_bytes([("S", [["h"], ["a"]])]))
    cells = reports.report_cells(spark, str(tmp_path), reports.latest_reports(spark, str(tmp_path)))
    assert rows_of(cells, "taxpayer_id", "report", "ref_year", "cells") == [("ana", "movimentacao", 2024, [c]) for c in ("a", "h")]
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract" not in plan[: plan.index("MapInArrow")]


def test_newest_report_per_taxpayer_and_year(spark, tmp_path):
    book = workbook_bytes([("S", [["h"]])])
    for name, time in [
        ("ana-movimentacao-2024-old.xlsx", 1),
        ("ana-movimentacao-2024-new.xlsx", 2),
        ("ana-movimentacao-2023.xlsx", 3),
        ("ana-b-movimentacao-2024.xlsx", 1),
        ("other.xlsx", 9),
    ]:
        (tmp_path / name).write_bytes(book)
        os.utime(tmp_path / name, (1_700_000_000 + time, 1_700_000_000 + time))
    files = reports.with_owner(reports.binary_files(spark, str(tmp_path)))
    latest = reports.latest_files(files.drop("content")).withColumn("name", F.substring_index("path", "/", -1))
    assert rows_of(latest, "taxpayer_id", "ref_year", "name") == [
        ("ana", 2023, "ana-movimentacao-2023.xlsx"),
        ("ana", 2024, "ana-movimentacao-2024-new.xlsx"),
        ("ana-b", 2024, "ana-b-movimentacao-2024.xlsx"),
    ]
    chosen = reports.latest_reports(spark, str(tmp_path))
    assert chosen.count() == 3
    cells = reports.report_cells(spark, str(tmp_path), chosen)
    assert rows_of(cells, "taxpayer_id", "ref_year", "cells") == [("ana", 2023, ["h"]), ("ana", 2024, ["h"]), ("ana-b", 2024, ["h"])]
    with pytest.raises(FileNotFoundError, match="ana has only"):
        reports.latest_reports(spark, str(tmp_path), 2024)


def test_tasks_open_workbooks_or_spark_scans_them(spark, tmp_path, monkeypatch):
    names = ["ana-movimentacao-2024 [a]{1}*.xlsx", "bia é-negociacao-2024%20.xlsx", "cid-negociacao-2024-old.xlsx", "cid-negociacao-2024.xlsx"]
    for n, name in enumerate(names):
        (tmp_path / name).write_bytes(workbook_bytes([("S", [[name]])]))
        os.utime(tmp_path / name, (1_700_000_000 + n, 1_700_000_000 + n))
    folder = f"file://{tmp_path}"
    chosen = reports.latest_reports(spark, folder)
    opened = reports.report_cells(spark, folder, chosen)
    plan = opened._jdf.queryExecution().executedPlan().toString()
    # Only names are dealt out; the scan reads no contents.
    assert plan.count("Exchange") <= 3 and "content#" not in plan
    found = [r[0][0] for r in rows_of(opened, "cells")]
    assert found == sorted([names[0], names[1], names[3]])
    monkeypatch.setattr(reports, "opened_by_tasks", lambda path: False)
    assert [r[0][0] for r in rows_of(reports.report_cells(spark, folder, chosen), "cells")] == found


def test_stores_that_tasks_open():
    assert opened_by_tasks("/a/b") and opened_by_tasks("file:/a/b") and opened_by_tasks("file:///a/b")
    assert not opened_by_tasks("viewfs://x/a")
    assert store_of("file:/a b/c%20d")[1] == store_of("file:///a b/c%20d")[1] == "/a b/c%20d"


def test_folder_without_reports_is_an_error(spark, tmp_path):
    (tmp_path / "other.xlsx").write_bytes(b"")
    with pytest.raises(FileNotFoundError):
        reports.latest_reports(spark, str(tmp_path))


def test_equal_times_are_decided_by_path(frame):
    now = datetime(2024, 1, 1)
    rows = [("/b/ana-negociacao-2024-b.xlsx", now), ("/a/ana-negociacao-2024-a.xlsx", now)]
    latest = reports.latest_files(reports.with_owner(frame(rows, "path string, modificationTime timestamp")))
    assert rows_of(latest, "path") == [("/a/ana-negociacao-2024-a.xlsx",)]


def _dump(n: int, mark: str) -> str:
    lines = ["SET x;", "COPY public.posicao_acoes (id, produto, instituicao) FROM stdin;"]
    lines += [f"{mark}{i}\tA{i} - X\\tY\t{'-' if i % 2 else 'B-1'}" for i in range(n)]
    lines += ["COPY other.thing (a) FROM stdin;", "\\.", "loose line"]
    lines += ["COPY unknown (a) FROM stdin;", "gone\t-", "\\."]
    lines += ["COPY public.posicao_acoes (id, produto, instituicao) FROM stdin;", "again\tA\tB", "\\."]
    lines += ["COPY proventos_recebidos (id, produto, tipo_evento, valor_liquido, data_pregao) FROM stdin;"]
    lines += [f"{mark}e{i}\tP\tT\t{i}.50\t{d}" for i, d in enumerate(["03/02/2024", "2024-02-04", "\\N"])]
    return "\n".join([*lines, "\\.", "SELECT 1;", ""])


@pytest.mark.parametrize("split_bytes", [134217728, 700])
def test_legacy_dump(spark, tmp_path, split_bytes):
    """Blocks are followed across file splits of any size."""
    for mark in "ab":
        (tmp_path / f"{mark}.sql").write_text(_dump(200, mark))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = legacy_dump.dump_rows(spark, str(tmp_path))
        owner = F.regexp_extract("path", r"(\w)\.sql", 1)
        held = legacy_dump.legacy_table(rows, TABLES["b3_posicao_acoes"], owner)
        got = rows_of(held, "taxpayer_id", "id", "produto", "instituicao", "quantidade")
        expected = [
            (m, f"{m}{i}", f"A{i} - X\tY", None if i % 2 else "B-1", None) for m in "ab" for i in range(200)
        ]
        assert got == sorted(expected, key=repr)
        events = legacy_dump.legacy_table(rows, TABLES["b3_proventos_recebidos"], owner)
        dates = [str(r[2]) for r in rows_of(events, "taxpayer_id", "id", "data_pregao")]
        assert sorted(dates) == ["2024-02-03", "2024-02-03", "2024-02-04", "2024-02-04", "None", "None"]
        assert rows.select("table_name").distinct().count() == 2
        if split_bytes < 1000:
            assert legacy_dump.dump_lines(spark, str(tmp_path)).select("path", "split").distinct().count() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_empty_first_block_still_counts_as_the_first(spark, tmp_path):
    text = "\n".join(
        [
            "COPY public.movimentacao (pk_movimentacao) FROM stdin;",
            "\\.",
            "COPY public.movimentacao (pk_movimentacao) FROM stdin;",
            "late",
            "\\.",
        ]
    )
    (tmp_path / "d.sql").write_text(text)
    assert legacy_dump.dump_rows(spark, str(tmp_path)).count() == 0


def test_copy_escapes(frame):
    df = frame([("a\\tb",), ("\\\\N",), ("\\N",), ("x\\\\ny",)], "c string")
    assert [r[0] for r in df.select(legacy_dump.unescaped(F.col("c"))).collect()] == ["a\tb", "\\N", None, "x\\ny"]


def _card(title: str, *values: str, h3: str = '<h3 class="t">') -> str:
    inner = "".join(f'<div><strong class="d-block lh-3 fs-3 fw-700">{v}</strong></div>' for v in values)
    return f'<div class="card p-2 p-xs-3">{h3}{title}</h3><div class="x">{inner}</div></div>'


def test_bonus_cards_of_a_page(frame):
    first = ("01/02/2020", " ", "02/02/2020", "03/02/2020", "-", "R$ 1.234,56", "10,00%")
    second = ("01/02/2021", "02/02/2021", "\n03/02/2021 ", "04/02/2021", "R$ 7,5", "0,5%")
    stray = '<div><strong class="d-block lh-3 fs-3 fw-700">stray</strong></div>'
    page = (
        "<html><body><div>"
        + _card("<span>BONIFICAção</span>", *first)
        + stray
        + _card("Dividendos", "no", "no")
        + _card("bonificacao", "no title class", h3="<h3>")
        + '<div class="card"><h3 class="t">Bonificação</h3><strong class="d-block lh-3 fs-3 fw-700">no</strong></div>'
        + _card("Bonificação", *second)
        + stray
        + "</div></body></html>"
    )
    df = frame([("A3", page), ("B3", "<html/>"), ("C3", None)], "ticker string, html string")
    typed = typed_cards(page_cards(df))
    found = [(r[0], r[1], *map(str, r[2:])) for r in sorted(typed.collect())]
    assert found == [
        ("A3", 0, "2020-02-01", "2020-02-02", "2020-02-03", "None", "1234.560000", "0.1", "2020"),
        ("A3", 1, "2021-02-01", "2021-02-02", "2021-02-03", "2021-02-04", "7.500000", "0.005", "2021"),
    ]


def test_one_tenant_is_read_from_its_bucket(spark, table, tmp_path):
    spec = TABLES["b3_proventos_recebidos"]
    rows = [{"taxpayer_id": f"tp{i}", "id": str(i), "produto": "A"} for i in range(30)]
    path = str(tmp_path / "t")
    tables.write_table(table(spec.name, *rows), path, spec)
    mine = tables.read_table(spark, path, spec, "tp7")
    assert rows_of(mine, "taxpayer_id", "id") == [("tp7", "7")]
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(taxpayer_bucket" in plan
    assert "EqualTo(taxpayer_id,tp7)" in plan
    assert tables.read_table(spark, path, spec).count() == 30
    assert tables.read_table(spark, str(tmp_path / "none"), spec).count() == 0


class _Session:
    """What ``scratch_dir`` asks of a session."""

    def __init__(self, master: str, setting: str | None):
        self.conf, self.sparkContext, self.master, self.setting = self, self, master, setting

    def get(self, key, default):
        return self.setting if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.own

    def setCheckpointDir(self, path):
        self.own = path

    own = None


def test_scratch_folder_is_the_clusters():
    assert scratch_dir(_Session("spark://x", "hdfs://shared/"), "a").startswith("hdfs://shared/a-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(_Session("spark://x", None), "a")
    local = _Session("local[2]", None)
    first, second = scratch_dir(local, "a"), scratch_dir(local, "a")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0] == local.own
