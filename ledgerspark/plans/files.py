"""Report files made from the derived tables: workbooks as bytes and text dumps."""

from __future__ import annotations

import io
import uuid
import zipfile
from functools import reduce
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.fixed_values import SHEET_DATE_FORMAT
from ledgerspark.functions.keys import movement_key
from ledgerspark.plans.derived import Derived
from ledgerspark.schemas import MOVEMENTS, TAXPAYER, table_spec
from ledgerspark.session import scratch_dir

# Rows of one workbook or dump: bounded, whatever the size of a taxpayer.
ROWS_PER_FILE = 20_000
CONTENT_SCHEMA = "path string, content binary"
_ARROW = pa.schema([("path", pa.string()), ("content", pa.binary())])


def workbook_bytes(sheets: list[tuple[str, list[list]]]) -> bytes:
    """A minimal workbook. Numbers become number cells, other values inline texts, None no cell."""
    return _book([(name, "".join(_row(r, row) for r, row in enumerate(rows, 1))) for name, rows in sheets])


def _book(sheets: list[tuple[str, str]], level: int | None = None) -> bytes:
    """A workbook of named sheets, whose rows are XML already."""
    head = '<?xml version="1.0" encoding="UTF-8"?>'
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    names, links = "", ""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=level) as book:
        for n, (name, data) in enumerate(sheets, 1):
            names += f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>'
            links += f'<Relationship Id="rId{n}" Type="{office}/worksheet" Target="worksheets/sheet{n}.xml"/>'
            part = f'{head}<worksheet xmlns="{main}"><sheetData>{data}</sheetData></worksheet>'
            book.writestr(f"xl/worksheets/sheet{n}.xml", part)
        workbook = f'{head}<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{names}</sheets></workbook>'
        book.writestr("xl/workbook.xml", workbook)
        relations = f'{head}<Relationships xmlns="{package}">{links}</Relationships>'
        book.writestr("xl/_rels/workbook.xml.rels", relations)
    return out.getvalue()


def _row(number: int, row: list) -> str:
    return f'<row r="{number}">{"".join(_cell(number, c, v) for c, v in enumerate(row))}</row>'


def _cell(row: int, column: int, value) -> str:
    if value is None:
        return ""
    name = f"{chr(ord('A') + column)}{row}"
    if isinstance(value, (int, float)):
        return f'<c r="{name}"><v>{value}</v></c>'
    return f'<c r="{name}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def movement_workbooks(d: Derived) -> DataFrame:
    """Movement reports of all taxpayers as ``(path, content)``, a bounded number of rows in each."""
    raw = d.raw_movements(_file_number())
    # A year per file: only the newest file of a taxpayer and year is imported.
    name = F.format_string(f"/reports/%s-{MOVEMENTS}-%04d.xlsx", F.col(TAXPAYER), F.col("file_no") % 7000 + 2001)
    placed = raw.select(name.alias("path"), *[f"c{i}" for i in range(8)])
    return placed.groupBy("path").applyInArrow(_write_workbook, CONTENT_SCHEMA)


def _file_number() -> Column:
    return F.floor(F.col("o_orderkey") / ROWS_PER_FILE).alias("file_no")


def _write_workbook(table: pa.Table) -> pa.Table:
    header = _row(1, table_spec("b3_movimentacao").column_names)
    # Quantities are stored as numbers, the rest as the texts they are.
    rows = _rows([table.column(f"c{i}") for i in range(8)], first=2, numbers={5})
    # Files that are read a few times: the fastest level.
    content = _book([("Movimentação", header + "".join(rows))], level=1)
    return pa.table({"path": table.column("path")[:1], "content": [content]}, schema=_ARROW)


def _rows(columns: list[pa.ChunkedArray], first: int, numbers: set[int]) -> list[str]:
    """The same as ``_row`` of every row, by whole columns; digits in the columns ``numbers`` become number cells."""
    names = pc.cast(pa.array(range(first, first + len(columns[0]))), pa.string())
    cells = []
    for c, column in enumerate(columns):
        texts = column.combine_chunks()
        start = pc.binary_join_element_wise(f'<c r="{chr(ord("A") + c)}', names, "")
        escaped = texts
        for mark, entity in (("&", "&amp;"), (">", "&gt;"), ("<", "&lt;")):
            escaped = pc.replace_substring(escaped, mark, entity)
        inline = '" t="inlineStr"><is><t xml:space="preserve">'
        cell = pc.binary_join_element_wise(start, inline, escaped, "</t></is></c>", "")
        if c in numbers:
            digits = pc.match_substring_regex(texts, "^[0-9]+$")
            value = pc.cast(pc.cast(pc.if_else(digits, texts, None), pa.int64()), pa.string())
            cell = pc.coalesce(pc.binary_join_element_wise(start, '"><v>', value, "</v></c>", ""), cell)
        cells.append(pc.fill_null(cell, ""))
    return pc.binary_join_element_wise('<row r="', names, '">', *cells, "</row>", "").to_pylist()


def write_contents(contents: DataFrame, folder: str) -> None:
    """Files of ``(path, content)`` rows, by their last name, in a folder that all executors share."""

    def write(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            names = [p.rpartition("/")[2] for p in batch.column("path").to_pylist()]
            for name, content in zip(names, batch.column("content"), strict=True):
                # Written aside and then moved, so a repeated task leaves one whole file.
                aside = f"{root}/_{name}-{uuid.uuid4().hex}"
                with store.open_output_stream(aside) as out:
                    out.write(content.as_buffer())
                store.move(aside, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"name": names})

    contents.mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()


def write_dumps(d: Derived) -> str:
    """Text dumps of movements and income, a bounded number of rows in each, in a scratch folder.

    Each dump also has a table that is not imported and a second block of movements.
    """
    number, key = _file_number(), F.col("o_orderkey").alias("line")
    movements = d.movements_with(number, key).withColumn("pk_movimentacao", movement_key())
    # A dash stands for a missing broker in the old database.
    broker = F.when(F.col("quantidade") == 3, "-").otherwise(F.col("instituicao"))
    moved = movements.withColumn("instituicao", broker)
    columns = {
        "movimentacao": ["pk_movimentacao", *table_spec("b3_movimentacao").column_names],
        "proventos_recebidos": ["id", *table_spec("b3_proventos_recebidos").column_names],
    }
    blocks = [
        _data_lines(moved, columns["movimentacao"], 1),
        _data_lines(d.received_with(number, key), columns["proventos_recebidos"], 4),
        _frame_lines(movements.select(TAXPAYER, "file_no").distinct(), columns),
    ]
    order = [TAXPAYER, "file_no", "block", "line"]
    lines = reduce(DataFrame.unionByName, blocks)
    # Partition columns that cannot be null let the writer rely on this sort.
    lines = lines.withColumns(
        {TAXPAYER: F.coalesce(TAXPAYER, F.lit("")), "file_no": F.coalesce("file_no", F.lit(0))}
    )
    path = scratch_dir(d.spark, "dumps")
    (
        lines.repartition(*order[:2])
        .sortWithinPartitions(*order)
        .select(*order[:2], "value")
        .write.partitionBy(*order[:2])
        .text(path)
    )
    return path


def _data_lines(rows: DataFrame, columns: list[str], block: int) -> DataFrame:
    cells = [
        F.date_format(c, SHEET_DATE_FORMAT) if c == "data_pregao" else F.col(c).cast("string")
        for c in columns
    ]
    return rows.select(
        TAXPAYER,
        "file_no",
        F.lit(block).alias("block"),
        "line",
        F.concat_ws("\t", *[F.coalesce(c, F.lit("\\N")) for c in cells]).alias("value"),
    )


def _frame_lines(dumps: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """Lines around the data: preamble, block headers and ends, and the blocks to be ignored."""
    movements, income = (", ".join(c) for c in columns.values())
    first, last = -1, (1 << 62)
    frame = [
        (0, 0, "SET statement_timeout = 0;"),
        (1, first, f"COPY public.movimentacao ({movements}) FROM stdin;"),
        (1, last, "\\."),
        (2, 0, "COPY public.other_table (a, b) FROM stdin;"),
        (2, 1, "1\tnot imported"),
        (2, 2, "\\."),
        (3, 0, f"COPY public.movimentacao ({movements}) FROM stdin;"),
        (3, 1, "second block\t-"),
        (3, 2, "\\."),
        (4, first, f"COPY public.proventos_recebidos ({income}) FROM stdin;"),
        (4, last, "\\."),
        (5, 0, "SELECT 1;"),
    ]
    parts = F.array(
        *[
            F.struct(F.lit(b).alias("block"), F.lit(n).cast("long").alias("line"), F.lit(t).alias("value"))
            for b, n, t in frame
        ]
    )
    return dumps.select(TAXPAYER, "file_no", F.inline(parts))
