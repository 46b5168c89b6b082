"""Sheet cells of many workbooks in parallel, one workbook per task step.

Tasks open workbooks by their paths, so only names and sizes are dealt out, never contents. Workbooks are zip archives of XML that no Spark reader opens, so this is the one Python step. A
worksheet has at most 1 048 576 rows; rows are streamed out in batches as they are read.
"""

from __future__ import annotations

import codecs
import io
import math
import posixpath
import re
import zipfile
from collections.abc import Iterator
from decimal import Decimal
from functools import lru_cache
from itertools import islice
from typing import IO
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS_SCHEMA = "path string, sheet_no int, sheet string, row_idx int, cells array<string>"
_ROWS_PER_BATCH = 5000
#: Bytes of workbooks that one task opens, one after the other.
TASK_BYTES = 16 << 20
_PART_BYTES = 1 << 20
_COLUMNS = list("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
# Rows and cells as spreadsheet programs write them. Text that holds a mark, an entity or a control character is left
# to the parser, as is any other form.
_ROW_START = re.compile(r"<row[\s/>]")
_ROW = re.compile(r"<row(?: [^<>]*[^<>/])?>")
_EMPTY_ROW = re.compile(r"<row(?: [^<>]*)?/>")
_PLAIN = r"([^<>&\r\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]*+)"
# Nothing is tried twice: after each part comes another character.
_CELL = re.compile(
    r'(<c(?: r="([A-Z]++)[0-9]++")?+(?: s="[0-9]++")?+(?: t="([A-Za-z]++)")?+'
    rf'(?:/>|>(?:<(v)>{_PLAIN}</v>|<is><t(?: xml:space="preserve")?+>{_PLAIN}</t></is>)?+</c>))'
)
_UTF_8 = re.compile(rb"""(?:\xef\xbb\xbf)?(?:<\?xml(?:(?!encoding)[^>])*(?:encoding=["'](?i:utf-8)["'][^>]*)?\?>)?\s*<(?!\?)""")
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("sheet_no", pa.int32()),
        ("sheet", pa.string()),
        ("row_idx", pa.int32()),
        ("cells", pa.list_(pa.string())),
    ]
)


def workbook_cells(files: DataFrame) -> DataFrame:
    """Rows of all sheets of ``files``, which has ``path`` and ``content`` like a binary file scan.

    Every cell is text as a Brazilian sheet prints it: a stored number gets a decimal comma. Rows
    are padded to the width of their sheet's header.
    """
    return files.select("path", "content").mapInArrow(_read_batches, CELLS_SCHEMA)


def workbook_cells_at(files: DataFrame) -> DataFrame:
    """The same for ``files`` with ``path`` and ``length``: each task opens the workbooks dealt to it.

    There are as many tasks as the bytes need, and no fewer than cores while there are files for them. Further columns
    of a file are given to all its rows.
    """
    size, count = files.agg(F.sum("length"), F.count(F.lit(1))).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(math.ceil((size or 0) / TASK_BYTES), min(count, cores), 1)
    dealt = files.drop("length").repartition(tasks, "path")
    more = [f for f in dealt.schema if f.name != "path"]
    schema = ", ".join([CELLS_SCHEMA, *[f"`{f.name}` {f.dataType.simpleString()}" for f in more]])
    return dealt.select("path", *[f.name for f in more]).mapInArrow(_open_batches, schema)


def opened_by_tasks(path: str) -> bool:
    """Whether tasks can open files below a path; other stores are left to Spark's reader."""
    try:
        store_of(path)
    except (pa.ArrowInvalid, ImportError, OSError):
        return False
    return True


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """File system and name there of a path as Spark writes it, such as ``file:/a``, ``hdfs://h/a`` or ``/a``."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _open_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n, path in enumerate(batch.column("path").to_pylist()):
            store, name = store_of(path)
            with store.open_input_stream(name) as stream:
                content = stream.read()
            for rows in _workbook_batches(path, content):
                more = [pa.repeat(column[n], rows.num_rows) for column in batch.columns[1:]]
                names = [*_ARROW.names, *batch.schema.names[1:]]
                yield pa.RecordBatch.from_arrays([*rows.columns, *more], names)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            yield from _workbook_batches(path.as_py(), content.as_py())


def _workbook_batches(path: str, content: bytes) -> Iterator[pa.RecordBatch]:
    rows = []
    for sheet_no, sheet, row_idx, cells in _sheet_rows(content):
        rows.append((path, sheet_no, sheet, row_idx, cells))
        if len(rows) == _ROWS_PER_BATCH:
            yield _arrow_batch(rows)
            rows = []
    if rows:
        yield _arrow_batch(rows)


def _arrow_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _children(root: ElementTree.Element, name: str) -> Iterator[ElementTree.Element]:
    """Elements of a name in any namespace; writers differ in the namespace they use."""
    return (e for e in root.iter() if e.tag.endswith("}" + name))


def _texts(element: ElementTree.Element, space: str) -> str:
    return "".join([t.text or "" for t in element.iter(space + "t")])


def _sheet_rows(content: bytes) -> Iterator[tuple[int, str, int, list[str | None]]]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_texts(book)
        for sheet_no, (sheet, part) in enumerate(_sheet_parts(book)):
            width = 0
            for row_idx, found in enumerate(_part_rows(book, part, shared)):
                # Formatted but empty cells at the end of a row are not columns.
                while len(found) > width and found[-1] is None:
                    found.pop()
                width = width or len(found)
                yield sheet_no, sheet, row_idx, found + [None] * (width - len(found))


def _sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    targets = {
        e.get("Id"): e.get("Target") for e in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    parts = []
    for e in _children(ElementTree.fromstring(book.read("xl/workbook.xml")), "sheet"):
        link = next(v for k, v in e.attrib.items() if k.endswith("}id"))
        parts.append((e.get("name"), posixpath.normpath(posixpath.join("/xl", targets[link]))[1:]))
    return parts


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return [_texts(si, si.tag.removesuffix("si")) for si in root]


def _part_rows(book: zipfile.ZipFile, part: str, shared: list[str]) -> Iterator[list[str | None]]:
    """Rows of a sheet, in order.

    Plain rows are cut out by an expression, in less than half the time of the parser. What surrounds them is parsed, and
    from the first row on that neither the expression nor the parser can read alone, the whole sheet is.
    """
    done = 0
    try:
        for cells in _cut_rows(book, part, shared):
            yield cells
            done += 1
    except ElementTree.ParseError:
        with book.open(part) as stream:
            yield from islice(_parsed_rows(stream, shared), done, None)


def _cut_rows(book: zipfile.ZipFile, part: str, shared: list[str]) -> Iterator[list[str | None]]:
    head, rest = None, ""
    with book.open(part) as stream:
        decoder = codecs.getincrementaldecoder("utf-8")()
        while chunk := stream.read(_PART_BYTES):
            if not rest and head is None and not _UTF_8.match(chunk):
                raise ElementTree.ParseError("not known to be UTF-8")
            rest += decoder.decode(chunk)
            if head is None and (first := _ROW_START.search(rest)):
                head, rest = rest[: first.start()], rest[first.start() :]
                # Comments, CDATA and entities of its own are for the parser, prefixes too.
                if "<!" in head or ' xmlns="' not in head:
                    raise ElementTree.ParseError("not a plain sheet")
            if head is not None:
                *rows, rest = rest.split("</row>")
                for row in rows:
                    yield from _cut_row(row, shared)
    around = (head or "") + rest + decoder.decode(b"", True)
    yield from _parsed_rows(io.BytesIO(around.removeprefix("\ufeff").encode()), shared)


def _cut_row(row: str, shared: list[str]) -> Iterator[list[str | None]]:
    """Cells of one row, given without its end mark, after those of empty rows before it."""
    start = 0
    while empty := _EMPTY_ROW.match(row, start):
        yield []
        start = empty.end()
    opened = _ROW.match(row, start)
    if opened is None:
        raise ElementTree.ParseError("not a plain row")
    found = _CELL.findall(row, opened.end())
    if sum([len(cell[0]) for cell in found]) < len(row) - opened.end():
        yield _row_cells(ElementTree.fromstring(f'<row xmlns="-">{row[opened.end() :]}</row>'), shared)
        return
    texts = [
        text if kind == "inlineStr" else _value_text(kind or "n", value if has_value else None, shared)
        for _, _, kind, has_value, value, text in found
    ]
    letters = [cell[1] for cell in found]
    if letters == _COLUMNS[: len(letters)]:
        yield texts
        return
    cells: list[str | None] = []
    for column, text in zip(letters, texts, strict=True):
        if column:
            cells += [None] * (_column_number(column) - len(cells))
        cells.append(text)
    yield cells


def _parsed_rows(stream: IO[bytes], shared: list[str]) -> Iterator[list[str | None]]:
    for _, row in ElementTree.iterparse(stream):
        if row.tag.endswith("}row"):
            yield _row_cells(row, shared)
            row.clear()


def _row_cells(row: ElementTree.Element, shared: list[str]) -> list[str | None]:
    space = row.tag.removesuffix("row")
    cells: list[str | None] = []
    for cell in row:
        name = cell.get("r")
        if name:
            cells += [None] * (_column_number(name.rstrip("0123456789")) - len(cells))
        cells.append(_cell_text(cell, space, shared))
    return cells


@lru_cache(1 << 10)
def _column_number(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _cell_text(cell: ElementTree.Element, space: str, shared: list[str]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _texts(cell, space)
    return _value_text(kind, cell.findtext(space + "v"), shared)


def _value_text(kind: str, value: str | None, shared: list[str]) -> str | None:
    if value is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "n":
        plain = f"{Decimal(value):f}"
        if "." in plain:
            plain = plain.rstrip("0").rstrip(".")
        return plain.replace(".", ",")
    return value
