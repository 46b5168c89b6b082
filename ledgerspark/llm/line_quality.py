"""Operator 8, quality rules: clean line by line first, then reject documents that lost too much text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.words import text_bytes

SYMBOLS = b"#*$%&|<>"
#: Lower-case phrases of page furniture.
BOILERPLATE = (
    "accept cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "terms of use",
)
WINDOW = 8


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules, each as a share in percent, and of the document rules."""

    #: Punctuation: symbols of ``#*$%&|<>`` for 100 characters in words.
    symbol_percent: int = 10
    #: Punctuation: exclamation marks for 100 words.
    shout_percent: int = 100
    #: Punctuation: a line without any of ``. ! ? : ; , "`` of at least so many words.
    unbroken_words: int = 200
    #: Boilerplate: words equal to the word before, for 100 words.
    stutter_percent: int = 40
    #: Navigation: words that are a lone ``|``, for 100 words.
    bar_percent: int = 20
    #: A document goes if the characters in words of failing lines are over so many of 100.
    lost_percent: int = 50
    min_words: int = 20
    repeat_percent: int = 30


def line_fails(line: bytes, words: list[bytes], rules: LineRules) -> str | None:
    """Name of the first rule that a line with words breaks."""
    n, chars = len(words), sum(map(len, words))
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    if 100 * symbols > rules.symbol_percent * chars and 100 * words.count(b"|") < rules.bar_percent * n:
        return "punctuation"
    if 100 * line.count(b"!") > rules.shout_percent * n:
        return "punctuation"
    if 100 * words.count(b"|") >= rules.bar_percent * n:
        return "navigation"
    if n >= rules.unbroken_words and len(line.translate(None, b'.!?:;,"')) == len(line):
        return "punctuation"
    if 100 * sum(map(eq, words, words[1:])) > rules.stutter_percent * n:
        return "boilerplate"
    lower = line.lower()
    if any(phrase.encode() in lower for phrase in BOILERPLATE):
        return "boilerplate"
    return None


def repeated_window_words(words: list[bytes], k: int = WINDOW) -> int:
    """Words inside windows of ``k`` words that occur twice or more in the text.

    Windows are compared by exact ranks: pairs of words, then pairs of pairs, and so on (``k`` is a power of two).
    """
    n = len(words) - k + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    width = 1
    while width < k:
        pairs = rank[:-width] * (len(words) + 1) + rank[width:]
        order = np.argsort(pairs, kind="stable")
        ordered = pairs[order]
        new = np.empty(len(ordered), np.int64)
        new[0] = 0
        np.cumsum(ordered[1:] != ordered[:-1], out=new[1:])
        if new[-1] == len(ordered) - 1:
            return 0
        rank = np.empty_like(new)
        rank[order] = new
        width *= 2
    again = np.bincount(rank)[rank] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + k, -1)
    return int(np.count_nonzero(np.cumsum(cover[:-1])))


@dataclass
class Judged:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lost_chars: int
    base_failed: bool
    kept: bool
    cleaned: bytes


def judge(text: bytes | None, rules: LineRules) -> Judged:
    """All figures of one text; null is a text without words, which fails the base rule."""
    text = text or b""
    words, code_points = text.split(), text.translate(None, bytes(range(0x80, 0xC0)))
    n_words = len(words)
    word_chars = len(code_points.translate(None, b" \t\n\x0b\x0c\r"))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    earlier: set[bytes] = set()
    n_dup, lost, total, kept_lines, changed = 0, 0, 0, [], False
    for line in text.split(b"\n"):
        line_words = line.split()
        if not line_words:
            kept_lines.append(line)
            continue
        n_dup += line in earlier
        earlier.add(line)
        chars = sum(map(len, line_words))
        total += chars
        if line_fails(line, line_words, rules):
            lost += chars
            changed = True
        else:
            kept_lines.append(line)
    n_repeat = repeated_window_words(words)
    base_failed = n_words < rules.min_words or 100 * n_repeat > rules.repeat_percent * n_words
    kept = not base_failed and 100 * lost <= rules.lost_percent * total
    cleaned = b"\n".join(kept_lines) if changed else text
    return Judged(n_words, word_chars, n_symbols, n_dup, n_repeat, lost, base_failed, kept, cleaned)


#: Columns that ``clean_lines`` adds, with their types.
FIGURES = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "lost_chars": pa.int64(),
    "base_failed": pa.bool_(),
    "kept": pa.bool_(),
}
_SPARK = {pa.int64(): T.LongType(), pa.bool_(): T.BooleanType()}


def _clean(batches: Iterator[pa.RecordBatch], rules: LineRules, text: str, names: dict[str, str]):
    for batch in batches:
        found = [judge(t, rules) for t in text_bytes(batch.column(text))]
        columns, fields = list(batch.columns), list(batch.schema.names)
        for figure, kind in FIGURES.items():
            columns.append(pa.array([getattr(f, figure) for f in found], kind))
            fields.append(names[figure])
        columns.append(pa.array([f.cleaned for f in found], pa.binary()).cast(pa.string()))
        fields.append(names["cleaned"])
        yield pa.RecordBatch.from_arrays(columns, fields)


def clean_lines(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the figures of ``FIGURES`` and ``cleaned``, the text without its failing lines.

    A line with words fails by too many symbols or exclamation marks or by no punctuation at all
    (punctuation), by lone bars between its words (navigation), by a phrase of ``BOILERPLATE`` or by
    words that repeat the word before (boilerplate). Lines
    without words always stay. A document is kept if it passes the base rule and its failing lines hold at
    most ``lost_percent`` of its characters in words. Every text is judged whole and alone, without a
    shuffle. A null text counts as empty: no words, so it fails the base rule. Repeated rows and ties are
    judged alike; an empty table gives an empty table; other columns stay as they are. A column of the same
    name as a figure needs a ``prefix`` for the new ones, else it is replaced.
    """
    names = {figure: prefix + figure for figure in [*FIGURES, "cleaned"]}
    held = docs.drop(*[n for n in names.values() if n != text])
    schema = T.StructType(
        [*held.schema.fields]
        + [T.StructField(names[f], _SPARK[kind]) for f, kind in FIGURES.items()]
        + [T.StructField(names["cleaned"], T.StringType())]
    )
    return held.mapInArrow(partial(_clean, rules=rules, text=text, names=names), schema)


def reject_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Kept documents with their cleaned text; columns as before. ``n_chars``, where there is one, follows the text."""
    prefix = "_quality_"
    judged = clean_lines(docs, rules, prefix=prefix).where(f"{prefix}kept")
    out = judged.withColumn("text", F.col(f"{prefix}cleaned"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*docs.columns)
