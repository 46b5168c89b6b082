"""Conversations of any layout as canonical turns, and as training text with a loss mask.

A record is a VARIANT. Its fingerprint is the hash of the nested field paths it has, such as ``messages[].role``, among
those that some layout knows; the fingerprint selects a layout, a declaration of where roles and texts are. Records of
different layouts may lie in one table. All of it is built-in functions: no row leaves the JVM.

Formatted text marks every turn; control strings inside roles and texts get a backslash after their first
character, and a backslash is doubled, so that reading back gives exactly the turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How deep field paths go: lists of messages whose contents are lists of parts need five steps.
DEPTH = 5


@dataclass(frozen=True)
class Messages:
    """A list of messages: the list's path, the fields of role and text, other names of roles."""

    at: str
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()
    #: Field of the text's parts, where the text is a list of objects.
    part: str | None = None

    def paths(self) -> tuple[set[str], set[str]]:
        text = f"{self.at}[].{self.text}" + (f"[].{self.part}" if self.part else "")
        return {text}, {f"{self.at}[].{self.role}"}

    def turns(self, record: Column) -> Column:
        kind = f"array<struct<`{self.part}` string>>" if self.part else "string"
        listed = F.try_variant_get(record, f"$.{self.at}", f"array<struct<`{self.role}` string, `{self.text}` {kind}>>")

        def turn(message: Column) -> Column:
            role = message[self.role]
            for old, new in self.roles:
                role = F.when(message[self.role] == old, F.lit(new)).otherwise(role)
            text = message[self.text]
            if self.part:
                text = F.array_join(F.transform(text, lambda p: p[self.part]), "")
            return _turn(role, text)

        return F.transform(listed, turn)


@dataclass(frozen=True)
class Fields:
    """One field or more per turn: (role, paths that are joined by an empty line, without blank ones, optional?)."""

    parts: tuple[tuple[str, tuple[str, ...], bool], ...]
    #: Paths that need not be there.
    optional: tuple[str, ...] = ()

    def paths(self) -> tuple[set[str], set[str]]:
        known = {p for _, paths, _ in self.parts for p in paths}
        return known - set(self.optional), set(self.optional)

    def turns(self, record: Column) -> Column:
        made = []
        for role, paths, may_lack in self.parts:
            values = [F.try_variant_get(record, f"$.{p}", "string") for p in paths]
            filled = F.filter(F.array(*values), lambda v: v.isNotNull() & (F.trim(v) != ""))
            text = F.coalesce(values[0], F.lit("")) if len(values) == 1 else F.array_join(filled, "\n\n")
            made.append(F.when(text == "", None).otherwise(_turn(F.lit(role), text)) if may_lack else _turn(F.lit(role), text))
        return F.filter(F.array(*made), lambda t: t.isNotNull())


@dataclass(frozen=True)
class Rows:
    """One turn per record; records of one key are in the order of ``turn`` (nulls first)."""

    turn: str = "turn"
    role: str = "role"
    text: str = "text"

    def paths(self) -> tuple[set[str], set[str]]:
        return {self.turn, self.role, self.text}, set()

    def turns(self, record: Column) -> Column:
        role, text = (F.try_variant_get(record, f"$.{p}", "string") for p in (self.role, self.text))
        return F.array(_turn(role, text))

    def place(self, record: Column) -> Column:
        return F.try_variant_get(record, f"$.{self.turn}", "bigint")


def _turn(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.struct(F.coalesce(role, empty).alias("role"), F.coalesce(text, empty).alias("text"))


_SPEAKERS = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))
#: Layouts by name.
LAYOUTS: dict[str, Messages | Fields | Rows] = {
    "rows": Rows(),
    "messages": Messages("messages"),
    "message parts": Messages("messages", part="text"),
    "speakers": Messages("conversations", "from", "value", _SPEAKERS),
    "instruction": Fields(
        (("system", ("system",), True), ("user", ("instruction", "input"), False), ("assistant", ("output",), False)),
        optional=("system", "input"),
    ),
    "prompt": Fields((("user", ("prompt",), False), ("assistant", ("completion",), False))),
    "response": Fields((("user", ("prompt",), False), ("assistant", ("response",), False))),
    "question": Fields((("user", ("context", "question"), False), ("assistant", ("answer",), False)), optional=("context",)),
}


def known_paths(layouts: dict) -> set[str]:
    return {p for layout in layouts.values() for paths in layout.paths() for p in paths} | set(_empty_lists(layouts))


def _empty_lists(layouts: dict) -> dict[str, str]:
    """Paths of empty lists of messages, by which such a record is told, and the layout's name."""
    return {f"{layout.at}[]": name for name, layout in reversed(layouts.items()) if isinstance(layout, Messages)}


def fingerprint_of(paths: set[str]) -> str:
    """What ``fingerprint`` gives a record with just these known paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprints(layouts: dict) -> dict[str, str]:
    """Layout name by fingerprint: its required paths with any of the optional ones, or nothing but an empty list."""
    known: dict[str, str] = {}
    for name, layout in layouts.items():
        required, optional = layout.paths()
        for n in range(len(optional) + 1):
            for some in combinations(sorted(optional), n):
                mark = fingerprint_of(required | set(some))
                if known.setdefault(mark, name) != name:
                    raise ValueError(f"layouts {known[mark]} and {name} have the same fields")
    return known | {fingerprint_of({path}): name for path, name in _empty_lists(layouts).items()}


def field_paths(record: Column) -> Column:
    """Paths of a record's fields: ``a``, ``a.b`` in objects, ``a[]`` in lists, where it is empty or of scalars."""

    def below(at: Column, value: Column, depth: int) -> Column:
        if not depth:
            return F.array(at)
        fields = F.try_variant_get(value, "$", "map<string, variant>")
        items = F.try_variant_get(value, "$", "array<variant>")
        named = F.flatten(F.transform(F.map_entries(fields), lambda e: below(F.concat(at, F.lit("."), e["key"]), e["value"], depth - 1)))
        listed = F.concat(at, F.lit("[]"))
        inner = F.array_distinct(F.flatten(F.transform(items, lambda x: below(listed, x, depth - 1))))
        inner = F.when(F.size(items) == 0, F.array(listed)).otherwise(inner)
        return F.when(fields.isNotNull(), named).when(items.isNotNull(), inner).otherwise(F.array(at))

    top = F.map_entries(F.try_variant_get(record, "$", "map<string, variant>"))
    return F.flatten(F.transform(top, lambda e: below(e["key"], e["value"], DEPTH - 1)))


def fingerprint(record: Column, layouts: dict) -> Column:
    """Hash of the record's field paths, of those that are known; null for what is no object."""
    known = F.array(*[F.lit(p) for p in sorted(known_paths(layouts))])
    return F.sha2(F.array_join(F.array_sort(F.array_intersect(field_paths(record), known)), "\n"), 256)


def records_of(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of typed columns as records (key, record)."""
    names = columns or [c for c in df.columns if c != key]
    return df.select(F.col(key), F.to_variant_object(F.struct(*names)).alias("record"))


def json_records(df: DataFrame, key: str, column: str) -> DataFrame:
    """JSON texts as records; a malformed one is null, and so of no layout."""
    return df.select(F.col(key), F.try_parse_json(column).alias("record"))


def canonical_turns(records: DataFrame, key: str, layouts: dict | None = None) -> DataFrame:
    """Every record's key, ``fingerprint``, ``layout``, ``place`` among the key's records, and ``turns`` (role, text).

    A record whose fields fit no layout, or more than one, keeps its fingerprint and has a null layout and null turns.
    A null list of messages has no turns; null roles and texts are empty. An empty table gives no rows.
    """
    layouts = layouts or LAYOUTS
    names = F.create_map(*[F.lit(x) for pair in fingerprints(layouts).items() for x in pair])
    record = F.col("record")
    marked = records.select(F.col(key), "record", fingerprint(record, layouts).alias("fingerprint"))
    chosen = marked.withColumn("layout", F.try_element_at(names, F.col("fingerprint")))
    none = F.array().cast("array<struct<role string, text string>>")
    turns, place = F.lit(None), F.lit(None).cast("bigint")
    for name, layout in layouts.items():
        here = F.col("layout") == name
        turns = F.when(here, F.coalesce(layout.turns(record), none)).otherwise(turns)
        if isinstance(layout, Rows):
            place = F.when(here, layout.place(record)).otherwise(place)
    return chosen.select(F.col(key), "fingerprint", "layout", place.alias("place"), turns.alias("turns"))


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the roles whose texts are learnt, and the strings that texts may not have as they are."""

    begin: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    learnt: tuple[str, ...] = ("assistant",)
    #: Each mark must begin with one of them, and none may begin inside another.
    controls: tuple[str, ...] = field(default=("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))

    def __post_init__(self):
        if not all(mark.startswith(self.controls) for mark in (self.begin, self.middle, self.end)):
            raise ValueError("a mark that texts could contain")

    def _escaped_places(self) -> Iterator[str]:
        yield r"\\"
        for control in self.controls:
            yield re.escape(control[0]) + (f"(?={re.escape(control[1:])})" if control[1:] else "")

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, "(" + "|".join(self._escaped_places()) + ")", r"$1\\")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame, key: str, template: Template = Template()) -> DataFrame:
    """One row per key: ``segments`` (text, loss) whose texts in a row are the formatted conversation, and
    ``n_unmapped``, its records without a layout.

    Records of a key are in the order of place (nulls first), then of their turns; a null key is a key. Only the texts
    of learnt roles are under the loss mask, escaped like all others. A conversation is one row, however long: Spark
    limits it to 2 GB.
    """
    part = F.struct(F.col("place").isNotNull().alias("numbered"), "place", "turns")
    grouped = turns.groupBy(key).agg(
        F.sort_array(F.collect_list(F.when(F.col("turns").isNotNull(), part))).alias("parts"),
        F.count(F.when(F.col("turns").isNull(), 1)).alias("n_unmapped"),
    )
    flat = F.flatten(F.transform("parts", lambda p: p["turns"]))

    def marked(turn: Column) -> Column:
        head = F.concat(F.lit(template.begin), template.escape(turn["role"]), F.lit(template.middle))
        learnt = turn["role"].isin(*template.learnt)
        texts = ((head, F.lit(False)), (template.escape(turn["text"]), learnt), (F.lit(template.end), F.lit(False)))
        return F.array(*[F.struct(text.alias("text"), loss.alias("loss")) for text, loss in texts])

    return grouped.select(key, F.flatten(F.transform(flat, marked)).alias("segments"), "n_unmapped")


def formatted(segments: Column) -> Column:
    """The text of a formatted conversation."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(text: Column, template: Template = Template()) -> Column:
    """Turns of a formatted text, found by their marks."""

    def quoted(mark: str) -> str:
        return re.escape(mark)

    pieces = F.split(text, quoted(template.end))
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        role, body = (F.split_part(piece, F.lit(template.middle), F.lit(n)) for n in (1, 2))
        role = F.substr(role, F.lit(len(template.begin) + 1))
        return F.struct(template.unescape(role).alias("role"), template.unescape(body).alias("text"))

    return F.transform(whole, turn)


def read_learnt(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")
