"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked ids.

The spans that the tokenizers report are coarse cuts: ``tokenizers`` counts characters, and the tokens of one
multibyte character share its span; ``sentencepiece`` counts bytes (its proto output), and all but the last of a
character's byte-fallback tokens have an empty span. Tokens at such places are cut by their decoded bytes.

Both tokenizers cut before a single space between two words, so a text is cut there first and each different
chunk of a block of documents is aligned once, many chunks as one text. A block is documents of about ``BLOCK_BYTES``; what leaves it is
one row for each linked pair of ids, and per document the chunks it consists of. Counts are added up over the
blocks and joined back by pair, so neither tokens nor links are ever single rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.scratch import written
from ledgerspark.llm.words import text_slices

TOKENIZERS = "/opt/tokenizers"
#: A block ends with this many bytes of text, characters of new chunks, or documents; slices of a batch stay whole.
BLOCK_BYTES = 16 << 20
CHUNK_CHARS = 3 << 19
BLOCK_DOCS = 100_000
#: Aligned chunks above which a worker keeps only the most used half for its next blocks; only speed depends on it.
KEPT_CHUNKS = 300_000
#: New chunks are encoded together, as a text of about so many characters.
JOINED_CHARS = 1 << 15
#: Before a single space that a word follows, where no blank precedes it. U+2581 is how B writes a space.
_CUT = regex.compile("(?<=[^ ▁])(?= [^\\s᠎\x1c-\x1f▁])")
#: Where it isn't enough to cut at every space.
_UNEVEN = regex.compile("^ | $|▁| [\\s᠎\x1c-\x1f]")
_B_BITS = 17

STAGED = (
    "block bigint, at int, a int, b int, n bigint, key binary, n_a bigint, n_b bigint, n_groups bigint, "
    "n_links bigint, groups string, data binary"
)
_STAGED_ARROW = pa.schema(
    [("block", pa.int64()), ("at", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]
    + [("key", pa.binary())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups", pa.string()), ("data", pa.binary())]
)


@dataclass(frozen=True)
class Aligner:
    """The two vocabularies, as the contents of their files: a byte-level BPE and a sentencepiece model."""

    byte_level: bytes
    pieces: bytes

    @classmethod
    def of(cls, folder: str = TOKENIZERS, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> Aligner:
        """Read on the driver and sent to the workers: two files of a fixed size of about two MB together."""
        with open(f"{folder}/{a}", "rb") as one, open(f"{folder}/{b}", "rb") as other:
            return cls(one.read(), other.read())


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, loaded once per worker."""

    def __init__(self, aligner: Aligner):
        import os

        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_str(aligner.byte_level.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=aligner.pieces)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else b""
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.fallback = np.array([self.b.is_byte(i) for i in range(size)], bool)
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode()
            for p, byte in zip(pieces, self.fallback, strict=True)
        ]
        # No piece may go over the place where texts are cut, and A must split its words there.
        settings = json.loads(aligner.byte_level)
        inner = any("▁" in p.lstrip("▁") for p in pieces)
        self.cuts = not inner and not settings["normalizer"] and settings["pre_tokenizer"]["type"] == "ByteLevel"
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        self.numbers = [str(i) for i in range(max(len(self.a_bytes), size))]
        self.book = Book()

    def chunks(self, raw: bytes | None) -> list[str]:
        """Parts of space+text that both tokenizers encode each by itself; none of bytes that are no UTF-8."""
        try:
            text = (raw or b"").decode()
        except UnicodeDecodeError:
            return []
        if not text:
            return []
        if not self.cuts:
            return [" " + text]
        if _UNEVEN.search(text):
            return _CUT.split(" " + text)
        return [" " + word for word in text.split(" ")]

    def align(self, chunks: list[str]) -> None:
        """Enter new chunks into the book, many of them as one text."""
        lo = size = 0
        for hi, chunk in enumerate(chunks, 1):
            size += len(chunk)
            if size >= JOINED_CHARS or hi == len(chunks):
                self._enter(chunks[lo:hi])
                lo, size = hi, 0

    def _enter(self, chunks: list[str]) -> None:
        text = "".join(chunks)
        raw = text.encode()
        encoded = self.a.encode(text, add_special_tokens=False)
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        a_ids, b_ids = np.array(encoded.ids, np.int64), np.array([p.id for p in pieces], np.int64)
        whole = b"".join([self.a_bytes[i] for i in encoded.ids]) == raw == b"".join([self.b_bytes[i] for i in b_ids.tolist()])
        if whole:
            spans = np.fromiter(chain.from_iterable(encoded.offsets), np.int64, 2 * len(a_ids)).reshape(-1, 2)
            a_cuts = character_cuts(raw, spans)
            bytewise = self.fallback[b_ids]
            inner = np.zeros(len(b_ids), bool)
            inner[bytewise] = [pieces[i].begin == pieces[i].end for i in np.flatnonzero(bytewise).tolist()]
            b_cuts = byte_cuts(np.array([p.end for p in pieces], np.int64), inner)
            a_ends, b_ends = refined(a_cuts, self.a_sizes[a_ids]), refined(b_cuts, self.b_sizes[b_ids])
            bounds = np.cumsum([len(c) if len(raw) == len(text) else len(c.encode()) for c in chunks])
            common = np.intersect1d(a_ends, b_ends, assume_unique=True)
            whole = bool(np.isin(bounds, common, assume_unique=True).all())
        if whole:
            self.book.enter(chunks, *linked(a_ids, b_ids, a_ends, b_ends, common, bounds, self.numbers))
        elif len(chunks) == 1:
            self.book.enter(chunks, [None], [b""], np.zeros((1, 3), np.int64))
        else:
            # Some chunk's tokens don't give its bytes: halves, until it is found.
            self._enter(chunks[: len(chunks) // 2])
            self._enter(chunks[len(chunks) // 2 :])


class Book:
    """Aligned chunks of a worker: the place of each, and by place its groups, pair codes, counts and uses."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.groups: list[str | None] = []
        self.codes: list[bytes] = []
        self.counts = np.zeros((1 << 12, 3), np.int64)

    def enter(self, chunks: list[str], groups: list[str | None], codes: list[bytes], counts: np.ndarray) -> None:
        at, to = len(self.groups), len(self.groups) + len(chunks)
        self.place.update(zip(chunks, range(at, to)))
        self.groups += groups
        self.codes += codes
        while to > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        self.counts[at:to] = counts

    def keep(self, uses: np.ndarray) -> None:
        """Only the most used chunks stay for the next block."""
        if len(self.groups) <= KEPT_CHUNKS:
            return
        stay = np.zeros(len(self.groups), bool)
        stay[np.argpartition(-uses, KEPT_CHUNKS // 2)[: KEPT_CHUNKS // 2]] = True
        old, self.place = self.place, {}
        numbers = np.flatnonzero(stay)
        self.groups, self.codes = ([x[i] for i in numbers.tolist()] for x in (self.groups, self.codes))
        self.counts = self.counts[numbers]
        new = np.cumsum(stay) - 1
        self.place = {c: int(new[i]) for c, i in old.items() if stay[i]}


def character_cuts(raw: bytes, offsets: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from character spans; -1 for a token that ends inside a character."""
    data = np.frombuffer(raw, np.uint8)
    places = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    starts = np.append(offsets[1:, 0], len(data))
    return np.where(starts >= offsets[:, 1], places[offsets[:, 1]], -1)


def byte_cuts(ends: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Byte ends of pieces after the added space; -1 for the fallback bytes that don't end their character."""
    return np.where(inner, -1, ends + 1)


def refined(cuts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of all tokens: coarse cuts where there are any, else by the decoded bytes since the last one."""
    steps = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(cuts >= 0, np.arange(len(cuts)), -1))
    since = np.where(last >= 0, cuts[last] - steps[last], 0)
    return since + steps


def linked(
    a_ids: np.ndarray,
    b_ids: np.ndarray,
    a_ends: np.ndarray,
    b_ends: np.ndarray,
    common: np.ndarray,
    bounds: np.ndarray,
    numbers: list[str],
) -> tuple[list[str], list[bytes], np.ndarray]:
    """By chunk: groups as ``a1,a2|b1;a3|b2``, codes of all overlapping pairs as int64, and how many tokens and groups.

    Between two neighbouring cuts, of whichever side, lies exactly one pair of overlapping tokens.
    """
    cuts = np.union1d(a_ends, b_ends)
    codes = (a_ids[np.searchsorted(a_ends, cuts)] << _B_BITS | b_ids[np.searchsorted(b_ends, cuts)]).tobytes()
    groups = [np.searchsorted(common, ends) for ends in (a_ends, b_ends)]
    order = np.argsort(np.concatenate([2 * groups[0], 2 * groups[1] + 1]), kind="stable")
    last = np.concatenate([np.isin(ends, common, assume_unique=True) for ends in (a_ends, b_ends)])
    side = np.repeat([0, 1], [len(a_ids), len(b_ids)])
    closing = np.concatenate([np.zeros(len(a_ids), bool), np.isin(b_ends, bounds, assume_unique=True)])
    marks = np.where(last, side + 1, 0) + closing
    ids = np.concatenate([a_ids, b_ids])[order].tolist()
    text = "".join([numbers[i] + ",|;\n"[m] for i, m in zip(ids, marks[order].tolist(), strict=True)])
    to = [np.searchsorted(ends, bounds, "right") for ends in (a_ends, b_ends, common, cuts)]
    counts = np.stack([np.diff(t, prepend=0) for t in to[:3]], axis=1)
    ends = (to[3] * 8).tolist()
    return text.split("\n")[:-1], [codes[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)], counts


@lru_cache(maxsize=1)
def _pair(aligner: Aligner) -> Pair:
    return Pair(aligner)


class Block:
    """Documents whose chunks are counted together."""

    def __init__(self, number: int, pair: Pair):
        self.number, self.pair, self.bytes, self.new = number, pair, 0, 0
        self.keys: list[bytes] = []
        self.groups: list[str] = []
        self.places: list[np.ndarray] = []

    def add(self, keys: list[bytes], texts: list[bytes | None], digest: bool) -> None:
        """Documents of one slice; their new chunks are aligned together."""
        pair, book = self.pair, self.pair.book
        split = [pair.chunks(t) for t in texts]
        new = list(dict.fromkeys(c for parts in split for c in parts if c not in book.place))
        pair.align(new)
        self.new += sum(map(len, new))
        self.bytes += sum(len(t or b"") for t in texts)
        self.keys += keys
        for parts in split:
            places = [book.place[c] for c in parts]
            groups = [book.groups[i] for i in places]
            if not parts or None in groups:
                self.groups.append("")
                self.places.append(np.zeros(0, np.int64))
                continue
            joined = ";".join(groups)
            self.groups.append(hashlib.sha256(joined.encode()).hexdigest() if digest else joined)
            self.places.append(np.array(places, np.int64))

    def full(self) -> bool:
        return self.bytes >= BLOCK_BYTES or self.new >= CHUNK_CHARS or len(self.keys) >= BLOCK_DOCS

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Rows of linked pairs, one row of the block's chunks, and rows of documents."""
        book = self.pair.book
        sizes = np.array([len(p) for p in self.places])
        used = np.concatenate(self.places)
        uses = np.bincount(used, minlength=len(book.groups))
        chunks = np.flatnonzero(uses)
        local = (np.cumsum(uses > 0) - 1).astype("<u4")[used]
        codes = [book.codes[i] for i in chunks.tolist()]
        lengths = np.fromiter((len(c) >> 3 for c in codes), np.int64, len(codes))
        different, place = np.unique(np.frombuffer(b"".join(codes), np.int64), return_inverse=True)
        n = np.bincount(place, np.repeat(uses[chunks], lengths), len(different)).astype(np.int64)
        yield _batch(
            len(different),
            block=np.full(len(different), self.number),
            at=np.arange(len(different), dtype=np.int32),
            a=(different >> _B_BITS).astype(np.int32),
            b=(different & ((1 << _B_BITS) - 1)).astype(np.int32),
            n=n,
        )
        data = len(codes).to_bytes(8, "little") + lengths.astype("<i8").tobytes() + place.astype("<i4").tobytes()
        yield _batch(1, block=[self.number], data=[data])
        ends = np.cumsum(sizes)
        totals = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(book.counts[used], axis=0)])
        n_a, n_b, n_groups = (totals[ends] - totals[ends - sizes]).T
        yield _batch(
            len(self.keys),
            block=np.full(len(self.keys), self.number),
            key=self.keys,
            n_a=n_a,
            n_b=n_b,
            n_groups=n_groups,
            # There are as many links as different cuts, and each common cut ends a group.
            n_links=n_a + n_b - n_groups,
            groups=self.groups,
            data=[_packed(local[end - size : end]) for end, size in zip(ends.tolist(), sizes.tolist(), strict=True)],
        )
        book.keep(uses)


def _packed(places: np.ndarray) -> bytes:
    """Numbers as four planes of bytes, of which the upper ones are mostly zeros and compress well."""
    return np.ascontiguousarray(places).view(np.uint8).reshape(-1, 4).T.tobytes()


def _places(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _batch(size: int, **columns) -> pa.RecordBatch:
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _STAGED_ARROW
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_STAGED_ARROW)


def _staged(aligner: Aligner, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(aligner)
        # The same number when a task is run again, and no other task has it.
        number = TaskContext.get().partitionId() << 24
        block = Block(number, pair)
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                block.add(part.column("key").to_pylist(), texts, digest)
                if block.full():
                    yield from block.rows()
                    number += 1
                    block = Block(number, pair)
        if block.keys:
            yield from block.rows()

    return run


_COUNTED = pa.schema(
    [("key", pa.binary())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups", pa.string())]
)


def _counted(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Documents of a block with the corpus-wide counts of their links."""
    chunks = docs.filter(docs["key"].is_null()).column("data").to_pylist()[0]
    docs = docs.filter(docs["key"].is_valid())
    size = int.from_bytes(chunks[:8], "little")
    lengths = np.frombuffer(chunks, "<i8", size, 8)
    place = np.frombuffer(chunks, "<i4", -1, 8 + 8 * size)
    count = np.zeros(pairs.num_rows, np.int64)
    best = np.zeros(pairs.num_rows, np.int64)
    at = pairs["at"].to_numpy()
    count[at], best[at] = pairs["count"].to_numpy(), pairs["best"].to_numpy()
    ends = np.concatenate([[0], np.cumsum(lengths)])
    # What each chunk adds to its document, from running totals over all chunks' links.
    worth = [np.diff(np.concatenate([[0], np.cumsum(v[place])])[ends]) for v in (count, best)]
    sums = [[int(w[_places(d)].sum()) if d else 0 for d in docs["data"].to_pylist()] for w in worth]
    added = docs.append_column("count_sum", pa.array(sums[0], pa.int64()))
    added = added.append_column("n_best", pa.array(sums[1], pa.int64()))
    return added.select(_COUNTED.names).cast(_COUNTED)


def align_tokenizers(df: DataFrame, key: str = "doc_id", text: str = "text", aligner: Aligner | None = None, digest: bool = False) -> DataFrame:
    """Tokens, groups and linked pairs of every text under both tokenizers.

    A text is encoded without special tokens, by A with a space before it and by B, which adds one. Returns one row
    per row of ``df``: the key, ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best`` links whose pair is
    the most frequent of its B id in all rows (ties included), ``count_sum`` of all its links' counts, and ``groups``
    as ``a1,a2|b1;a3|b2,b3``, or with ``digest`` the SHA-256 of that text.

    Null and empty texts, and those whose tokens don't give back their bytes (B cannot write U+2581; bytes that are
    no UTF-8), have no tokens: zeros and an empty ``groups``. Rows are kept as they are, repeated and null keys too;
    columns other than key and text are not read, so their names don't matter. An empty table gives no rows. A
    worker's memory is bounded by ``BLOCK_BYTES`` and its longest text.
    """
    aligner = aligner or Aligner.of()
    kind = df.schema[key].dataType
    # Keys travel as bytes, with a mark before them, so that a null key is not a null.
    packed = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-")).cast("binary")
    rows = df.select(packed.alias("key"), F.col(text).alias("text"))
    spark = df.sparkSession
    staged = written(spark, rows.mapInArrow(_staged(aligner, digest), STAGED), "aligned")
    pairs = staged.where("at is not null").select("block", "at", "a", "b", "n")
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    # One row for each id of B at most: its vocabulary bounds the broadcast.
    tops = counts.groupBy("b").agg(F.max("count").alias("top"))
    marked = counts.join(F.broadcast(tops), "b").select("a", "b", "count", (F.col("count") == F.col("top")).cast("bigint").alias("best"))
    counted = pairs.join(marked, ["a", "b"]).select("block", "at", "count", "best")
    docs = staged.where("at is null").select(F.col("block").alias("of"), "key", "n_a", "n_b", "n_groups", "n_links", "groups", "data")
    schema = "key binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"
    done = docs.groupBy("of").cogroup(counted.groupBy("block")).applyInArrow(_counted, schema)
    mark = F.col("key").cast("string")
    own = F.when(mark.startswith("="), mark.substr(F.lit(2), F.length(mark))).cast(kind)
    return done.select(own.alias(key), *[F.col(c) for c in done.columns if c != "key"])
