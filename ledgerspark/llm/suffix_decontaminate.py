"""Operator 2, benchmark decontamination with suffix arrays over shards of the training texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.scratch import written
from ledgerspark.llm.words import LOWER_LETTER_WORDS, Words, rolling, text_slices

WINDOW = 10
#: A benchmark is searched in blocks of about this many bytes; each block is one broadcast.
BLOCK_BYTES = 16 << 20
_HALF = WINDOW // 2


class ShardIndex:
    """Suffix array over the words of one shard: suffixes in the order of their first ``2 * half`` words.

    Words are ordered by their hashes, blocks of ``half`` words by the hashes of these. Only ties of the first
    block are sorted by the second one. Suffixes that would run into the next text are left out.
    """

    def __init__(self, words: Words, half: int = _HALF):
        self.words, self.half = words, half
        self.block = rolling(words.hash, half)
        ends = np.repeat(words.first[1:], words.counts())
        at = np.arange(len(words))
        whole = np.flatnonzero(at + 2 * half <= ends)
        head = self.block[whole]
        order = np.argsort(head, kind="stable")
        self.suffix, self.head = whole[order], head[order]
        tied = np.zeros(len(self.head), bool)
        if len(self.head) > 1:
            same = self.head[1:] == self.head[:-1]
            tied[1:] |= same
            tied[:-1] |= same
        places = np.flatnonzero(tied)
        if len(places):
            tail = self.block[self.suffix[places] + half]
            again = np.lexsort((tail, self.head[places]))
            self.suffix[places] = self.suffix[places[again]]

    def ranges(self, head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each test suffix, given as two blocks, the range of the array that begins with its words."""
        low, high = np.searchsorted(self.head, head, "left"), np.searchsorted(self.head, head, "right")
        for q in np.flatnonzero(high > low):
            tails = self.block[self.suffix[low[q] : high[q]] + self.half]
            low[q], high[q] = (
                low[q] + np.searchsorted(tails, tail[q], "left"),
                low[q] + np.searchsorted(tails, tail[q], "right"),
            )
        return low, high


@dataclass
class TestBlock:
    """Distinct windows of a block of benchmark items, and the items that hold each."""

    #: Words of each window, and the item numbers that hold it.
    windows: list[tuple[bytes, ...]]
    owners: list[list[int]]
    items: list[str | None]

    @staticmethod
    def of(items: list[tuple[str | None, bytes | None]], k: int = WINDOW) -> TestBlock:
        table: dict[tuple[bytes, ...], dict[int, None]] = {}
        for number, (_, text) in enumerate(items):
            words = (text or b"").translate(LOWER_LETTER_WORDS).replace(b"\0", b" ").split(b" ")
            words = [w for w in words if w]
            for i in range(max(1, len(words) - k + 1) if words else 0):
                table.setdefault(tuple(words[i : i + k]), {})[number] = None
        return TestBlock(list(table), [list(v) for v in table.values()], [i for i, _ in items])


class TestIndex:
    """What a task needs to search a block: hashes of full windows, and the short items by their length."""

    def __init__(self, block: TestBlock, k: int = WINDOW):
        self.block = block
        self.full = [n for n, w in enumerate(block.windows) if len(w) == k]
        self.short: dict[int, list[int]] = {}
        for n, w in enumerate(block.windows):
            if len(w) < k:
                self.short.setdefault(len(w), []).append(n)
        hashes = self._hashes(self.full).reshape(-1, k)
        self.head = self._blocks(hashes[:, : k // 2])
        self.tail = self._blocks(hashes[:, k // 2 :])
        self.short_hash = {
            m: self._blocks(self._hashes(ns).reshape(-1, m)) for m, ns in self.short.items()
        }

    def _hashes(self, numbers: list[int]) -> np.ndarray:
        flat = [w for n in numbers for w in self.block.windows[n]]
        return Words([b" ".join(flat)], LOWER_LETTER_WORDS).hash if flat else np.zeros(0, np.uint64)

    @staticmethod
    def _blocks(hashes: np.ndarray) -> np.ndarray:
        n, k = hashes.shape
        return rolling(hashes.reshape(-1), k)[::k] if n else np.zeros(0, np.uint64)


@lru_cache(maxsize=2)
def _test_index(key: str, bytes_of: bytes) -> TestIndex:
    import pickle

    return TestIndex(pickle.loads(bytes_of))


def search(words: Words, index: TestIndex) -> list[tuple[int, int, int]]:
    """(first word, length, window) of every occurrence of a window of the block, verified word by word."""
    found: list[tuple[np.ndarray, int, int]] = []
    if index.full:
        shard = ShardIndex(words)
        low, high = shard.ranges(index.head, index.tail)
        found += [(shard.suffix[low[q] : high[q]], WINDOW, index.full[q]) for q in np.flatnonzero(high > low)]
    ends = np.repeat(words.first[1:], words.counts()) if index.short else None
    for m, numbers in index.short.items():
        grams = rolling(words.hash, m)
        inside = np.arange(len(grams)) + m <= ends[: len(grams)]
        order = np.argsort(index.short_hash[m])
        known = index.short_hash[m][order]
        slot = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        for i in np.flatnonzero(inside & (known[slot] == grams)):
            found.append((np.array([i]), m, numbers[order[slot[i]]]))
    hits = []
    for places, m, window in found:
        expected = index.block.windows[window]
        for i in places.tolist():
            if all(words.word(i + j) == expected[j] for j in range(m)):
                hits.append((i, m, window))
    return hits


_STATE = "array<int>", "array<string>"


def _pass(batches: Iterator[pa.RecordBatch], block: Broadcast, key: str, text: str, names: dict[str, str], first: bool):
    """Add the hits of one block to the state columns: word count, covered spans, items."""
    for whole in batches:
        index = _test_index(key, block.value)
        for batch, texts in text_slices(whole, text):
            words = Words(texts, LOWER_LETTER_WORDS)
            spans: list[list[tuple[int, int]]] = [[] for _ in texts]
            items: list[set] = [set() for _ in texts]
            if not first:
                for n, (old, held) in enumerate(
                    zip(batch.column(names["spans"]).to_pylist(), batch.column(names["items"]).to_pylist(), strict=True)
                ):
                    spans[n] += zip(old[::2], old[1::2], strict=True)
                    items[n].update(held)
            hits = search(words, index)
            owners = np.searchsorted(words.first, [i for i, _, _ in hits], "right") - 1
            for (i, m, window), n in zip(hits, owners.tolist(), strict=True):
                begin = int(i - words.first[n])
                spans[n].append((begin, begin + m))
                items[n].update(index.block.items[o] for o in index.block.owners[window])
            state = {
                names["n_words"]: pa.array(words.counts(), pa.int64()),
                names["spans"]: pa.array([_joined(s) for s in spans], pa.list_(pa.int32())),
                names["items"]: pa.array([sorted(s - {None}) for s in items], pa.list_(pa.string())),
            }
            kept = [c for c in batch.schema.names if c not in state]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + list(state.values()), kept + list(state)
            )


def _joined(spans: list[tuple[int, int]]) -> list[int]:
    """Spans that overlap or touch, put together; begin and end by turns."""
    out: list[int] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """Benchmark items in lists of about ``block_bytes``; only one list is on the driver at a time."""
    held, size = [], 0
    for item_id, content in benchmark.select(F.col(item).cast("string"), F.encode(F.col(text), "UTF-8")).toLocalIterator():
        content = bytes(content) if content is not None else None
        held.append((item_id, content))
        size += len(content or b"")
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    prefix: str = "",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (begin and end word by turns) and ``items`` of verbatim benchmark matches.

    Each slice of an Arrow batch is a shard with a suffix array of its own; every suffix of the benchmark is
    looked up in it by binary search, and every place of the found range is compared word by word. Chains of
    matches are one span, so a span is a longest verbatim passage. The benchmark comes in blocks of a bounded
    size, one broadcast and one pass over the documents each; spans and items are carried from pass to pass
    in the rows, so nothing is shuffled and repeated rows stay apart.

    Null texts and texts without words have no words and no spans; items without words occur nowhere; an item
    with a null id marks words but is not listed. Empty tables give no rows or no spans. Other columns stay; a
    ``prefix`` keeps the new names apart from columns of the same name, which would be replaced.
    """
    import pickle

    spark = docs.sparkSession
    names = {n: prefix + n for n in ("n_words", "spans", "items")}
    state = docs.drop(*[n for n in names.values() if n != text])
    added = [
        T.StructField(names["n_words"], T.LongType()),
        T.StructField(names["spans"], T.ArrayType(T.IntegerType())),
        T.StructField(names["items"], T.ArrayType(T.StringType())),
    ]
    schema = T.StructType([*state.schema.fields, *added])
    first = True
    for items in _blocks(benchmark, item, text, block_bytes):
        state = _search_block(spark, state, schema, pickle.dumps(TestBlock.of(items)), text, names, first)
        first = False
    if first:
        state = _search_block(spark, state, schema, pickle.dumps(TestBlock.of([])), text, names, True)
    return state


def _search_block(
    spark: SparkSession, state: DataFrame, schema: T.StructType, block: bytes, text: str, names: dict, first: bool
) -> DataFrame:
    if not first:
        state = written(spark, state, "decontaminate")
    shared = spark.sparkContext.broadcast(block)
    key = hashlib.sha256(block).hexdigest()
    return state.mapInArrow(partial(_pass, block=shared, key=key, text=text, names=names, first=first), schema)


def covered(spans) -> F.Column:
    """Words inside the spans."""
    return F.coalesce(
        F.aggregate(
            F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("bigint"), lambda s, x: s + x
        ),
        F.lit(0).cast("bigint"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that share no window with the benchmark; columns as before."""
    prefix = "_bench_"
    found = find_matches(docs, benchmark, prefix=prefix)
    return found.where(F.size(f"{prefix}spans") == 0).select(*docs.columns)
