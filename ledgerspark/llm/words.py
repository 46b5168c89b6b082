"""Words of many texts at once, as numpy arrays, for operators that run inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _table(delimiters: bytes, lower: bool) -> bytes:
    """Translation of bytes that sends delimiters to 0 and, if asked, A-Z to a-z."""
    cells = list(range(256))
    if lower:
        for code in range(ord("A"), ord("Z") + 1):
            cells[code] = code + 32
    for code in delimiters:
        cells[code] = 0
    return bytes(cells)


_BLANKS = bytes([0x20, *range(0x09, 0x0E)])
_MARKS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: ``[^\x20\x09-\x0D]+`` of texts with A-Z lower-cased. A NUL byte is part of a word there, so it becomes 0x20.
LOWER_BLANK_WORDS = bytearray(_table(_BLANKS, lower=True))
LOWER_BLANK_WORDS[0] = 0x20
LOWER_BLANK_WORDS = bytes(LOWER_BLANK_WORDS)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of texts with A-Z lower-cased.
LOWER_LETTER_WORDS = _table(_MARKS, lower=True)


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit mixing step: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = values + np.uint64((seed * _BASE + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


class Words:
    """Words of consecutive texts: ``start`` and ``end`` in ``buffer``, ``hash``, and ``first`` word of each text.

    ``first`` has one entry more than there are texts. Equal words have equal hashes; two different words
    agree with a probability of about 2 to the power of -64.
    """

    def __init__(self, texts: list[bytes | None], table: bytes):
        self.buffer = b"\n".join(t or b"" for t in texts).translate(table) + b"\0"
        # The separators are newlines, which both tables send to 0.
        data = np.frombuffer(self.buffer, np.uint8)
        inside = np.zeros(len(data) + 1, np.int8)
        np.not_equal(data, 0, out=inside[1:].view(bool))
        turns = np.diff(inside)
        self.start = np.flatnonzero(turns == 1)
        self.end = np.flatnonzero(turns == -1)
        lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.first = np.searchsorted(self.start, offsets)
        size = 1 << max(16, len(data).bit_length())
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(data * _powers(_BASE, size)[: len(data)], out=sums[1:])
            raw = (sums[self.end] - sums[self.start]) * _powers(_INVERSE, size)[self.start]
        self.hash = mix(raw)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def word(self, i: int) -> bytes:
        return self.buffer[self.start[i] : self.end[i]]


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive entries; the last ``k - 1`` places have none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = hashes[:n].copy()
        for j in range(1, k):
            total *= np.uint64(_BASE)
            total += hashes[j : n + j]
    return mix(total, seed=k)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Parts of a batch whose texts have at most ``SLICE_BYTES`` together, or are one text."""
    texts = text_bytes(batch.column(column))
    at = 0
    while at < len(texts):
        size, to = len(texts[at] or b""), at + 1
        while to < len(texts) and size + len(texts[to] or b"") <= SLICE_BYTES:
            size += len(texts[to] or b"")
            to += 1
        yield batch.slice(at, to - at), texts[at:to]
        at = to
