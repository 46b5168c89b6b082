"""Operator 4, language identification by cross-parsing with suffix automata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.words import text_slices

UNDECIDED = "und"


@dataclass(frozen=True)
class Learning:
    """Bounds of the sample: documents per language and characters taken from each."""

    documents: int = 48
    characters: int = 500
    #: Texts are parsed in blocks of so many letters and spaces; a block begins a new phrase in every language.
    block: int = 2048
    #: Parts of a language's sample that are held back in turn to learn how many phrases its own texts take.
    folds: int = 16


def normal(text: str) -> str:
    """Lower-cased letters, with one space for every run of anything else."""
    return "".join(c if c.isalpha() else " " for c in text.lower())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the smallest automaton that reads every substring of ``text``; state 0 is the start."""
    following: list[dict[str, int]] = [{}]
    length, link, last = [0], [-1], 0
    for symbol in text:
        current = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in following[state]:
            following[state][symbol] = current
            state = link[state]
        if state >= 0:
            target = following[state][symbol]
            if length[target] == length[state] + 1:
                link[current] = target
            else:
                copy = len(following)
                following.append(dict(following[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and following[state].get(symbol) == target:
                    following[state][symbol] = copy
                    state = link[state]
                link[target] = link[current] = copy
        last = current
    return following


def _greedy_phrases(text: str, ways: list[dict[str, int]]) -> int:
    """Longest-match phrases of a text, read from left to right; a symbol that the automaton lacks is one."""
    count = state = 0
    for symbol in text:
        ahead = ways[state].get(symbol)
        if ahead is None:
            count += state != 0
            ahead = ways[0].get(symbol, 0)
            count += ahead == 0
        state = ahead
    return count + (state != 0)


def expected_rates(sample: dict[str, str], folds: int) -> dict[str, float]:
    """Phrases per character that text of each language takes: every part of its sample, held back in turn, parsed
    by the rest. A longer sample has longer matches and so a lower rate. With under two words the rate is 1."""
    rates = {}
    for name, text in sample.items():
        words = text.split()
        parts = min(folds, len(words))
        cuts = [len(words) * n // parts for n in range(parts + 1)] if parts > 1 else []
        phrases = symbols = 0
        for begin, end in zip(cuts, cuts[1:]):
            held = " ".join(words[begin:end])
            phrases += _greedy_phrases(held, suffix_automaton(" ".join(words[:begin] + words[end:])))
            symbols += len(held)
        rates[name] = phrases / symbols if symbols else 1.0
    return rates


class Languages:
    """Suffix automata of all languages in one table: row = state, column = symbol, -1 = no way on.

    Symbol 0 is any character that the sample does not have; no state reads it.
    """

    def __init__(self, sample: dict[str, str]):
        self.names = sorted(sample)
        alphabet = sorted({c for text in sample.values() for c in text})
        # As in normal(): what is no letter is read as a space.
        self.space = alphabet.index(" ") + 1 if " " in alphabet else len(alphabet) + 1
        self.symbol = np.where(_letters(), 0, self.space).astype(np.uint16)
        for n, c in enumerate(alphabet):
            self.symbol[ord(c)] = n + 1
        self.width = len(alphabet) + 2
        tables, self.start, offset = [], [], 0
        for name in self.names:
            automaton = suffix_automaton(sample[name])
            table = np.full((len(automaton), self.width), -1, np.int32)
            for state, ways in enumerate(automaton):
                for c, target in ways.items():
                    table[state, self.symbol[ord(c)]] = target + offset
            tables.append(table)
            self.start.append(offset)
            offset += len(automaton)
        self.table = np.concatenate(tables).reshape(-1) if tables else np.zeros(0, np.int32)

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of the normal form of a text, without spaces at its ends; empty if it has no letter."""
        found = self.symbol[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
        gap = found == self.space
        keep = ~gap
        keep[1:] |= ~gap[:-1]
        found = found[keep]
        return found[int(len(found) > 0 and found[0] == self.space) : len(found) - int(len(found) > 1 and found[-1] == self.space)]

    def phrases(self, blocks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of every row of symbols (padded) in every language: rows x languages.

        All rows and languages go one symbol on at a time. Rows must be sorted by length, longest first.
        """
        n, m = len(blocks), len(self.start)
        start = np.array(self.start, np.int32)
        state = np.tile(start, (n, 1))
        begin = state.copy()
        count = np.ones((n, m), np.int32)
        live = len(lengths) - np.searchsorted(lengths[::-1], np.arange(blocks.shape[1]), "right")
        columns = np.ascontiguousarray(blocks.T).astype(np.int32)
        for at in range(blocks.shape[1]):
            k = int(live[at])
            if not k:
                break
            symbols = columns[at, :k, None]
            ahead = self.table[state[:k] * self.width + symbols]
            stuck = ahead < 0
            if stuck.any():
                # The phrase ends before this symbol, unless it is empty; the next one begins with it.
                fresh = stuck & (state[:k] == begin[:k])
                count[:k] += stuck & ~fresh
                again = self.table[begin[:k] * self.width + symbols]
                # An unknown symbol is a phrase of its own.
                unknown = stuck & (again < 0)
                count[:k] += unknown
                ahead = np.where(stuck, np.where(again < 0, begin[:k], again), ahead)
            state[:k] = ahead
        count -= state == begin
        return count


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=2)
def _languages(sample: tuple[tuple[str, str], ...]) -> Languages:
    return Languages(dict(sample))


def _predict(batches: Iterator[pa.RecordBatch], sample: tuple, rates: dict[str, float], p: Learning, text: str, names: tuple[str, str]):
    model = _languages(sample)
    rate = np.array([rates[name] for name in model.names])
    for whole in batches:
        for batch, texts in text_slices(whole, text):
            rows, owners, lengths = [], [], []
            for n, raw in enumerate(texts):
                if raw is None:
                    continue
                codes = model.symbols(raw.decode("utf-8", "replace"))
                for at in range(0, len(codes), p.block):
                    rows.append(codes[at : at + p.block])
                    owners.append(n)
                    lengths.append(len(rows[-1]))
            best = [UNDECIDED] * len(texts)
            score = [0.0] * len(texts)
            if rows and model.names:
                order = np.argsort(-np.array(lengths), kind="stable")
                lengths = np.array(lengths)[order]
                blocks = np.zeros((len(rows), lengths[0]), np.uint16)
                for place, r in enumerate(order.tolist()):
                    blocks[place, : len(rows[r])] = rows[r]
                counts = model.phrases(blocks, lengths)
                total = np.zeros((len(texts), len(model.names)), np.int64)
                size = np.zeros(len(texts), np.int64)
                owner = np.array(owners)[order]
                np.add.at(total, owner, counts)
                np.add.at(size, owner, lengths)
                for n in np.flatnonzero(size):
                    normalised = total[n] / rate
                    ranked = np.argsort(normalised, kind="stable")
                    best[n] = model.names[ranked[0]]
                    second = normalised[ranked[1]] if len(ranked) > 1 else size[n] / rate[0]
                    score[n] = float(1.0 - normalised[ranked[0]] / second)
            kept = [c for c in batch.schema.names if c not in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(best, pa.string()), pa.array(score, pa.float64())],
                [*kept, *names],
            )


def learn(labelled: DataFrame, p: Learning = Learning()) -> dict[str, str]:
    """Sample text per language: the first characters of ``p.documents`` rows in the order of a hash of their text.

    Rows with null language or without letters are not used. The sample is at most languages x documents x characters.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    # Equal texts, which have equal hashes, count once.
    picked = (
        usable.select("lang", F.substring("text", 1, p.characters).alias("text"))
        .withColumn("n", F.dense_rank().over(order))
        .where(F.col("n") <= p.documents)
        .select("lang", "text", "n")
        .distinct()
    )
    rows = sorted((r["lang"], r["n"], r["text"]) for r in picked.collect())
    sample: dict[str, list[str]] = {}
    for lang, _, text in rows:
        sample.setdefault(lang, []).append(" ".join(normal(text).split()))
    return {lang: " ".join(parts) for lang, parts in sample.items()}


def identify(
    docs: DataFrame, sample: dict[str, str], p: Learning = Learning(), text: str = "text",
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``docs`` with the predicted language and a score.

    A text is cut into the longest phrases that the labelled text of a language contains, from left to
    right; a character that it does not contain is a phrase. Phrases are normalised: divided by what text of that language
    takes by a sample of that length (``expected_rates``, computed once from the bounded sample). The
    language with the fewest normalised phrases wins, of equal ones the first name. The score is 1 minus the winner's
    over the second's: 0 for a tie.
    A null text and one without letters are ``und`` with score 0, as is every text if nothing was
    learnt. Every text is parsed whole, in blocks whose borders end a phrase in each language. Repeated rows agree, an empty table stays
    empty, other columns are kept and columns named as the new ones replaced.
    """
    held = docs.drop(*[n for n in names if n != text])
    schema = T.StructType(
        [*held.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    )
    shared = tuple(sorted(sample.items()))
    rates = expected_rates(sample, p.folds)
    return held.mapInArrow(partial(_predict, sample=shared, rates=rates, p=p, text=text, names=names), schema)


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learnt from: remainder 2 of the CRC-32 of the id, as text, by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
