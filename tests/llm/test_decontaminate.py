"""Operator 2: matches against brute force, in one block and in many."""

import re

import pytest
from llm_edges import EDGE_ROWS, docs, words  # noqa: F401
from pyspark.sql import functions as F

from ledgerspark.llm.suffix_decontaminate import covered, decontaminate, find_matches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(doc, items):
    words, hit, found = split(doc), set(), set()
    for item, text in items:
        other = split(text)
        m = min(10, len(other))
        grams = {tuple(other[i : i + m]) for i in range(len(other) - m + 1)} if other else set()
        for i in range(len(words) - m + 1):
            if m and tuple(words[i : i + m]) in grams:
                hit.update(range(i, i + m))
                found.add(item)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 1])
def test_matches_brute_force(spark, docs, words, block_bytes):
    shared = [words(40) for _ in range(4)]
    items = [(f"i{n}", " ".join(s)) for n, s in enumerate(shared)]
    items += [("same", " ".join(shared[0][5:30])), ("short", "w1 w2 w3"), ("one", "rareword"), ("none", "..."), ("null", None)]
    rows = []
    for n in range(40):
        s = shared[n % 4]
        middle = s[n % 7 : n % 7 + 8 + n % 30]
        rows.append((n, " ".join(words(n) + middle + words(5)) + (", RareWord!" if n % 9 == 0 else "")))
    rows += [(100, "W1-w2 w3"), (100, "W1-w2 w3"), *EDGE_ROWS]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    found = find_matches(docs(*rows), benchmark, block_bytes=block_bytes)
    got = found.select("text", "n_words", covered(F.col("spans")).alias("n_hit"), "items").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_words"], r["n_hit"], r["items"]) == brute(r["text"], items)
    assert any(r["n_hit"] > 20 for r in got)


def test_hot_passage_and_long_text(spark, docs):
    passage = " ".join(f"p{i}" for i in range(12))
    benchmark = spark.createDataFrame([(7, passage)], "item_id bigint, text string")
    rows = [(n, f"before {passage} after") for n in range(500)] + [(1000, "x " * 300_000 + passage)]
    got = find_matches(docs(*rows), benchmark).select(covered(F.col("spans")).alias("n")).collect()
    assert {r["n"] for r in got} == {12}


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate(docs((1, "a b c")), none).count() == 1
    some = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontaminate(docs(), some).count() == 0
    left = decontaminate(docs((1, "x a b"), (2, "b a"), (3, None)), some)
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3] and left.columns == docs().columns
