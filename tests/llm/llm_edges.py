"""Fixtures of these tests, imported by each, and the rows that every operator has to stand."""

from __future__ import annotations

import random

import pytest

#: Null ids and texts, empty and blank texts, repeated rows.
EDGE_ROWS = ((1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, None), (None, "a b c"), (4, "one"), (4, "one"))
#: A schema with columns that operators might use as names of their own.
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, kept boolean"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) or longer tuples; other columns are null."""
    return lambda *rows: spark.createDataFrame([(*r, *[None] * (7 - len(r))) for r in rows], DOCS)


@pytest.fixture()
def words():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    return lambda n: [rng.choice(vocabulary) for _ in range(n)]
