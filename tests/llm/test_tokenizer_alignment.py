"""Operator 12: tokens, groups and links against whole-text encoding cut by decoded bytes alone."""

import hashlib
import random
from bisect import bisect
from collections import Counter
from itertools import accumulate

from llm_edges import EDGE_ROWS, docs, words  # noqa: F401

from ledgerspark.llm import tokenizer_alignment as ta
from ledgerspark.llm.queries import QUERIES

PAIR = ta.Pair(ta.Aligner.of())
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
MIXED = [" ", "  ", "\n", "\t", "a", "The", "don't", "'s", "123", "é", "é", "漢字", "🙂", "👩‍👩‍👧", " ", "　", " ", "\x85", "\x1c",
         "᠎", "▁", "<|endoftext|>", "</s>", "<0x41>", "\x00", "ß", "Ω", "नमस्ते", "--", "!?", "﻿", "​", "x" * 40]


def plain(text):
    """Ids and byte ends of the whole text under both tokenizers, or None."""
    if not text:
        return None
    a, b = PAIR.a.encode(" " + text, add_special_tokens=False).ids, PAIR.b.encode(text)
    parts = [[PAIR.a_bytes[i] for i in a], [PAIR.b_bytes[i] for i in b]]
    raw = (" " + text).encode()
    if any(b"".join(p) != raw for p in parts):
        return None
    return a, b, *[list(accumulate(map(len, p))) for p in parts]


def brute(texts):
    seen, counts = [], Counter()
    for text in texts:
        tokens = plain(text)
        if tokens is None:
            seen.append(None)
            continue
        a, b, a_ends, b_ends = tokens
        owner = [[k for k, (lo, hi) in enumerate(zip([0, *ends], ends)) for _ in range(lo, hi)] for ends in (a_ends, b_ends)]
        # Pairs of tokens that share a byte.
        links = [(a[i], b[j]) for i, j in dict.fromkeys(zip(*owner))]
        groups, at = [], (0, 0)
        for end in sorted(set(a_ends) & set(b_ends)):
            to = (bisect(a_ends, end), bisect(b_ends, end))
            groups.append("|".join(",".join(map(str, ids[lo:hi])) for ids, lo, hi in zip((a, b), at, to)))
            at = to
        counts.update(links)
        seen.append((a, b, groups, links))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(n, top.get(y, 0))
    for one in seen:
        if one is None:
            yield (0, 0, 0, 0, 0, 0, "")
        else:
            a, b, groups, links = one
            best = sum(counts[x, y] == top[y] for x, y in links)
            yield len(a), len(b), len(groups), len(links), best, sum(counts[k] for k in links), ";".join(groups)


def strange(n):
    rng = random.Random(n)
    return ["".join(rng.choices(MIXED, k=rng.randint(1, 30))) for _ in range(n)]


def found(frame, **options):
    return {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in ta.align_tokenizers(frame, **options).collect()}


def test_like_whole_texts(docs):
    texts = [None, "", *strange(250), "again and again", "again and again", " lead", "trail ", "漢" * 300, "no" * 3000]
    wanted = dict(enumerate(brute(texts)))
    assert sum(w[0] == 0 for w in wanted.values()) > 2
    # Three tasks are three blocks at least.
    frame = docs(*enumerate(texts)).repartition(3)
    assert found(frame) == wanted
    digests = found(frame, digest=True)
    for i, row in wanted.items():
        assert digests[i][-1] == (hashlib.sha256(row[-1].encode()).hexdigest() if row[0] else "")


def test_spans_are_coarse_cuts_of_decoded_bytes():
    texts = [t for t in strange(400) if plain(t)]
    pair = ta.Pair(ta.Aligner.of())
    for text in texts:
        raw = (" " + text).encode()
        encoded = pair.a.encode(" " + text, add_special_tokens=False)
        pieces = pair.b.encode(text, return_type="proto").pieces
        _, _, a_ends, b_ends = plain(text)
        a = ta.character_cuts(raw, ta.np.array(encoded.offsets))
        inner = ta.np.array([bool(pair.fallback[p.id]) and p.begin == p.end for p in pieces])
        b = ta.byte_cuts(ta.np.array([p.end for p in pieces]), inner)
        for cuts, ids, sizes, ends in ((a, encoded.ids, pair.a_sizes, a_ends), (b, [p.id for p in pieces], pair.b_sizes, b_ends)):
            assert all(c in (-1, e) for c, e in zip(cuts.tolist(), ends))
            assert ta.refined(cuts, sizes[ta.np.array(ids)]).tolist() == ends


def test_book_keeps_the_most_used(monkeypatch):
    monkeypatch.setattr(ta, "KEPT_CHUNKS", 10)
    book = ta.Book()
    names = [f"c{i}" for i in range(30)]
    book.enter(names, [f"g{i}" for i in range(30)], [b"%d" % i for i in range(30)], ta.np.arange(90).reshape(30, 3))
    book.keep(ta.np.arange(30))
    assert sorted(book.place) == [f"c{i}" for i in range(25, 30)]
    for name, at in book.place.items():
        i = int(name[1:])
        assert (book.groups[at], book.codes[at], book.counts[at].tolist()) == (f"g{i}", b"%d" % i, [3 * i, 3 * i + 1, 3 * i + 2])


def test_edges(docs, spark):
    rows = ta.align_tokenizers(docs(*EDGE_ROWS, (9, "word " * 60_000)))
    assert rows.columns == ["doc_id", *COLUMNS]
    got = [tuple(r) for r in rows.collect()]
    assert len(got) == len(EDGE_ROWS) + 1
    assert sum(r[0] is None for r in got) == 2 and sum(r[0] == 4 for r in got) == 3
    assert len({r for r in got if r[0] == 4}) == 1
    assert all(r[1:] == (0,) * 6 + ("",) for r in got if r[0] in (1, 2))
    assert [r for r in got if r[0] == 9][0][1:3] == (60_001, 60_001)
    assert ta.align_tokenizers(docs()).count() == 0
    # Names of the operator's own columns, and a key that is text.
    own = spark.createDataFrame([("x", "a b", 1, b"")], "block string, n string, at int, key binary")
    assert [tuple(r)[:3] for r in ta.align_tokenizers(own, key="block", text="n").collect()] == [("x", 2, 2)]
    # Bytes that are no UTF-8 have no tokens.
    broken = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    assert [tuple(r)[1:] for r in ta.align_tokenizers(broken).collect()] == [(0,) * 6 + ("",)]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    query = [n for n in QUERIES if n.startswith("op12_")][0]
    rows = {r["doc_id"]: r for r in QUERIES[query](spark, sf).collect()}
    source = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(source)
    for (i, _), wanted in zip(source, brute([t for _, t in source])):
        got = rows[i]
        digest = hashlib.sha256(wanted[-1].encode()).hexdigest() if wanted[0] else ""
        assert tuple(got[c] for c in (*COLUMNS[:-1], "groups_sha256")) == (*wanted[:-1], digest)
