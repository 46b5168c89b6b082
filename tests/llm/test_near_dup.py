"""Operator 6: components against brute force, with groups of copies and of edited copies."""

import random
import re

import numpy as np
from llm_edges import EDGE_ROWS, docs, words  # noqa: F401

from ledgerspark.llm.components import smallest_reachable
from ledgerspark.llm.fast_sketch_dedup import NearDup, fast_sketches, near_duplicates, one_of_each


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted((repr(d), len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.random()}"
    return out


def test_components_match_brute_force(docs, words):
    rng = random.Random(3)
    rows = [(900 - n, t) for n, t in enumerate(["a b", "A b", "a b c d e", "a b c d e f"])]
    for group in range(6):
        base = words(60 + 40 * group)
        rows += [(1000 + 1000 * group + n, " ".join(edited(rng, base, n % 5))) for n in range(25)]
    # Around one text: edits from none to many, so that most pairs are near the limit.
    base = words(150)
    rows += [(20_000 + n, " ".join(edited(rng, base, n % 7))) for n in range(120)]
    rows += [(30_000 + n, " ".join(base).upper()) for n in range(50)]
    rows += list(EDGE_ROWS)
    got = near_duplicates(docs(*rows), NearDup(block=16)).collect()
    assert sorted((repr(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    left = one_of_each(docs(*rows))
    assert left.where("doc_id = 4").count() == 1 and left.columns == docs().columns


def test_sketches_are_full_and_unbiased():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for size in (1, 3, 40, 400):
        a, b = np.unique(pool[: size * 4]), np.unique(pool[size : size * 5])
        s = fast_sketches([a, b, np.zeros(0, np.uint64), a], 400)
        assert (s[0] == s[3]).all()
        expected = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - expected) < 0.12


def test_long_paths_and_empty_links(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a bigint, b bigint")
    got = {r["id"]: r["label"] for r in smallest_reachable(spark, path).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert smallest_reachable(spark, path.where("false")).count() == 0


def test_empty(docs):
    assert near_duplicates(docs()).count() == 0
