"""Operator 10: targets and taken words against a plain computation."""

import hashlib
import re

from llm_edges import EDGE_ROWS, docs, words  # noqa: F401

from pyspark.sql import functions as F

from ledgerspark.llm.pareto_mix import Mix, mix_sources, mixed_documents


def targets_of(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        rest = total - sum(stopped.values())
        share = sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * rest > 3 * sizes[s] * share]
        if not over:
            return {**stopped, **{s: weight[s] * rest / share for s in free}}
        stopped.update({s: 3 * sizes[s] for s in over})


def brute(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    sizes = {}
    for r, n in zip(rows, size, strict=True):
        sizes[r[3]] = sizes.get(r[3], 0) + n
    target, out = targets_of(sizes), []
    for source, total in sizes.items():
        whole = min(3, int(target[source] / total)) if total else 0
        due = target[source] - whole * total
        n_rows = sum(r[3] == source for r in rows)

        def chance(n, r):
            own = f"null:{r[1]}" if r[0] is None and r[1] is not None else "null" if r[0] is None else r[0]
            u = (int(hashlib.md5(f"mix:{own}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            odds = min(max(n * n_rows / total, 0.25), 4.0) if total else 1.0
            return u / (1 - u) / odds, n

        before = 0
        own_rows = [(n, r) for n, r in zip(size, rows, strict=True) if r[3] == source]
        for n, r in sorted(own_rows, key=lambda x: chance(*x)):
            extra = before + n / 2 <= due and n > 0
            out.append((repr(r[0]), n, total, round(target[source], 6), n * (whole + extra)))
            before += n
    return sorted(out)


def test_mix_matches_brute_force(docs, words):
    rows = []
    for n in range(400):
        source = ("a", "a", "a", "b", "c", None, "é", "d")[n % 8]
        rows.append((n, " ".join(words(n % 37)), None, source))
    rows += [(i, t, None, "a") for i, t in EDGE_ROWS]
    rows += [(5000, None, None, "empty"), (5001, "", None, "zero")]
    got = mix_sources(docs(*rows), Mix(step_rows=20)).collect()
    found = sorted((repr(r["doc_id"]), r["_size"], r["_source_size"], round(r["_target"], 6), r["_size"] * r["_copies"]) for r in got)
    assert found == brute(rows)
    taken, target = {}, {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["_size"] * r["_copies"]
        target[r["source"]] = r["_target"]
        assert r["_copies"] <= 3
    assert all(abs(taken[s] - target[s]) <= 40 for s in taken)


def test_inclusion_follows_the_odds(spark, docs):
    """Over many seeds, documents of four sizes come in by odds in the ratio of their sizes."""
    rows = [(n, "w " * (10, 20, 40, 80)[n % 4], None, "a") for n in range(400)]
    rows += [(n, "w " * 10, None, "b") for n in range(1000, 2200)]
    frame = docs(*rows).cache()
    taken = dict.fromkeys((10, 20, 40, 80), 0)
    seeds = 6
    for seed in range(seeds):
        got = mix_sources(frame, Mix(weights=(1, 2), seed=f"s{seed}")).where("source = 'a'").collect()
        assert len({r["_target"] for r in got}) == 1 and got[0]["_target"] < got[0]["_source_size"]
        assert abs(sum(r["_size"] * r["_copies"] for r in got) - got[0]["_target"]) <= 40
        for r in got:
            taken[r["_size"]] += r["_copies"]
    share = {size: n / (100 * seeds) for size, n in taken.items()}
    odds = {size: p / (1 - p) for size, p in share.items()}
    # The mean size is 37.5: odds of 0.27, 0.53, 1.07 and 2.13 against it.
    for size in (20, 40, 80):
        assert 0.7 * size / 10 < odds[size] / odds[10] < 1.4 * size / 10
    frame.unpersist()


def test_repeated_rows_at_the_threshold(docs):
    """Of a thousand equal rows as many are taken as the target lets, not all or none."""
    rows = [(1, "a b c d", None, "a")] * 1000 + [(n, "x y", None, "b") for n in range(3000)]
    got = mix_sources(docs(*rows), Mix(weights=(1, 2))).where("source = 'a'")
    assert got.count() == 1000
    copies = [r["_copies"] for r in got.collect()]
    assert len(set(copies)) == 2 and abs(4 * sum(copies) - 10_000 / 3) <= 2


def test_no_text_is_shuffled(docs, words):
    frame = docs(*[(n, " ".join(words(10)), None, "ab"[n % 2]) for n in range(40)])
    plan = mixed_documents(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "Sort" not in plan


def test_copies_become_rows(docs, words):
    rows = [(n, " ".join(words(10)), None, "a" if n < 5 else "b") for n in range(100)]
    plan = {r["doc_id"]: r["_copies"] for r in mix_sources(docs(*rows)).collect()}
    mixed = [r["doc_id"] for r in mixed_documents(docs(*rows)).collect()]
    assert all(mixed.count(i) == n for i, n in plan.items()) and max(plan.values()) == 3


def test_names_of_its_own(docs, words):
    own = ("_size", "_target", "_rank", "_s", "_step", "_mix_s", "_mix_copy", "source_rows", "size", "shard")
    frame = docs(*[(n, " ".join(words(10)), None, "ab"[n % 2]) for n in range(40)])
    frame = frame.withColumns({n: F.concat(F.lit(f"{n} "), "doc_id") for n in own})
    mixed = mixed_documents(frame)
    assert mixed.columns == frame.columns
    rows = mixed.collect()
    assert rows and all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in own)
    sized = mix_sources(frame)
    assert {"_rank", "_s", "source_rows"} <= set(sized.columns) and not any(c.startswith("_mix_") for c in sized.columns)


def test_empty(docs):
    assert mix_sources(docs()).count() == 0 and mixed_documents(docs()).columns == docs().columns
