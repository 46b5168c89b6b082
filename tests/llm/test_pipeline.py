"""The whole pipeline against a plain computation, stage by stage."""

from collections import Counter

import corpus_pipeline
import pytest
from test_decontaminate import brute as brute_matches
from test_mix import brute as brute_mix
from test_near_dup import brute as brute_components

from ledgerspark.llm.line_quality import LineRules, judge


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import random

    rng = random.Random(11)
    make = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n)) + "."
    texts = [make(30 + n) for n in range(150)]
    texts += [texts[n] for n in range(30)] + [texts[n].replace("w1", "v1", 1) + " more" for n in range(100, 130)]
    texts += ["home | about | news | " * 10, "short", None, ""]
    items = [make(25) for _ in range(5)]
    texts += [make(20) + " " + item + " " + make(10) for item in items]
    rows = [(n, t, "en", f"s{n % 4}", len(t or "")) for n, t in enumerate(texts)]
    at = tmp_path_factory.mktemp("pipeline")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{at}/documents.parquet")
    bench = list(enumerate(items))
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), rows, bench


def test_near_dedup_from_four_fifths(spark):
    # Of 100 + n different shingles each, 200 - n are shared: similarities of 0.80 to 0.85, and some below.
    rows = []
    for n in range(60):
        base = [f"b{n}x{i}" for i in range(204)]
        lost = 33 + n % 12 if n < 48 else 60
        rows.append((2 * n, " ".join(base)))
        rows.append((2 * n + 1, " ".join(base[: 204 - lost // 2] + [f"c{n}x{i}" for i in range(lost - lost // 2 - 4)])))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    similar = {2 * n for n in range(60) if len(sets[2 * n] & sets[2 * n + 1]) >= 0.8 * len(sets[2 * n] | sets[2 * n + 1])}
    between = [n for n in similar if len(sets[n] & sets[n + 1]) < 0.85 * len(sets[n] | sets[n + 1])]
    assert len(between) > 20 and len(similar) < 60
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert left == {i for i, _ in rows} - {n + 1 for n in similar}


def test_stages_and_run(spark, folder):
    at, rows, items = folder
    kept = []
    for r in rows:
        found = judge(r[1].encode() if r[1] is not None else None, LineRules())
        if found.kept:
            kept.append((r[0], found.cleaned.decode(), r[2], r[3], len(found.cleaned.decode())))
    components = brute_components([(r[0], r[1]) for r in kept])
    kept = [r for r in kept if any(c[0] == repr(r[0]) and c[2] == r[0] for c in components)]
    kept = [r for r in kept if brute_matches(r[1], items)[1] == 0]
    copies = Counter({int(i): taken // size for i, size, _, _, taken in brute_mix(kept)})
    assert 100 < len(kept) < 160

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, at).columns == columns, name
    out = corpus_pipeline.run(spark, at).collect()
    assert Counter(r["doc_id"] for r in out) == +copies
    texts = {r[0]: r[1] for r in kept}
    assert all(r["text"] == texts[r["doc_id"]] for r in out)
    for shard in range(8):
        slots = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert slots == list(range(len(slots)))
