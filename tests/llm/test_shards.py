"""Operator 9: even bytes, gapless slots, copies together, hot groups split."""

from collections import defaultdict

from llm_edges import EDGE_ROWS, docs, words  # noqa: F401
from pyspark.sql import functions as F

from ledgerspark.llm.kd_shards import KdTree, kd_shards


def shards(df):
    rows = df.collect()
    size, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        size[r["_shard"]] += r["_size"]
        slots[r["_shard"]].append(r["_slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows, size


def test_even_bytes_and_copies_together(docs, words):
    rows = [(n, " ".join(words(5 + n * 7 % 90)) + "\n" * (n % 5) + "é" * (n % 11), "en", f"s{n % 3}") for n in range(2000)]
    rows += [(5000 + n, rows[n % 40][1], "fr", "s9") for n in range(40)]
    made, size = shards(kd_shards(docs(*rows), KdTree(slot_rows=100)))
    assert len(made) == len(rows) and set(size) == set(range(8))
    assert max(size.values()) - min(size.values()) <= 0.01 * sum(size.values())
    places = defaultdict(set)
    for r in made:
        places[r["text"]].add(r["_shard"])
    assert all(len(p) == 1 for p in places.values())


def test_hot_group_is_split(docs):
    rows = [(n, "same text") for n in range(3000)] + [(9000 + n, f"other {n}") for n in range(3000)]
    _, size = shards(kd_shards(docs(*rows)))
    assert max(size.values()) < 1.1 * sum(size.values()) / 8


def test_every_group_that_fits_a_leaf_stays_together(docs, words):
    """Groups of 2 to 400 copies, the largest nearly as large as a shard, beside single texts."""
    rows = [(n, " ".join(words(20 + n % 60))) for n in range(4000)]
    target = sum(len(t) + 1 for _, t in rows) // 8
    for g, share in enumerate((0.002, 0.01, 0.05, 0.1, 0.3, 0.5)):
        text = f"group {g} " + " ".join(words(30))
        rows += [(10_000 * (g + 1) + n, text) for n in range(max(2, int(target * share / len(text))))]
    made, size = shards(kd_shards(docs(*rows)))
    places = defaultdict(set)
    for r in made:
        places[r["text"]].add(r["_shard"])
    assert all(len(p) == 1 for p in places.values())
    assert max(size.values()) - min(size.values()) <= 0.5 * sum(size.values()) / 8


def test_names_of_its_own(docs, spark):
    frame = docs((1, "a b"), (2, "c d")).withColumns({n: F.lit(1) for n in ("_size", "_shard", "_text", "_at", "_rank", "_kd_text", "_keys")})
    made = kd_shards(frame)
    assert made.count() == 2 and {"_text", "_at", "_rank", "_keys"} <= set(made.columns) and "_kd_text" not in made.columns


def test_copies_of_the_test_table_stay_together(spark):
    rows = kd_shards(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")).groupBy("text")
    assert rows.agg(F.countDistinct("_shard").alias("n")).where("n > 1").count() == 0


def test_leaf_bytes_and_edges(docs):
    rows, size = shards(kd_shards(docs(*EDGE_ROWS), KdTree(leaf_bytes=8)))
    assert len(rows) == len(EDGE_ROWS) and len(size) > 1
    assert kd_shards(docs()).count() == 0
    rows, size = shards(kd_shards(docs(*[(n, f"text {n} {'x' * n}") for n in range(300)]), KdTree(leaf_bytes=2000)))
    assert max(size.values()) <= 2400
    assert kd_shards(docs(*EDGE_ROWS), out=("doc_id",)).columns == ["doc_id", "_size", "_shard", "_slot"]
