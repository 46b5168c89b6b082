"""Operator 6, near-duplicates by fast similarity sketches, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.components import smallest_reachable
from ledgerspark.llm.scratch import written
from ledgerspark.llm.words import LOWER_BLANK_WORDS, Words, mix, rolling, text_slices


@dataclass(frozen=True)
class NearDup:
    """Parameters: words of a shingle, similarity in percent, bands and coordinates of a band.

    At a similarity of 0.85, two documents agree in no band with a probability of (1 - 0.85**5)**28, 7e-8.
    """

    k: int = 5
    percent: int = 85
    bands: int = 28
    rows: int = 5
    #: Pairs are compared on full sets only if so many coordinates agree. At a similarity of 0.85 fewer do
    #: with a probability under 1e-6: 119 of 140 are expected, with a standard deviation of 4.2.
    least_agreeing: int = 98
    #: Documents of a block, when a bucket is compared in blocks.
    block: int = 256

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a text of fewer than ``k`` words is one shingle."""
    grams = rolling(words.hash, k)
    sets = []
    for begin, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if end - begin >= k:
            sets.append(np.unique(grams[begin : end - k + 1]))
        elif end > begin:
            sets.append(rolling(words.hash[begin:end], end - begin))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def fast_sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``bins`` 16-bit coordinates for each non-empty set.

    Round by round every element draws a bin and a value; a bin keeps the smallest value of the first round
    that reaches it. From round ``bins`` on, round ``bins + b`` sends all elements to bin ``b``, so every bin is
    filled at last. Sets whose bins are full take no part in later rounds. Equal sets get equal sketches, and
    each coordinate of two sets agrees with the probability of their similarity.
    """
    n = len(sets)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((n, bins), empty, np.uint64)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    live = np.flatnonzero(sizes > 0)
    elements = np.concatenate([sets[i] for i in live]) if len(live) else np.zeros(0, np.uint64)
    owner = np.repeat(live, sizes[live])
    for turn in range(2 * bins):
        if not len(live):
            break
        drawn = mix(elements, seed=turn + 1)
        if turn < bins:
            bin_of = (drawn >> np.uint64(40)) % np.uint64(bins)
        else:
            bin_of = np.full(len(elements), turn - bins, np.uint64)
        cell = owner * bins + bin_of.astype(np.int64)
        flat = out.reshape(-1)
        # A bin filled in an earlier round holds a smaller value: the round is in the highest bits.
        value = (np.uint64(turn) << np.uint64(48)) | (mix(drawn, seed=7) >> np.uint64(16))
        np.minimum.at(flat, cell, value)
        open_rows = live[(out[live] == empty).any(axis=1)]
        if len(open_rows) < len(live):
            stay = np.zeros(n, bool)
            stay[open_rows] = True
            keep = stay[owner]
            elements, owner, live = elements[keep], owner[keep], open_rows
    return (mix(out, seed=11) >> np.uint64(48)).astype(np.uint16)


def _band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cells = sketches.reshape(len(sketches), bands, rows).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64), seed=3), cells.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix(key * np.uint64(31) + cells[:, :, r], seed=5)
    return key.view(np.int64)


_SIGNATURE = (
    "n_shingles bigint, node bigint, node2 bigint, sketch binary, bands array<bigint>"
)


def _signatures(batches: Iterator[pa.RecordBatch], p: NearDup):
    for whole in batches:
        for batch, texts in text_slices(whole, "text"):
            words = Words(texts, LOWER_BLANK_WORDS)
            sets = shingle_sets(words, p.k)
            sketches = fast_sketches(sets, p.bins)
            keys = _band_keys(sketches, p.bands, p.rows)
            some = [len(s) > 0 for s in sets]
            with np.errstate(over="ignore"):
                marks = [
                    [int(mix(s, seed).sum(dtype=np.uint64).view(np.int64)) if len(s) else None for s in sets]
                    for seed in (21, 22)
                ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(marks[0], pa.int64()),
                    pa.array(marks[1], pa.int64()),
                    pa.array([r.tobytes() if s else None for r, s in zip(sketches, some, strict=True)], pa.binary()),
                    pa.array([r if s else None for r, s in zip(keys, some, strict=True)], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n_shingles", "node", "node2", "sketch", "bands"],
            )


def _agreeing(batches: Iterator[pa.RecordBatch], p: NearDup):
    """Pairs whose sketches agree in enough places and whose set sizes allow the similarity."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, p.bins)
            for c in ("sketch_a", "sketch_b")
        )
        ok = (a == b).sum(axis=1) >= p.least_agreeing
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))], ["a", "b"]
        )


def _verified(batches: Iterator[pa.RecordBatch], p: NearDup):
    """Pairs whose full shingle sets reach the similarity."""
    for batch in batches:
        texts = {c: batch.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b")}
        ok = []
        for one, two in zip(texts["text_a"], texts["text_b"], strict=True):
            x, y = shingle_sets(Words([one, two], LOWER_BLANK_WORDS), p.k)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= p.percent * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))], ["a", "b"]
        )


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of rows that agree in ``by``, whole ones, from rows that come sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in by], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        first = [held[0].column(c)[0].as_py() for c in by]
        if (keys[0] != first).any():
            cuts = np.insert(cuts, 0, 0)
        if not len(cuts):
            continue
        done = held[:-1] + [batch.slice(0, int(cuts[0]))]
        yield pa.concat_batches([d for d in done if d.num_rows])
        for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield batch.slice(begin, end - begin)
        held = [batch.slice(int(cuts[-1]))]
    if held:
        yield pa.concat_batches(held)


def _sets(batches: Iterator[pa.RecordBatch], p: NearDup):
    for whole in batches:
        for batch, texts in text_slices(whole, "text"):
            sets = shingle_sets(Words(texts, LOWER_BLANK_WORDS), p.k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"]
            )


def _in_common(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Elements that a sorted set shares with each of several non-empty sets."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    begins = np.concatenate([[0], np.cumsum([len(o) for o in others])[:-1]])
    return np.add.reduceat((one[at] == flat).astype(np.int64), begins)


def _block_links(batches: Iterator[pa.RecordBatch], p: NearDup):
    """Links of a bucket block (or of two) that join components, decided on full sets.

    Members that are in one component, or come into one here, are not compared again. A pair that shares several
    buckets is looked at in the first of them only.
    """
    for group in _groups(batches, ["key", "i", "j"]):
        side, node, label, size = (
            group.column(c).to_numpy(zero_copy_only=False) for c in ("side", "node", "label", "n_shingles")
        )
        if label.min() == label.max():
            continue
        component = label.copy()
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint16).reshape(-1, p.bins)
        sets = group.column("shingles")
        keys = _band_keys(sketch, p.bands, p.rows)
        key, same_block = group.column("key")[0].as_py(), group.column("i")[0] == group.column("j")[0]
        left = np.flatnonzero(side == 0)
        right = left if same_block else np.flatnonzero(side == 1)
        found_a, found_b = [], []
        for i in left.tolist():
            js = right[component[right] != component[i]]
            if same_block:
                js = js[node[js] > node[i]]
            low, high = np.minimum(size[js], size[i]), np.maximum(size[js], size[i])
            js = js[100 * low >= p.percent * high]
            js = js[(sketch[js] == sketch[i]).sum(axis=1) >= p.least_agreeing]
            if not len(js):
                continue
            js = js[keys[i][(keys[js] == keys[i]).argmax(axis=1)] == key]
            if not len(js):
                continue
            one = np.frombuffer(sets[i].as_py(), np.uint64)
            both = _in_common(one, [np.frombuffer(sets[j].as_py(), np.uint64) for j in js.tolist()])
            for j in js[100 * both >= p.percent * (size[i] + size[js] - both)].tolist():
                if component[i] != component[j]:
                    component[component == component[j]] = component[i]
                    found_a.append(node[i])
                    found_b.append(node[j])
        if found_a:
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])


def _verify(spark: SparkSession, pairs: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return written(spark, joined.mapInArrow(partial(_verified, p=p), "a bigint, b bigint"), "neardup-links")


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents with equal sets are one node, with a 128-bit mark of the whole set. Nodes that agree in a band are
    candidates: first each with the smallest of its bucket, then, in buckets that still hold several
    components, all members of different components, in pairs of blocks. Every candidate is decided on full
    sets; within a component, also one found meanwhile, nothing is compared again, so a group of thousands of copies is
    linked by few comparisons, and no step emits the pairs of a group. A task holds two blocks of at most about ``block``
    sets, or texts of a few pairs.

    Null and empty texts have no shingles, are linked with nothing and stay. A text of fewer words than a
    shingle is one shingle. Repeated rows get the same component; of rows with the component's smallest id
    all are ``kept``. Rows with a null id get the component of their text and are kept only if no other id
    is there. An empty table gives an empty table. Other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = written(
        spark, source.mapInArrow(partial(_signatures, p=p), f"doc_id {kind}, text_key bigint, {_SIGNATURE}"), "neardup-sets"
    )
    nodes = written(
        spark,
        signed.where("node is not null")
        .groupBy("node", "node2")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("doc_id", "text_key")).alias("sample"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
            F.first("bands").alias("bands"),
        ),
        "neardup-nodes",
    )
    members = nodes.select("node", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("n")).where("n > 1")
    buckets = written(spark, members.join(shared, "key"), "neardup-buckets")
    sketches = nodes.select("node", "sketch", "n_shingles")

    def side(name: str) -> DataFrame:
        return sketches.select(
            F.col("node").alias(name), F.col("sketch").alias(f"sketch_{name}"), F.col("n_shingles").alias(f"n_{name}")
        )

    size_fits = F.expr(f"100 * least(n_a, n_b) >= {p.percent} * greatest(n_a, n_b)")
    stars = buckets.where("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    stars = stars.join(side("a"), "a").join(side("b"), "b").where(size_fits).select("a", "b", "sketch_a", "sketch_b")
    stars = written(spark, stars.mapInArrow(partial(_agreeing, p=p), "a bigint, b bigint"), "neardup-stars")

    # Texts of the nodes that any bucket holds, each once.
    asked = buckets.select("node").distinct()
    sample = nodes.join(asked, "node").select(
        "node", F.col("sample.doc_id").alias("sample_id"), F.col("sample.text_key").alias("sample_key")
    )
    texts = (
        source.join(sample, (F.col("text_key") == F.col("sample_key")) & F.col("doc_id").eqNullSafe(F.col("sample_id")))
        .groupBy("node")
        .agg(F.first("text").alias("text"))
    )
    wanted = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = _verify(spark, stars, texts.join(wanted, "node", "left_semi"), p)
    labels = smallest_reachable(spark, links)

    labelled = buckets.where("n > 2").join(labels.withColumnRenamed("id", "node"), "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node")).drop("center")
    mixed = (
        labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    )
    open_buckets = labelled.join(mixed, "key").withColumn("blocks", F.ceil(F.col("n") / p.block).cast("int"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    asked = open_buckets.select("node").distinct()
    sets = texts.join(asked, "node", "left_semi").mapInArrow(partial(_sets, p=p), "node bigint, shingles binary")
    sets = written(spark, sketches.join(sets, "node"), "neardup-full-sets")
    placed = open_buckets.join(sets, "node").withColumn("block", block)
    # Block b meets every other block once; side 0 is the lower one.
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
        "node",
        "label",
        "n_shingles",
        "sketch",
        "shingles",
    )
    more = (
        spread.repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(partial(_block_links, p=p), "a bigint, b bigint")
    )
    every = written(spark, links.unionByName(more), "neardup-every-link")
    labels = smallest_reachable(spark, every)

    ids = nodes.select("node", "node2", "least_id").join(labels.withColumnRenamed("id", "node"), "node", "left")
    ids = ids.withColumn("label", F.coalesce("label", "node"))
    smallest = ids.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = ids.join(smallest, "label").select("node", "node2", "component_id")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        signed.select("doc_id", "n_shingles", "node", "node2")
        .join(named, ["node", "node2"], "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            component.eqNullSafe(F.col("doc_id")).alias("kept"),
        )
    )


def one_of_each(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """The document with the smallest id of each component; columns as before. Equal rows of that id count once."""
    kept = near_duplicates(docs, p).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_kept"))
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
