"""Operator 9, sharding: a k-d tree over document metadata, split at weighted medians."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.scratch import written

#: Steps of one pass of the median search, and bits of value and hash in an order key.
_STEP_BITS, _VALUE_BITS, _HASH_BITS = 12, 20, 28


@dataclass(frozen=True)
class KdTree:
    """Leaves (a power of two), or instead the bytes a leaf may have."""

    leaves: int = 8
    leaf_bytes: int | None = None
    #: Rows of one block of slot numbers.
    slot_rows: int = 20_000


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 1; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def text_metadata(text: Column) -> dict[str, Column]:
    """Dimensions that follow from the text, so that equal texts have one place: length, non-ASCII share, lines."""
    size, lines = F.octet_length(text), F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return {
        "length": F.log2(size.cast("double") + 1),
        "wide": (size - F.length(text)) / F.greatest(size, F.lit(1)),
        "lines": F.log2(lines.cast("double") + 1),
    }


def kd_shards(
    docs: DataFrame,
    tree: KdTree = KdTree(),
    dimensions: dict[str, Column] | None = None,
    out: tuple[Column | str, ...] | None = None,
) -> DataFrame:
    """``docs`` with ``_size, _shard, _slot``: near equal bytes per shard, slots gapless from 0.

    Level by level every node is split at the weighted median, by bytes, of the dimension in which its documents
    are spread most (byte-weighted variance of the values, scaled to 0..1 over all documents). With
    ``leaf_bytes`` the levels are as many as it takes to reach them. The order along a dimension is the value and
    then a hash of the text, so equal values do not hinder a cut. The median is found by histograms of 4096
    steps per node, refined until one order key is left. Copies of a text stay together. Only a group that
    no leaf can hold, which may be a third of all bytes, has order keys by hashed ids too and is split. There are fewer
    such groups than leaves, so their list is broadcast.

    The driver sees histograms and cuts, of a fixed size per node. Documents are routed by an expression of the
    cuts; slots are numbered within hashed blocks of a shard and shifted by the counts of the blocks before, so no
    task gets a whole shard. Null texts have size 1 and null dimensions the smallest value; repeated rows get
    slots of their own; an empty table stays empty. Columns named ``_size``, ``_shard`` or ``_slot`` are replaced, those
    that begin with ``_kd_`` are dropped, all others are kept, or those of ``out`` where it is given, so that the text need not be shuffled.
    """
    spark = docs.sparkSession
    held = docs.drop("_size", "_shard", "_slot", *[c for c in docs.columns if c.startswith("_kd_")])
    kept = held.select(*(out or held.columns)).columns
    values = dimensions or text_metadata(F.col("text"))
    sized = held.select(
        *(out or held.columns),
        text_size(F.col("text")).alias("_size"),
        F.xxhash64("text").alias("_kd_text"),
        F.array(*[F.coalesce(v.cast("double"), F.lit(0.0)) for v in values.values()]).alias("_kd_at"),
    )
    id_hash = F.xxhash64("doc_id") if "doc_id" in kept else F.lit(0)
    groups = written(
        spark,
        sized.groupBy("_kd_text", "_kd_at", F.pmod(id_hash, F.lit(64)).alias("_kd_part")).agg(F.sum("_size").alias("bytes")),
        "shards-groups",
    )
    bounds = [(F.min(F.col("_kd_at")[n]).alias(f"lo{n}"), F.max(F.col("_kd_at")[n]).alias(f"hi{n}")) for n in range(len(values))]
    seen = groups.agg(F.sum("bytes").alias("bytes"), *[b for pair in bounds for b in pair]).first()
    if not seen["bytes"]:
        return sized.select(*kept, "_size", F.lit(0).alias("_shard"), F.lit(0).cast("bigint").alias("_slot"))
    depth = (tree.leaves - 1).bit_length()
    if tree.leaf_bytes:
        depth = max(0, (-(-seen["bytes"] // tree.leaf_bytes) - 1).bit_length())
    limit = max(1, seen["bytes"] >> depth)
    hot = groups.groupBy("_kd_text").agg(F.sum("bytes").alias("b")).where(F.col("b") > limit)
    hot = F.broadcast(hot.select(F.col("_kd_text").alias("_kd_hot")))

    def keyed(rows: DataFrame, part: Column) -> DataFrame:
        rows = rows.join(hot, F.col("_kd_text") == F.col("_kd_hot"), "left")
        tie = F.when(F.col("_kd_hot").isNotNull(), F.xxhash64("_kd_text", part)).otherwise(F.xxhash64("_kd_text"))
        tie = F.pmod(tie, F.lit(1 << _HASH_BITS))
        keys = []
        for n in range(len(values)):
            scale = seen[f"hi{n}"] - seen[f"lo{n}"] or 1.0
            unit = (F.col("_kd_at")[n] - seen[f"lo{n}"]) / scale
            keys.append(F.floor(unit * float((1 << _VALUE_BITS) - 1)).cast("bigint") * (1 << _HASH_BITS) + tie)
        return rows.withColumn("_kd_keys", F.array(*keys)).drop("_kd_hot")

    pieces = keyed(groups, F.col("_kd_part")).groupBy("_kd_keys").agg(F.sum("bytes").alias("bytes"))
    pieces = written(spark, pieces, "shards-pieces")
    axis, cut = [0], [0]
    for _ in range(depth):
        _grow(pieces, axis, cut, len(values))
    part = F.pmod(id_hash, F.lit(64))
    placed = keyed(sized, part).withColumn("_shard", _route(axis, cut) - (1 << depth))
    return _numbered(placed.drop("_kd_at", "_kd_keys"), tree).select(*kept, "_size", "_shard", "_slot")


def _route(axis: list[int], cut: list[int]) -> Column:
    """Heap number of the node a row is in: 1 is the root, 2n and 2n+1 are below n."""
    if len(axis) == 1:
        return F.lit(1)
    axes, cuts = F.array(*[F.lit(a) for a in axis[1:]]), F.array(*[F.lit(c).cast("bigint") for c in cut[1:]])
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(len(axis).bit_length() - 1)),
        F.lit(1),
        lambda node, _: node * 2
        + (F.element_at("_kd_keys", F.element_at(axes, node) + 1) >= F.element_at(cuts, node)).cast("int"),
    )


def _grow(pieces: DataFrame, axis: list[int], cut: list[int], dimensions: int) -> None:
    """Append axis and cut of every node of the next level."""
    nodes = range(len(axis), 2 * len(axis))
    rows = pieces.withColumn("node", _route(axis, cut))
    w = F.col("bytes").cast("double")
    unit = [(F.col("_kd_keys")[n] / float(1 << (_VALUE_BITS + _HASH_BITS))) for n in range(dimensions)]
    moments = [F.sum(w * u).alias(f"s{n}") for n, u in enumerate(unit)]
    moments += [F.sum(w * u * u).alias(f"q{n}") for n, u in enumerate(unit)]
    widest = dict.fromkeys(nodes, 0)
    for row in rows.groupBy("node").agg(F.sum(w).alias("w"), *moments).collect():
        spread = [row[f"q{n}"] / row["w"] - (row[f"s{n}"] / row["w"]) ** 2 for n in range(dimensions)]
        widest[row["node"]] = max(range(dimensions), key=lambda n: (round(spread[n], 9), -n))
    chosen = F.element_at(F.array(*[F.lit(widest[n] + 1) for n in nodes]), F.col("node") - nodes[0] + 1)
    rows = rows.select("node", "bytes", F.element_at("_kd_keys", chosen).alias("key"))
    low, due, last = dict.fromkeys(nodes, 0), {}, dict.fromkeys(nodes, 0)
    bits = _VALUE_BITS + _HASH_BITS
    while bits > 0:
        step_bits = max(0, bits - _STEP_BITS)
        start = F.element_at(F.array(*[F.lit(low[n]).cast("bigint") for n in nodes]), F.col("node") - nodes[0] + 1)
        offset = F.col("key") - start
        inside = rows.where((offset >= 0) & (offset < (1 << bits)))
        counted = inside.groupBy("node", F.shiftright(offset, step_bits).alias("at")).agg(F.sum("bytes").alias("b"))
        cells: dict[int, list] = {n: [] for n in nodes}
        for row in counted.collect():
            cells[row["node"]].append((row["at"], row["b"]))
        for n in nodes:
            due.setdefault(n, sum(b for _, b in cells[n]) / 2)
            for at, b in sorted(cells[n]):
                if due[n] <= b:
                    low[n] += at << step_bits
                    last[n] = b
                    break
                due[n] -= b
        bits = step_bits
    for n in nodes:
        # The key that holds the median goes to the side that makes the halves more even.
        low[n] += due[n] > last[n] / 2
    axis += [widest[n] for n in nodes]
    cut += [low[n] for n in nodes]


def _numbered(placed: DataFrame, tree: KdTree) -> DataFrame:
    """``_slot`` within each shard: rank inside a hashed block plus the rows of the blocks before."""
    order = [c for c in ("doc_id", "_kd_text") if c in placed.columns]
    rows = placed.groupBy("_shard").agg(F.count("*").alias("_kd_rows"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_kd_rows") / tree.slot_rows)).cast("bigint")
    blocked = placed.join(F.broadcast(rows.select("_shard", blocks.alias("_kd_blocks"))), "_shard")
    blocked = blocked.withColumn("_kd_block", F.pmod(F.xxhash64(*order), F.col("_kd_blocks")))
    counts = blocked.groupBy("_shard", "_kd_block").agg(F.count("*").alias("_kd_n"))
    before = Window.partitionBy("_shard").orderBy("_kd_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_shard", "_kd_block", F.coalesce(F.sum("_kd_n").over(before), F.lit(0)).alias("_kd_before"))
    local = F.row_number().over(Window.partitionBy("_shard", "_kd_block").orderBy(*order)) - 1
    numbered = blocked.withColumn("_kd_local", local).join(counts, ["_shard", "_kd_block"])
    return numbered.withColumn("_slot", (F.col("_kd_before") + F.col("_kd_local")).cast("bigint"))
