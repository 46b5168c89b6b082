"""Operator 10, mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.scratch import written

BLANK_WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights of the sources in order, most copies, and the seed of the random numbers."""

    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3
    seed: str = "mix"
    #: Documents of one step of the rank histogram.
    step_rows: int = 2_000
    #: The odds of a document are at most so many times those of one of its source's mean size, or one in so many.
    spread: int = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_WORD)), F.lit(0)).cast("bigint")


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number inside (0, 1) that depends on the seed and the id alone, without id on the text: 52 bits of an MD5 sum."""
    own = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), text), F.lit("null"))
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), own)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_size, target`` from one row per source (``source, source_size``).

    Sources are weighted by their place in code point order, null last. A source stops at ``most`` times its
    size; what is above goes to the others by weight until none is above: with the sources in the order
    of size by weight, those that stop are the first ones. The frame has a row per source, never one per document.
    """
    weights = F.array(*[F.lit(w) for w in mix.weights])
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    cap = F.col("source_size").cast("decimal(38,0)") * mix.most
    ranked = (
        sizes.withColumn("place", place)
        .withColumn("weight", F.element_at(weights, (F.col("place") % len(mix.weights) + 1).cast("int")).cast("decimal(10,0)"))
        .withColumn("cap", cap)
    )
    before = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), "place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("decimal(38,0)")
    ranked = (
        ranked.withColumn("all_size", F.sum("source_size").over(every))
        .withColumn("all_weight", F.sum("weight").over(every))
        .withColumn("rest_size", F.col("all_size") - F.coalesce(F.sum("cap").over(before), zero))
        .withColumn("rest_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), zero))
    )
    # Compared as whole numbers: cap / weight < rest_size / rest_weight. The first source that fits ends it.
    stops = F.col("cap") * F.col("rest_weight") < F.col("rest_size") * F.col("weight")
    ranked = ranked.withColumn("stops", stops)
    for name in ("size", "weight"):
        ranked = ranked.withColumn(f"share_{name}", F.max(F.when(~F.col("stops"), F.col(f"rest_{name}"))).over(every))
    shared = F.col("weight").cast("double") * F.col("share_size").cast("double") / F.col("share_weight").cast("double")
    return ranked.select(
        "source",
        "source_size",
        F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(shared).alias("target"),
    )


def _own_names(docs: DataFrame) -> list[str]:
    """Columns of ``docs`` whose names the operator uses itself."""
    names = ("_size", "_source_size", "_target", "_copies")
    return [c for c in docs.columns if c in names or c.startswith("_mix_")]


def inclusion_odds(size: Column, source_size: Column, source_rows: Column, mix: Mix = Mix()) -> Column:
    """Odds of a document against those of one of its source's mean size: its share of that, at most ``spread`` times more or less."""
    share = size * source_rows.cast("double") / source_size.cast("double")
    bounded = F.least(F.greatest(share, F.lit(1.0 / mix.spread)), F.lit(float(mix.spread)))
    return F.when(source_size > 0, bounded).otherwise(F.lit(1.0))


def _thresholds(numbers: DataFrame, targets: DataFrame) -> DataFrame:
    """``_mix_s, _mix_last, _mix_last_size, _mix_tied, _mix_from_tied``: the last key that each source takes.

    A key is a rank and a size. All documents with smaller keys are taken; of the ``_mix_tied`` ones with this key
    ``_mix_from_tied`` are. A histogram of ranks tells the step in which a source's words are met, and
    only the keys of that step are sorted.
    """
    wanted = targets.select("_mix_s", "_mix_due", "_mix_steps")
    rank = F.col("_mix_rank")
    step = F.least(F.floor(rank / (F.lit(1.0) + rank) * F.col("_mix_steps")), F.col("_mix_steps") - 1).cast("bigint")
    stepped = numbers.join(wanted, F.col("source").eqNullSafe(F.col("_mix_s"))).drop("source").withColumn("_mix_step", step)
    steps = stepped.groupBy("_mix_s", "_mix_step").agg(F.sum("_size").alias("_mix_words"), F.first("_mix_due").alias("_mix_step_due"))
    earlier = Window.partitionBy("_mix_s").orderBy("_mix_step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("_mix_before", F.coalesce(F.sum("_mix_words").over(earlier), F.lit(0)))
    # The met step: words before it fall short, words with it do not.
    met = steps.where("_mix_before < _mix_step_due").groupBy("_mix_s").agg(F.max(F.struct("_mix_step", "_mix_before")).alias("_mix_met"))
    met = met.select(F.col("_mix_s").alias("_mix_m"), "_mix_met._mix_step", F.col("_mix_met._mix_before").alias("_mix_start"))
    # One row per source, written, so that its size decides the join: rows of a hot source move nowhere.
    met = written(numbers.sparkSession, met, "mix-met")
    inside = stepped.join(
        met.withColumnRenamed("_mix_step", "_mix_at"),
        F.col("_mix_s").eqNullSafe(F.col("_mix_m")) & (F.col("_mix_step") == F.col("_mix_at")),
    )
    inside = inside.groupBy("_mix_s", "_mix_due", "_mix_start", "_mix_rank", "_size").agg(F.count("*").alias("_mix_n"))
    words = F.col("_size") * F.col("_mix_n")
    order = Window.partitionBy("_mix_s").orderBy("_mix_rank", "_size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_mix_due") - F.col("_mix_start") - F.coalesce(F.sum(words).over(order), F.lit(0))
    # Equal keys follow one another: one more is taken while its middle lies below the words due.
    fitting = F.when(F.col("_size") > 0, F.floor(F.col("left") / F.col("_size") + 0.5)).otherwise(F.col("_mix_n"))
    taken = (
        inside.select("_mix_s", "_mix_rank", "_size", "_mix_n", left.alias("left"))
        .where("left >= _size / 2.0")
        .select("_mix_s", F.struct("_mix_rank", "_size", "_mix_n", F.least("_mix_n", fitting).cast("bigint").alias("_mix_fit")).alias("last"))
        .groupBy("_mix_s")
        .agg(F.max("last").alias("last"))
    )
    # Without a key of the met step all documents of earlier steps are taken: those of a smaller rank than the step's.
    edge = met.join(wanted, F.col("_mix_m").eqNullSafe(F.col("_mix_s"))).select(
        "_mix_m", (F.col("_mix_step") / (F.col("_mix_steps") - F.col("_mix_step"))).alias("_mix_edge")
    )
    return edge.join(taken, F.col("_mix_m").eqNullSafe(F.col("_mix_s")), "left").select(
        F.col("_mix_m").alias("_mix_s"),
        F.coalesce("last._mix_rank", "_mix_edge").alias("_mix_last"),
        F.coalesce("last._size", F.lit(-1)).alias("_mix_last_size"),
        F.coalesce("last._mix_n", F.lit(0)).alias("_mix_tied"),
        F.coalesce("last._mix_fit", F.lit(0)).alias("_mix_from_tied"),
    )


def mix_sources(docs: DataFrame, mix: Mix = Mix(), keep_text: bool = True) -> DataFrame:
    """``docs`` with ``_size, _source_size, _target, _copies``: how often the mix takes each document.

    With a share of target to size of r, every document of a source comes in floor(r) whole copies for
    certain. The rest is a Pareto order sample with unequal probabilities: documents are ranked by u / (1 - u), u random from
    the id, divided by their inclusion odds, and taken from the smallest on until the source's words
    are met: one more copy while the middle of the document lies below the words still due. Inclusion odds grow with
    the size (``inclusion_odds``); a factor common to a source, which its target sets, does not change the order.
    So each source misses its target by half a document at most, and reruns agree.

    Ids' random numbers and sizes are written to a table first. One threshold per source comes out of it, and the documents
    are compared with that where they lie: no text is in an exchange, but for repeated rows (equal in id and size) that
    a threshold falls on, of which only some are taken. Documents without words take part with size 0; a null source
    is one source; documents without id get their random number from the text. An empty table gives an empty
    table. Columns of the four names are replaced, those that begin with ``_mix_`` are dropped; all others are kept.
    """
    spark = docs.sparkSession
    u = uniform(F.col("doc_id"), F.col("text"), mix.seed)
    counted = docs.drop(*_own_names(docs)).withColumns({"_size": word_count(F.col("text")), "_mix_u": u})
    numbers = written(spark, counted.select("source", "_size", "_mix_u"), "mix-numbers")
    totals = numbers.groupBy("source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("source_rows"))
    # One row per source, used three times.
    totals = written(spark, totals, "mix-sources")
    targets = source_targets(totals.select("source", "source_size"), mix).select(
        F.col("source").alias("_mix_s"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target")
    )
    rows = totals.select(F.col("source").alias("_mix_r"), F.col("source_rows").alias("_mix_rows"))
    targets = targets.join(rows, F.col("_mix_s").eqNullSafe(F.col("_mix_r"))).drop("_mix_r")
    ratio = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    whole = F.least(F.floor(ratio), F.lit(mix.most)).cast("bigint")
    targets = (
        targets.withColumn("_mix_whole", whole)
        .withColumn("_mix_due", F.col("_target") - F.col("_mix_whole") * F.col("_source_size"))
        .withColumn("_mix_steps", F.greatest(F.lit(1), F.ceil(F.col("_mix_rows") / mix.step_rows)).cast("bigint"))
    )
    targets = written(spark, targets, "mix-targets")
    odds = inclusion_odds(F.col("_size"), F.col("_source_size"), F.col("_mix_rows"), mix)
    rank = F.col("_mix_u") / (F.lit(1.0) - F.col("_mix_u")) / odds

    def ranked(frame: DataFrame, per_source: DataFrame) -> DataFrame:
        return frame.join(per_source, F.col("source").eqNullSafe(F.col("_mix_s"))).withColumn("_mix_rank", rank)

    of_sources = targets.select("_mix_s", "_source_size", "_mix_rows")
    last = _thresholds(ranked(numbers, of_sources).select("source", "_mix_rank", "_size"), targets)
    last = last.withColumnRenamed("_mix_s", "_mix_l")
    decided = targets.join(last, F.col("_mix_s").eqNullSafe(F.col("_mix_l")), "left").drop("_mix_l", "_mix_due", "_mix_steps")
    decided = written(spark, decided, "mix-thresholds")
    drawn = ranked(counted if keep_text else counted.drop("text"), decided)
    last_key = F.struct(F.col("_mix_last"), F.col("_mix_last_size").cast("bigint"))
    key = F.struct(F.col("_mix_rank"), F.col("_size"))
    split = F.coalesce(F.col("_mix_from_tied") < F.col("_mix_tied"), F.lit(False))
    at_split = split & (F.col("_mix_rank") == F.col("_mix_last")) & (F.col("_size") == F.col("_mix_last_size"))
    extra = F.coalesce((key <= last_key).cast("bigint"), F.lit(0))
    if decided.where(split).isEmpty():
        drawn = drawn.withColumn("_copies", F.col("_mix_whole") + extra)
    else:
        whole_keys = drawn.where(~at_split).withColumn("_copies", F.col("_mix_whole") + extra)
        place = F.row_number().over(Window.partitionBy("_mix_s").orderBy("_mix_rank"))
        some = (place <= F.col("_mix_from_tied")).cast("bigint")
        drawn = whole_keys.unionByName(drawn.where(at_split).withColumn("_copies", F.col("_mix_whole") + some))
    return drawn.drop(*[c for c in drawn.columns if c.startswith("_mix_")])


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: a document taken n times is n rows, columns as before, whatever their names."""
    aside = {c: f"own{i}{c}" for i, c in enumerate(_own_names(docs))}
    taken = mix_sources(docs.withColumnsRenamed(aside), mix).where("_copies > 0")
    rows = taken.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return rows.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
