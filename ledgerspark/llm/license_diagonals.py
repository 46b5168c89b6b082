"""Operator 3, license scans: k-gram hits vote for offset diagonals of license templates."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Phrases and labels of the base rule.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices that the method looks for, lower-cased words only, with their labels.
TEMPLATES = {
    "apache": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related rights",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "lgpl": "licensed under the gnu lesser general public license",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
#: Full notices and short forms of the restricted variants; the label is the name up to the first blank.
VARIANTS = {
    f"cc-by-{'-'.join(codes)} {form}": text
    for codes, names in (
        (("nc",), "noncommercial"),
        (("sa",), "sharealike"),
        (("nd",), "noderivatives"),
        (("nc", "sa"), "noncommercial sharealike"),
        (("nc", "nd"), "noncommercial noderivatives"),
    )
    for form, text in (
        ("notice", f"this work is licensed under a creative commons attribution {names} 4 0 international license"),
        ("short", f"licensed under cc by {' '.join(codes)} 4 0"),
    )
    if f"licensed under cc by {' '.join(codes)} 4 0" not in TEMPLATES.values() or form == "notice"
}
K = 3
_WORD_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Voting:
    templates: dict[str, str] = field(default_factory=lambda: {**TEMPLATES, **VARIANTS})
    phrases: dict[str, str] = field(default_factory=lambda: dict(BASE_PHRASES))
    #: Diagonals up to so many words apart are one span: words put in or left out.
    merge: int = 3
    #: Of overlapping spans of templates with this beginning, the one that explains most words counts alone.
    rivals: str = "cc-by"
    #: Template words that a span must match, in percent.
    percent: int = 70


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # Only the first and the last part can be empty.
    return F.array_remove(F.split(lower, _WORD_GAPS), "")


def template_grams(spark: SparkSession, voting: Voting) -> DataFrame:
    """All k-grams of the templates: ``t_hash, t0..t2, template, at, length, lead``. Its size is that of a constant.

    ``lead`` marks one row of each k-gram.
    """
    rows, seen = [], set()
    for label, content in voting.templates.items():
        parts = content.split()
        for i in range(len(parts) - K + 1):
            gram = tuple(parts[i : i + K])
            rows.append((*gram, label, i, len(parts), gram not in seen))
            seen.add(gram)
    schema = "t0 string, t1 string, t2 string, template string, at int, length int, lead boolean"
    return spark.createDataFrame(rows, schema).withColumn("t_hash", F.xxhash64("t0", "t1", "t2"))


def scan_licenses(docs: DataFrame, voting: Voting = Voting()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    Every place of a text yields the hash of its ``K`` words, which is joined with the places of the templates
    (a broadcast of fixed size; the words are compared too). A hit votes for the diagonal place - template
    place. Votes are added up per document, template and diagonal; diagonals at most ``merge`` apart are
    merged; a merged span counts if its hits cover ``percent`` of the template's words, and if no overlapping span of a
    rival template covers more words (of as many, a larger share). ``spans`` are
    (template, first word, last word, share). ``score`` is 1 with a base place, else the largest share of a span that counts, or 0.

    Null and empty texts have no words: counts 0, labels empty, first and last null. Rows are told apart by a
    number of their own, so repeated rows and null ids each give a row. An empty table gives an empty table; other
    columns are not read.
    """
    width = max(K, *(len(p.split()) for p in voting.phrases))
    listed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("w"))
    later = [F.slice("w", i + 1, F.greatest(F.size("w"), F.lit(1))).alias(f"g{i}") for i in range(width)]
    zipped = listed.select("row", "doc_id", F.size("w").alias("n_words"), F.posexplode_outer(F.arrays_zip(*later)))
    grams = zipped.select(
        "row", "doc_id", "n_words", F.coalesce("pos", F.lit(0)).alias("pos"), *[f"col.g{i}" for i in range(width)]
    )
    base = F.lit(None).cast("string")
    for phrase, label in voting.phrases.items():
        same = F.lit(True)
        for i, word in enumerate(phrase.split()):
            same = same & (F.col(f"g{i}") == word)
        base = F.when(same, F.lit(label)).otherwise(base)
    grams = grams.withColumn("base", base).withColumn("hash", F.xxhash64("g0", "g1", "g2"))
    met = F.col("hash") == F.col("t_hash")
    for i in range(K):
        met = met & (F.col(f"g{i}") == F.col(f"t{i}"))
    known = F.broadcast(template_grams(docs.sparkSession, voting))
    hits = grams.join(known, met, "left").where("pos = 0 or base is not null or template is not null")

    # A place with several template rows is one base place: that of the leading row.
    is_base = F.col("base").isNotNull() & F.coalesce("lead", F.lit(True))
    base_figures = [
        F.sum(is_base.cast("bigint")).alias("n_base"),
        F.min(F.when(is_base, F.col("pos"))).alias("first_word"),
        F.max(F.when(is_base, F.col("pos"))).alias("last_word"),
        F.collect_set(F.when(is_base, F.col("base"))).alias("base_labels"),
    ]
    row = ["row", "doc_id", "n_words"]
    diagonals = hits.groupBy(*row, "template", "length", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("places"), F.min("pos").alias("begin"), F.max("pos").alias("end"), *base_figures
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(along) > voting.merge
    diagonals = diagonals.withColumn("apart", F.coalesce(far.cast("int"), F.lit(0)))
    diagonals = diagonals.withColumn("band", F.sum("apart").over(along))
    covers = F.array_distinct(
        F.flatten(F.transform(F.flatten(F.collect_list("places")), lambda at: F.sequence(at, at + (K - 1))))
    )
    merged = diagonals.groupBy(*row, "template", "length", "band").agg(
        (F.size(covers) / F.max("length")).alias("share"),
        F.size(covers).alias("explains"),
        F.min("begin").alias("begin"),
        (F.max("end") + (K - 1)).alias("end"),
        F.sum("n_base").alias("n_base"),
        F.min("first_word").alias("first_word"),
        F.max("last_word").alias("last_word"),
        F.array_distinct(F.flatten(F.collect_list("base_labels"))).alias("base_labels"),
    )
    counts = F.col("template").isNotNull() & (F.col("share") * 100 >= voting.percent)
    label = F.substring_index("template", " ", 1).alias("template")
    span = F.struct(label, "begin", "end", "share", "explains")
    total = merged.groupBy(*row).agg(
        F.sum("n_base").alias("n_base"),
        F.min("first_word").cast("bigint").alias("first_word"),
        F.max("last_word").cast("bigint").alias("last_word"),
        F.array_distinct(F.flatten(F.collect_list("base_labels"))).alias("base"),
        F.sort_array(F.collect_list(F.when(counts, span))).alias("spans"),
    )
    better = lambda s, t: (
        (t["begin"] <= s["end"])
        & (s["begin"] <= t["end"])
        & ((t["explains"] > s["explains"]) | ((t["explains"] == s["explains"]) & (t["share"] > s["share"])))
    )
    rival = lambda s: s["template"].startswith(voting.rivals)
    total = total.withColumn("rivals", F.filter("spans", rival))
    won = F.filter("spans", lambda s: ~rival(s) | ~F.exists("rivals", lambda t: better(s, t)))
    names = ("template", "begin", "end", "share")
    total = total.withColumn("spans", F.transform(won, lambda s: F.struct(*[s[n].alias(n) for n in names])))
    total = total.withColumn("found", F.array_distinct(F.transform("spans", lambda s: s["template"])))
    total = total.withColumn("share", F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)))
    return total.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "found")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.col("share")).alias("score"),
        "spans",
    )
