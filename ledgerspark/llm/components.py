"""Connected components of a link table, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.scratch import Rounds


def smallest_reachable(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``id, label`` for every id in ``links`` (``a, b``): the smallest id that can be reached.

    Alternates large-star and small-star steps, which need a number of rounds that grows with the logarithm
    of the longest path. Each round is two aggregations and joins on ids with map-side combine, and is
    written to the shared scratch folder in place of the one before. Links to itself, repeated links and an empty table are fine; null
    ends are left out.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    rounds = Rounds(spark, "components")
    edges = rounds.put(edges)
    while True:
        # Large star: every larger neighbour of v goes to the smallest neighbour of v (or v itself).
        both = edges.select(F.col("lo").alias("v"), F.col("hi").alias("w")).union(edges.select("hi", "lo"))
        least = both.groupBy("v").agg(F.min("w").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.where("w > v").join(least, "v").select(F.col("m").alias("lo"), F.col("w").alias("hi")).distinct()
        # Small star: every smaller neighbour of v, and v, go to the smallest of them.
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(least, "hi")
        small = joined.select(F.col("m").alias("lo"), F.col("lo").alias("hi")).union(joined.select("m", "hi"))
        nxt = rounds.put(small.where("lo <> hi").distinct())
        # Done when every id has one link, to a root, and no root has a smaller neighbour.
        crossed = nxt.select(F.col("lo").alias("id")).join(nxt.select(F.col("hi").alias("id")), "id", "left_semi")
        several = nxt.groupBy("hi").agg(F.count("*").alias("n")).where("n > 1").select(F.col("hi").alias("id"))
        edges = nxt
        if not crossed.union(several).take(1):
            break
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("label")).distinct()
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("label")).union(roots)
