"""Operator 1, URL filters: trust and distrust propagated over the links between hosts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.scratch import Rounds, written

#: Rules as (rule, verdict); a rule is a host and the beginning of a path.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Propagation:
    #: Rounds of the SQL form, which has no loop until scores settle.
    rounds: int = 12
    damping: float = 0.85
    #: A host is blocked if its distrust is over so many times its trust. ``least`` is a floor in the SQL form only: scores
    #: shrink with the graph, so a fixed floor would change verdicts by its size.
    ratio: float = 1.0
    least: float = 1e-6
    #: Rounds go on while any score grows by more than this share of it.
    settled: float = 1e-4
    rules: tuple[tuple[str, str], ...] = RULES


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, _, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def link_hosts(html: Column) -> Column:
    """Hosts that absolute and protocol-relative ``href`` values name, A-Z lower-cased."""
    pattern = r"""\b[hH][rR][eE][fF][\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?[\x20\x09-\x0D]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'\x20\x09-\x0D>]+)"""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), F.lit(1))
    return F.transform(found, lambda h: F.translate(h, _UPPER, _LOWER))


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: links from one host to another, counted before they are shuffled."""
    listed = pages.select(F.col("host").alias("src"), F.explode("links").alias("dst"))
    return listed.where("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, p: Propagation) -> DataFrame:
    """``host, trust, distrust``: personalised PageRank from the trusted seeds along the links, and from the blocked
    seeds against them.

    ``edges`` are ``src, dst, n``, ``seeds`` are ``host, trusted, blocked`` with seed masses. A host hands its
    trust on by the share of its links, and its distrust back by the share of links to it. Rounds go on until
    no score grows by more than ``settled`` of it, so every host that a seed reaches has a score. Every round joins and adds up by host, with map-side combine, and is written to the shared folder. Hosts without seeds and
    links are left out.
    """
    spark = edges.sparkSession
    out_sum = edges.groupBy(F.col("src").alias("o")).agg(F.sum("n").alias("out_n"))
    in_sum = edges.groupBy(F.col("dst").alias("i")).agg(F.sum("n").alias("in_n"))
    weighted = edges.join(out_sum, F.col("src") == F.col("o")).join(in_sum, F.col("dst") == F.col("i"))
    moves = written(
        spark,
        weighted.select(
            "src", "dst", (F.col("n") / F.col("out_n")).alias("forth"), (F.col("n") / F.col("in_n")).alias("back")
        ),
        "trust-edges",
    )
    keep = 1.0 - p.damping
    seeds = seeds.select("host", (F.col("trusted") * keep).alias("t0"), (F.col("blocked") * keep).alias("d0"))
    scores = seeds.select("host", F.col("t0").alias("trust"), F.col("d0").alias("distrust"))
    if not moves.take(1):
        # Nothing is handed on, so every round gives the same.
        return scores
    rounds = Rounds(spark, "trust-round")
    none = [F.lit(0.0).alias("t_last"), F.lit(0.0).alias("d_last")]
    growing = True
    while growing:
        forth = moves.join(scores, F.col("src") == F.col("host")).select(
            F.col("dst").alias("to"), (F.col("forth") * F.col("trust") * p.damping).alias("t"), F.lit(0.0).alias("d"), *none
        )
        back = moves.join(scores, F.col("dst") == F.col("host")).select(
            F.col("src").alias("to"), F.lit(0.0).alias("t"), (F.col("back") * F.col("distrust") * p.damping).alias("d"), *none
        )
        own = seeds.select(F.col("host").alias("to"), F.col("t0").alias("t"), F.col("d0").alias("d"), *none)
        last = scores.select(
            F.col("host").alias("to"), F.lit(0.0).alias("t"), F.lit(0.0).alias("d"), F.col("trust").alias("t_last"), F.col("distrust").alias("d_last")
        )
        new = forth.unionByName(back).unionByName(own).unionByName(last).groupBy(F.col("to").alias("host"))
        sums = [F.sum(c).alias(n) for c, n in (("t", "trust"), ("d", "distrust"), ("t_last", "t_last"), ("d_last", "d_last"))]
        scores = rounds.put(new.agg(*sums))
        grown = [F.col(now) > F.col(was) * (1.0 + p.settled) for now, was in (("trust", "t_last"), ("distrust", "d_last"))]
        growing = bool(scores.where(grown[0] | grown[1]).take(1))
        scores = scores.select("host", "trust", "distrust")
    return scores


def judge_urls(pages: DataFrame, p: Propagation = Propagation()) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, trust, distrust``.

    A page with a rule has the rule's verdict. Seeds are the hosts of such pages, trusted or blocked by the share of
    the host's pages. All other pages have their host's verdict: block if its distrust exceeds
    its trust, else allow. The tables that are joined have one row per host.

    Null URLs and those without ``://`` have empty host and path, no rule, and are allowed. Null HTML has no links.
    Repeated rows are judged alike; an empty table gives an empty table; other columns are not read.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, says = matching_rule(F.col("host"), F.col("path"), p.rules)
    ruled = parsed.withColumn("rule", rule).withColumn("says", says)
    seen = written(
        spark,
        ruled.withColumn("links", link_hosts(F.col("html"))).drop("html"),
        "trust-pages",
    )
    share = [F.avg((F.col("says").eqNullSafe(v)).cast("double")).alias(n) for v, n in (("allow", "trusted"), ("block", "blocked"))]
    seeds = seen.where("host <> ''").groupBy("host").agg(*share)
    seeds = seeds.where("trusted > 0 or blocked > 0")
    scores = propagate(host_edges(seen), seeds, p)
    scores = scores.withColumnRenamed("host", "of")
    bad = F.col("distrust") > F.col("trust") * p.ratio
    method = F.when(F.coalesce(bad, F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return seen.join(scores, F.col("host") == F.col("of"), "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("says", method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
