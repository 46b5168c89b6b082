"""Operator 1: scores and verdicts against a plain PageRank, URL parts, edge cases."""

import re

import pytest

from ledgerspark.llm.link_trust import Propagation, judge_urls

PAGES = "page_id bigint, url string, html string, host string"


def link(*hosts):
    return " ".join(f'<a href="http://{h}/x">y</a>' for h in hosts)


def brute(rows, seeds_t, seeds_d, p):
    edges = {}
    for url, html in rows:
        src = re.match(".*?://([^/?#]*)", url)[1].lower()
        for dst in re.findall('href="(?:http:)?//([^/"]+)', html or ""):
            if dst.lower() != src:
                edges[src, dst.lower()] = edges.get((src, dst.lower()), 0) + 1
    t, d = ({h: s * (1 - p.damping) for h, s in seeds.items()} for seeds in (seeds_t, seeds_d))
    for _ in range(p.rounds):
        nt = {h: s * (1 - p.damping) for h, s in seeds_t.items()}
        nd = {h: s * (1 - p.damping) for h, s in seeds_d.items()}
        for (a, b), n in edges.items():
            out = sum(m for (x, _), m in edges.items() if x == a)
            into = sum(m for (_, y), m in edges.items() if y == b)
            nt[b] = nt.get(b, 0) + p.damping * t.get(a, 0) * n / out
            nd[a] = nd.get(a, 0) + p.damping * d.get(b, 0) * n / into
        t, d = nt, nd
    return t, d


def test_propagation_matches_brute_force(spark):
    p = Propagation()
    rows = [
        ("http://good.example.net/en/1", link("friend.com", "other.com")),
        ("http://friend.com/1", link("other.com", "FRIEND.com", "far.com")),
        ("http://spam.com/1", link("bad.net", "bad.net", "other.com")),
        ("http://helper.com/", link("spam.com") + ' <a href="//bad.net/q">z</a> <A HREF="/local">l</A>'),
        ("http://bad.net/", link("friend.com")),
        ("http://far.com/", None),
        ("http://alone.com/", ""),
    ]
    got = judge_urls(spark.createDataFrame([(i, u, h, "x") for i, (u, h) in enumerate(rows)], PAGES)).collect()
    t, d = brute(rows, {"good.example.net": 1.0}, {"bad.net": 1.0}, p)
    for r in got:
        assert r["trust"] == pytest.approx(t.get(r["host"], 0), abs=1e-12)
        assert r["distrust"] == pytest.approx(d.get(r["host"], 0), abs=1e-12)
    verdict = {r["host"]: r["verdict"] for r in got}
    assert verdict["spam.com"] == verdict["helper.com"] == verdict["bad.net"] == "block"
    assert verdict["friend.com"] == verdict["far.com"] == verdict["alone.com"] == verdict["good.example.net"] == "allow"


def test_rules_and_parts(spark):
    urls = {
        "HTTP://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://net/x": ("net", "/x", "net/", "block"),
        "http://planet/x": ("planet", "/x", None, "allow"),
        "http://x.net": ("x.net", "", None, None),
        "http://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"),
        "http://x.example.com/de/1": ("x.example.com", "/de/1", "example.com/de/", "block"),
        "a://b?c://d/e": ("b", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://x\ny.com/a\nb#c": ("x\ny.com", "/a\nb", None, "allow"),
    }
    rows = [(i, u, None, "x") for i, u in enumerate(urls)] * 2
    got = judge_urls(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == len(rows)
    expected = list(urls.values())
    for r in got:
        host, path, rule, verdict = expected[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict is None or r["verdict"] == verdict
    assert judge_urls(spark.createDataFrame([], PAGES)).count() == 0


def test_verdicts_do_not_change_with_the_size_of_a_farm_or_the_length_of_a_chain(spark):
    farm = spark.range(200_000).selectExpr("id AS page_id", "concat('http://s', id, '.com/') AS url", """'<a href="http://bad.net/x">y</a>' AS html""", "'x' AS host")
    chain = [(300_000 + i, f"http://c{i}.com/", link(f"c{i + 1}.com" if i < 19 else "worse.net"), "x") for i in range(20)]
    seeds = [(400_000, "http://bad.net/", None, "x"), (400_001, "http://worse.net/", None, "x"), (400_002, "http://fine.com/", link("far.com"), "x")]
    got = judge_urls(farm.unionByName(spark.createDataFrame(chain + seeds, PAGES)))
    counted = {(r["verdict"]): r["count"] for r in got.groupBy("verdict").count().collect()}
    assert counted == {"block": 200_022, "allow": 1}
