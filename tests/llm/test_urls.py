import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewatch.llm.queries import QUERIES
from scorewatch.llm.urls import RULES, host_edges, propagate, url_filter, url_parts

from .helpers import SF

URLS = ["http://A.Example.com/en/x?y#z", "https://www.example.com/en/", "http://notexample.com/en/1", "https://x.net/es/q", "ftp://x.net/fr",
        "x.org/no-scheme", "http://", "http://h.org", "http://h.org?a/b", "http://h.org#/en/", None, "", "a://b://c/d", "http://É.NET/es/", "http://net/fr/1",
        "http://user@Host.com:80/a/b?c", "http://x.com\n/en/", "http://www.EXAMPLE.com/EN/", "http://deep.www.example.com/en/a", "http://xcom/"]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


def plain_rule(host, path):
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0])) if fits else (None, None)


def pages(spark, urls, html="<p>"):
    return spark.createDataFrame([(i, u, html, "h", "r", 1.0) for i, u in enumerate(urls)],
                                 "page_id long, url string, html string, host string, rule string, trust double")


def test_parts_and_rules(spark):
    host, path = url_parts(F.col("url"))
    rows = pages(spark, URLS).select("url", host.alias("h"), path.alias("p")).collect()
    assert [(r.h, r.p) for r in rows] == [plain_parts(u) for u in URLS]
    for r in url_filter(pages(spark, URLS)).collect():
        assert (r.host, r.path) == plain_parts(URLS[r.page_id])
        rule, verdict = plain_rule(r.host, r.path)
        assert r.rule == rule and (verdict is None or r.verdict == verdict) and r.verdict in ("allow", "block")
        if not r.host:
            assert r.verdict == "allow"


def plain_rank(edges, seeds, rounds=20, damping=0.85):
    """Personalised PageRank with a dense matrix; lost flow returns to the seeds."""
    hosts = sorted({h for e in edges for h in e[:2]} | set(seeds))
    at = {h: i for i, h in enumerate(hosts)}
    m = np.zeros((len(hosts), len(hosts)))
    for a, b, w in edges:
        m[at[a], at[b]] += w
    out = m.sum(axis=1, keepdims=True)
    m = np.divide(m, out, out=np.zeros_like(m), where=out > 0)
    s = np.zeros(len(hosts))
    for h, w in seeds.items():
        s[at[h]] += w
    s /= s.sum()
    r = s.copy()
    for _ in range(rounds):
        r = damping * (r @ m) + (1 - damping) * s
    return {h: r[i] / r.sum() for h, i in at.items() if r[i] > 0}


def test_propagation_equals_the_matrix_form(spark):
    rng = random.Random(1)
    edges = list({(f"h{rng.randrange(30)}", f"h{rng.randrange(40)}"): float(rng.randint(1, 4)) for _ in range(120)}.items())
    edges = [(a, b, w) for (a, b), w in edges] + [(f"leaf{i}", "hub", 1.0) for i in range(40)] + [("hub", f"leaf{i}", 1.0) for i in range(40)]
    seeds = {"h1": 3.0, "h2": 1.0, "leaf3": 2.0}
    rows = propagate(spark.createDataFrame([("trust", *e) for e in edges], "kind string, src string, dst string, weight double"),
                     spark.createDataFrame([("trust", h, w) for h, w in seeds.items()], "kind string, host string, weight double")).collect()
    want = plain_rank(edges, seeds)
    assert {r.host for r in rows if r.score > 0} == set(want)
    assert all(r.score == pytest.approx(want.get(r.host, 0)) for r in rows)


def test_edges_from_links_and_parents(spark):
    html = """<a href="https://Other.org/x">a</a> <a href='//cdn.example.com/y'> <img SRC=http://pics.net/z.png> <a href="/local">
              <a href="https://other.org/again"> <a href="mailto:x@y.z"> <a href="http://www.a.b.org/self">"""
    df = spark.createDataFrame([(1, "www.a.b.org", html), (2, "www.a.b.org", html), (3, "solo", None), (4, "", html), (5, None, "")],
                               "page_id long, host string, html string")
    found = {(r.src, r.dst): r.weight for r in host_edges(df.fillna("", ["host"]), "host", "html").collect()}
    up = [("www.a.b.org", "a.b.org"), ("a.b.org", "b.org")]
    assert found == {**{("www.a.b.org", h): 2.0 for h in ("other.org", "cdn.example.com", "pics.net")},
                     **{e: 1.0 for e in up}, **{(b, a): 1.0 for a, b in up}}


def test_trust_and_distrust_decide(spark):
    good, bad = '<a href="http://friend.org/">', '<a href="http://evil.net/es/1">'
    rows = [(1, "http://ok.com/1", good), (2, "http://friend.org/", ""), (3, "http://evil.net/es/1", ""), (4, "http://linker.org/1", bad),
            (5, "http://evil.net/home", ""), (6, "http://unknown.org/", None), (None, None, None), (1, "http://ok.com/1", good)]
    found = url_filter(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    verdict = {r.page_id: r.verdict for r in found}
    assert len(found) == len(rows)
    assert verdict == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "block", 6: "allow", None: "allow"}


def test_empty_table(spark):
    assert url_filter(pages(spark, URLS).limit(0)).collect() == []


def test_query_against_brute_force(spark):
    rows = QUERIES["op5_link_trust"](spark, SF).collect()
    given = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    parts = {p: plain_parts(r.url) for p, r in given.items()}
    ruled = {p: plain_rule(*x) for p, x in parts.items()}
    edges = {}
    for host in {h for h, _ in parts.values() if h}:
        names = host.split(".")
        for i in range(len(names) - 2):
            a, b = ".".join(names[i:]), ".".join(names[i + 1:])
            edges[(a, b)] = edges[(b, a)] = 1.0
    seeds = {"allow": {}, "block": {}}
    for p, (_, v) in ruled.items():
        if v and parts[p][0]:
            seeds[v][parts[p][0]] = seeds[v].get(parts[p][0], 0) + 1
    trust = plain_rank([(*e, w) for e, w in edges.items()], seeds["allow"])
    distrust = plain_rank([(b, a, w) for (a, b), w in edges.items()], seeds["block"])
    assert {r.page_id for r in rows} == set(given)
    for r in rows:
        t, d = trust.get(r.host, 0), distrust.get(r.host, 0)
        assert (r.host, r.path, r.rule) == (*parts[r.page_id], ruled[r.page_id][0])
        assert r.trust == pytest.approx(t) and r.distrust == pytest.approx(d)
        assert r.verdict == (ruled[r.page_id][1] or ("block" if d > t else "allow"))
