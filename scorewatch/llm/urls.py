"""URL filter: longest-match rules, then link-graph propagation (operator 5).

A url's host and path are matched against allow and block rules (a rule fits
its host and all subdomains if the path starts with the rule's path; the
longest rule wins). Urls that no rule fits are judged by their host: hosts
with allowed pages are trusted seeds, hosts with blocked pages are blocked
seeds (weight: number of such pages). Personalised PageRank carries trust
along host edges from the trusted seeds and distrust along reversed edges
from the blocked seeds; a host is blocked where distrust's share of the two
exceeds the threshold, and allowed otherwise, also where neither reaches it.

Host edges: absolute links in the pages, weighted by linking pages, and an
edge each way between a host and its parent domain (a site vouches for its
subdomains and is judged by them), which links hosts also where pages hold
relative links only.

Defined cases: a null url, or one without ``://``, has empty host and path,
fits no rule and is allowed; null or empty html has no links; repeated and
null ids are kept, one row each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage
from .common import ascii_lower, table

#: (host, path, verdict)
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]

_LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    text = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(text, "://") > 0, F.regexp_replace(text, r"(?s)^.*?://", "")).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rules(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Rule text (host + path) and verdict of the longest fitting rule, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):   # the longest is tested first
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule, verdict = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, host_col: str, html_col: str) -> DataFrame:
    """(src, dst, weight): absolute links between hosts, and host <-> parent domain."""
    links = (pages.select(F.col(host_col).alias("src"), F.explode(F.array_distinct(F.transform(
                 F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_LINK), F.lit(1)), ascii_lower))).alias("dst"))
             .where("src != '' AND dst != '' AND src != dst"))
    # Every domain above a host that still has a dot, one step at a time.
    labels = F.split("src", r"\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    steps = (pages.select(F.col(host_col).alias("src")).where("src LIKE '%.%.%'").distinct()
             .select(F.explode(F.arrays_zip(F.slice(chain, 1, F.size(chain) - 1).alias("child"),
                                            F.slice(chain, 2, F.size(chain)).alias("parent"))).alias("s"))
             .select("s.child", "s.parent").distinct())
    up = steps.select(F.col("child").alias("src"), F.col("parent").alias("dst"))
    down = steps.select(F.col("parent").alias("src"), F.col("child").alias("dst"))
    return links.union(up).union(down).groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 20, cut_every: int = 5) -> DataFrame:
    """(kind, host, score): personalised PageRank of each kind, scores of a kind sum to one.

    ``edges`` (kind, src, dst, weight), ``seeds`` (kind, host, weight). Flow
    out of hosts without edges is dropped each round and made good by the
    last scaling, which gives the same vector as returning it to the seeds.
    """
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("_total"))
    start = stage(seeds.join(total, "kind").select("kind", "host", (F.col("weight") / F.col("_total")).alias("seed")), "trust-seeds")
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("_out"))
    share = stage(edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("_out")).alias("share")), "trust-edges")
    score = start.select("kind", "host", F.col("seed").alias("score"))
    restart = start.select("kind", "host", ((1 - damping) * F.col("seed")).alias("score"))
    for k in range(rounds):
        flow = score.join(share.withColumnRenamed("src", "host"), ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("score"))
        score = flow.union(restart).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if k % cut_every == cut_every - 1:
            score = stage(score, "trust-scores")
    whole = score.groupBy("kind").agg(F.sum("score").alias("_whole"))
    return score.join(whole, "kind").select("kind", "host", (F.col("score") / F.col("_whole")).alias("score"))


def host_trust(judged: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 20) -> DataFrame:
    """(host, trust, distrust) from pages with ``host`` and rule ``verdict``."""
    seeds = (judged.where("verdict IS NOT NULL AND host != ''")
             .groupBy(F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
             .agg(F.count(F.lit(1)).cast("double").alias("weight")))
    forward = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight")
    reverse = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    scores = propagate(forward.union(reverse), seeds, damping, rounds)
    return scores.groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
                                      F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"))


def url_filter(pages: DataFrame, rules=None, threshold: float = 0.5, id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, host, path, rule, verdict, trust, distrust for every row of ``pages``."""
    host, path = url_parts(F.col(url_col))
    parsed = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    rule, verdict = match_rules(F.col("host"), F.col("path"), RULES if rules is None else rules)
    judged = parsed.withColumns({"rule": rule, "verdict": verdict})
    edges = stage(host_edges(parsed, "host", "html"), "host-edges")
    trust = host_trust(judged.select("host", "verdict"), edges)
    share = F.col("distrust") / (F.col("trust") + F.col("distrust"))
    method = F.when(share > threshold, "block").otherwise("allow")
    return (judged.drop("html").join(trust, "host", "left")
            .select(F.col(id_col), "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))


def op5_link_trust(spark, sf_dir):
    return url_filter(table(spark, sf_dir, "pages"))
