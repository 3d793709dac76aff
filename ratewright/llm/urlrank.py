"""URL filter: path rules, and trust and distrust propagated over the host link graph.

Everything is a DataFrame expression. A page takes the longest rule whose host is the
page's host or a parent domain of it and whose path begins the page's path. Pages
without a rule are judged by their host: personalised PageRank runs from hosts with
allowed pages along the links, and reversed from hosts with blocked pages against
them. A seed's weight is the share of its pages that the rules allow or block. A host
whose distrust exceeds both its trust and ``THRESHOLD`` is blocked.

Defined cases: a null url or one without ``://`` has empty host and path, matches no
rule and is allowed; repeated rows are judged alike; links are absolute URLs in
``href`` attributes, and a host's links to itself do not count.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ratewright.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
TOLERANCE = 1e-6  # of all scores together, at which what still travels along the links is let go
MERGED = 16  # rounds whose arrivals are kept apart before they are added up
THRESHOLD = 0.5  # of the score of a host all of whose pages are blocked
LINK = r"""(?i)href\s*=\s*["']?([a-z][a-z0-9+.-]*://[^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    rest = _rest(F.coalesce(url, F.lit("")))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def _longest(rules: list[Rule], host: Column, path: Column) -> Column:
    """The first fitting rule, longest first: a chain of conditions over the configured list."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(
            out
        )
    return out


def _spread(seeds: DataFrame, edges: DataFrame, start: str, end: str) -> DataFrame:
    """(host, score) of personalised PageRank along ``edges(start, end, weight)`` from ``seeds(host, mass)``.

    A score is divided by the teleport share, so a seed of mass 1 has at least 1. Each round
    passes on what arrived in the one before. A round passes on at most ``DAMPING`` of it, so
    the rounds end; they do when all that is still to come is below ``TOLERANCE``.
    """
    totals = edges.groupBy(F.col(start).alias("s_host")).agg(F.sum("weight").alias("total"))
    shares = materialize(
        edges.join(totals, F.col(start) == F.col("s_host")).select(
            F.col(start).alias("src"), F.col(end).alias("dst"), (F.col("weight") / F.col("total")).alias("share")
        ),
        "shares",
    )
    arrived = seeds.select("host", F.col("mass").alias("score"))
    parts, left = [arrived], TOLERANCE
    while left >= TOLERANCE:
        seen = Observation()
        passed = (
            shares.join(arrived, F.col("src") == F.col("host"))
            .groupBy("dst")
            .agg((F.sum(F.col("score") * F.col("share")) * DAMPING).alias("score"))
            .select(F.col("dst").alias("host"), "score")
        )
        arrived = materialize(passed.observe(seen, F.sum("score").alias("score")), "arrived")
        left = (seen.get["score"] or 0.0) * DAMPING / (1 - DAMPING)
        parts.append(arrived)
        if len(parts) > MERGED:
            parts = [materialize(_summed(parts), "scores")]
    return _summed(parts)


def _summed(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("host").agg(F.sum("score").alias("score"))


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), one row per row of ``pages(page_id, url, html)``."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    located = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = located.withColumn("hit", _longest(rules, F.col("host"), F.col("path"))).select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("ruled")
    )
    share = lambda verdict: F.avg(F.when(F.col("ruled") == verdict, 1.0).otherwise(0.0))
    hosts = materialize(
        ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked")),
        "hosts",
    )
    edges = materialize(
        pages.select(host.alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("url"))
        .select("src", host_of(F.col("url")).alias("dst"))
        .where("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("weight")),
        "host_links",
    )
    trusted = hosts.where("allowed > 0").select("host", F.col("allowed").alias("mass"))
    blocked = hosts.where("blocked > 0").select("host", F.col("blocked").alias("mass"))
    if edges.limit(1).count():
        trust = _spread(trusted, edges, "src", "dst")
        distrust = _spread(blocked, edges, "dst", "src")
    else:  # without links the scores are the seeds
        trust, distrust = trusted.withColumnRenamed("mass", "score"), blocked.withColumnRenamed("mass", "score")
    scored = materialize(
        trust.withColumnRenamed("score", "trust")
        .join(distrust.withColumnRenamed("score", "distrust"), "host", "full")
        .select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")),
        "host_scores",
    )
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") > THRESHOLD)
    return ruled.join(scored, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
