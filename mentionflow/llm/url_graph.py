"""URL filter over the link graph of hosts.

Rules decide the urls they fit. The rest get the verdict of their host: trust flows from
hosts with allowed pages along their links (a host is trusted when trusted hosts point to
it), distrust flows from hosts with blocked pages against the links (a host that points to
bad hosts is bad). Both are personalised PageRank in units of pages; a host is blocked when
its distrust exceeds its trust and a share of its pages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import boxed, lower_ascii, unboxed

#: Absolute links of anchors; group 1 is the host with user and port.
LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>\\]+)"""
DAMPING, ITERATIONS, STEPS_A_PLAN = 0.85, 10, 5
#: Share of a host's pages that distrust must exceed.
THRESHOLD = 0.5


def url_host(url: Column) -> Column:
    """Host of a url, A to Z lower-cased; empty without ``://`` or for NULL."""
    return F.coalesce(lower_ascii(F.regexp_extract(_after(url), r"^([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """Path of a url up to the query or fragment."""
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Longest of the (verdict, ``host/path``) rules that fits, as struct(verdict, rule); NULL if none."""
    fitting = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        of, _, start = rule.partition("/")
        fits = ((host == of) | F.endswith(host, F.lit(f".{of}"))) & F.startswith(path, F.lit(f"/{start}"))
        fitting = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(fitting)
    return fitting


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct links between different hosts: ``src``, ``dst``, ``links`` (pages that carry them)."""
    found = pages.select(url_host(F.col(url)).alias("src"),
                         F.explode(F.array_distinct(F.transform(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)),
                                                                link_host))).alias("dst"))
    return (found.where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count("*").alias("links")))


def link_host(authority: Column) -> Column:
    """Host of a link, without user and port."""
    return lower_ascii(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""))


def spread(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS) -> DataFrame:
    """Personalised PageRank: ``host``, ``rank`` from seeds (``host``, ``weight``) over (``src``, ``dst``, ``links``).

    A host without links keeps what it has. Every iteration is a join on the linking host
    and a sum by the linked host, which is pre-aggregated before it shuffles; the lineage
    is cut every few iterations.
    """
    out = edges.groupBy("src").agg(F.sum("links").alias("out"))
    shares = materialize(edges.join(out, "src").select("src", "dst", (F.col("links") / F.col("out")).alias("share")), "host-shares")
    ends = materialize(seeds.select("host").unionByName(shares.select(F.col("dst").alias("host"))).distinct()
                       .join(shares.select(F.col("src").alias("host")).distinct(), "host", "left_anti"), "host-ends")
    start = seeds.select("host", (F.col("weight") * (1 - damping)).alias("rank"))
    rank = seeds.select("host", F.col("weight").cast("double").alias("rank"))
    for step in range(1, iterations + 1):
        moved = (rank.join(shares, rank.host == shares.src)
                 .select(F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank")))
        stays = rank.join(ends, "host", "left_semi").select("host", (F.col("rank") * damping).alias("rank"))
        rank = reduce(DataFrame.unionByName, [start, moved, stays]).groupBy("host").agg(F.sum("rank").alias("rank"))
        if step % STEPS_A_PLAN == 0:
            rank = materialize(rank, "host-rank")
    return rank


def host_verdicts(pages: DataFrame, rules: list[tuple[str, str]], threshold: float = THRESHOLD,
                  url: str = "url", html: str = "html") -> DataFrame:
    """One row per host: ``host``, ``pages``, ``trust``, ``distrust``, ``verdict``."""
    host, path = url_host(F.col(url)), url_path(F.col(url))
    fitting = rule_of(host, path, rules).getField("verdict")
    hosts = materialize(pages.select(host.alias("host"), fitting.alias("fitting")).groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("fitting") == "allow").alias("allowed"),
        F.count_if(F.col("fitting") == "block").alias("blocked")), "hosts")
    edges = materialize(host_edges(pages, url, html), "host-edges")
    seeds = lambda kind: hosts.where((F.col(kind) > 0) & (F.col("host") != "")).select("host", F.col(kind).alias("weight"))
    trust = spread(seeds("allowed"), edges).withColumnRenamed("rank", "trust")
    reversed_edges = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    distrust = spread(seeds("blocked"), reversed_edges).withColumnRenamed("rank", "distrust")
    scores = (hosts.join(trust, "host", "left").join(distrust, "host", "left")
              .na.fill(0.0, ["trust", "distrust"]))
    bad = F.col("distrust") > F.col("trust") + threshold * F.col("pages")
    return scores.select("host", "pages", "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("verdict"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], threshold: float = THRESHOLD,
                url: str = "url", html: str = "html") -> DataFrame:
    """All rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A NULL url or one without ``://`` has an empty host and is allowed; a NULL html has no
    links; repeated rows count as pages each; an empty table gives no rows. Input columns
    called like an added one are replaced.
    """
    verdicts = materialize(host_verdicts(pages, rules, threshold, url, html)
                           .select(F.col("host").alias("of"), F.col("verdict").alias("host_verdict")), "host-verdicts")
    host, path = url_host(F.col(url)), url_path(F.col(url))
    rows = boxed(pages, host=host, path=path, fitting=rule_of(host, path, rules)).join(verdicts, F.col("host") == F.col("of"), "left")
    return unboxed(rows, pages.columns, {
        "host": F.col("host"), "path": F.col("path"), "rule": F.col("fitting.rule"),
        "verdict": F.coalesce(F.col("fitting.verdict"), F.col("host_verdict"), F.lit("allow"))})
