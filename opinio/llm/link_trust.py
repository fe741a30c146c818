"""URL filters: rules first, then trust and distrust spread over the link graph of hosts.

A url is judged by the longest rule that fits its host or a parent domain and
whose path the url's path starts with.  Where no rule fits, its host decides:

* a host is a trusted seed by the share of its pages that a rule allows, a
  blocked seed by the share that a rule blocks;
* trust is a personalised PageRank from the trusted seeds along links, distrust
  one from the blocked seeds against them (who links to a bad host is
  suspect); links are counted between hosts, those within a host do not count;
* a host is blocked if its distrust exceeds its trust by more than ``MARGIN``.

Links are the absolute or protocol-relative targets of anchors, read from the
run of characters other than ``<`` and ``>`` that follows ``<a``.  Everything is
DataFrame functions.  Links are summed by pair of hosts within tasks before the
shuffle; each round's ranks, one row per host, are written to the shared
folder, and the rounds end when the ranks move by less than ``TOLERANCE`` of the seeds'
whole mass; each round moves at most ``DAMPING`` times what the one before did.

Results for odd input: a null url, or one without ``://``, has an empty host
and path, fits no rule, spreads nothing and is allowed; null html has no links;
repeated rows count as often as they stand and are each returned; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.llm.common import cut, quoted

# The rules of the query, first to last, as (verdict, host and path).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
DAMPING = 0.85
TOLERANCE = 1e-6
# A third of what a host gets if a rule blocks all of its pages.
MARGIN = (1 - DAMPING) / 3
_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"
# Possessive throughout, so that broken markup of any length is read once.
_ANCHOR = r"(?i)<a(?=\s)[^<>]*+"
_TARGET = r"""(?i)\shref\s*+=\s*+["']?\s*+((?:[a-z][a-z0-9+.\-]*+:)?+//[^\s"'>]++)"""


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    rows = [(verdict, rule, rule.split("/", 1)[0], "/" + rule.split("/", 1)[1]) for verdict, rule in rules]
    return spark.createDataFrame(rows, "verdict string, rule string, rule_host string, rule_path string")


def by_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, verdict)`` of the distinct ``(host, path)`` that a rule fits."""
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = urls.select("host", "path").distinct().select("host", "path", F.explode(parents).alias("rule_host"))
    fits = each.join(rules, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.col("rule"))).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst, n)``: links between different hosts."""
    anchors = F.regexp_extract_all(F.coalesce(quoted(html_col), F.lit("")), F.lit(_ANCHOR), F.lit(0))
    each = pages.select(host(quoted(url_col)).alias("src"), F.explode(anchors).alias("anchor"))
    found = each.select("src", F.regexp_extract("anchor", _TARGET, 1).alias("target"))
    # a protocol-relative target gets a scheme, so that its host is read like any other
    whole = F.when(F.col("target").startswith("//"), F.concat(F.lit("http:"), "target")).otherwise(F.col("target"))
    between = found.select("src", host(whole).alias("dst")).filter("src != '' AND dst != '' AND src != dst")
    return between.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def spread(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """``(host, rank)``: personalised PageRank from ``seeds`` (host, seed) along ``links`` (src, dst, n)."""
    total = links.groupBy("src").agg(F.sum("n").alias("total"))
    edges = cut(links.join(total, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share")), "host-edges")
    start = cut(seeds.select("host", (F.col("seed") * (1 - damping)).alias("start")).filter("start > 0"), "host-seeds")
    ranks = start.withColumnRenamed("start", "rank")
    if edges.isEmpty():
        return ranks
    mass = start.agg(F.sum("start")).first()[0] or 0.0
    while True:
        flow = edges.join(ranks, F.col("src") == F.col("host")).select(F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        new = cut(flow.union(start.select("host", "start")).groupBy("host").agg(F.sum("rank").alias("rank")), "host-ranks")
        moved = new.join(ranks.withColumnRenamed("rank", "old"), "host", "full")
        change = moved.agg(F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0]
        ranks = new
        if (change or 0) <= tolerance * mass:
            return ranks


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", margin: float = MARGIN) -> DataFrame:
    """``(id, host, path, rule, verdict, trust, distrust)`` of every row."""
    urls = pages.select(quoted(id_col).alias("id"), host(quoted(url_col)).alias("host"), path(quoted(url_col)).alias("path"))
    fits = by_rule(urls, rule_table(pages.sparkSession, rules))
    ruled = cut(urls.join(fits, ["host", "path"], "left"), "ruled-urls")
    seeds = ruled.filter("host != ''").groupBy("host").agg(
        F.avg(F.when(F.col("verdict") == "allow", 1.0).otherwise(0.0)).alias("good"),
        F.avg(F.when(F.col("verdict") == "block", 1.0).otherwise(0.0)).alias("bad"),
    )
    seeds = cut(seeds, "host-shares")
    links = cut(host_links(pages, url_col, html_col), "host-links")
    trust = spread(seeds.select("host", F.col("good").alias("seed")), links)
    against = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = spread(seeds.select("host", F.col("bad").alias("seed")), against)
    scores = trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host", "full")
    scored = ruled.join(scores, "host", "left").fillna(0.0, ["trust", "distrust"])
    by_host = F.when(F.col("distrust") - F.col("trust") > margin, "block").otherwise("allow")
    return scored.select("id", "host", "path", "rule", F.coalesce("verdict", by_host).alias("verdict"), "trust", "distrust")


def op9(spark, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    judged = judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "trust", "distrust")
