"""URL filters: rules first, then trust and distrust spread over links between hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_stored, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING, ROUNDS = 0.85, 10
_HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


def url_host(url: Column) -> Column:
    """What is after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(_known(url), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_known(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest of the rules ``(verdict, host, path)`` that fit, as ``struct<rule, verdict>``.

    A rule fits its host and all subdomains where the path starts with the rule's path.
    """
    chosen = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for verdict, own, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        chosen = chosen.when(fits, F.struct(F.lit(own + start).alias("rule"), F.lit(verdict).alias("verdict")))
    return chosen


def filter_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], damping: float = DAMPING, rounds: int = ROUNDS
) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict, trust, distrust``.

    A page that a rule fits gets the rule's verdict. For the others, hosts are the nodes of a
    graph whose edges are the anchors of pages that name another host. A host is a trusted seed
    by the share of its pages that rules allow, a blocked one by the share that they block.
    Personalised PageRank spreads trust from the first along links and distrust from the second
    against them, for a host that links to blocked ones is suspect. The host is blocked where its
    distrust is greater than its trust, each in shares of all there is; without either it is
    allowed.

    Each round is one join and one grouping of the distinct pairs of hosts, cut by a written
    table; a host with very many links is split as a skewed join. A null url, or one without
    ``://``, has an empty host and path, fits no rule and is allowed, as it has no place in the
    graph. Null html has no links. No pages give no rows; ids may repeat and may be null.
    """
    named = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    found = named.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    hosts = stored(
        found.where("host != ''")
        .groupBy("host")
        .agg(
            F.avg((F.coalesce(F.col("_rule.verdict"), F.lit("")) == "allow").cast("double")).alias("allowed"),
            F.avg((F.coalesce(F.col("_rule.verdict"), F.lit("")) == "block").cast("double")).alias("blocked"),
        )
    )
    edges = stored(host_edges(pages))
    trust = page_rank(edges, hosts.select("host", F.col("allowed").alias("seed")), damping, rounds)
    reverse = edges.select(F.col("target").alias("source"), F.col("source").alias("target"))
    distrust = page_rank(reverse, hosts.select("host", F.col("blocked").alias("seed")), damping, rounds)
    verdicts = (
        hosts.select("host")
        .join(trust.withColumnRenamed("rank", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("rank", "distrust"), "host", "left")
        .na.fill(0.0, ["trust", "distrust"])
    )
    method = F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")
    return found.join(verdicts, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct ``source, target``: hosts of pages and the other hosts that their anchors name.

    Relative links stay on their host and are no edges; ``//host/path`` names a host.
    """
    links = pages.select(
        url_host(F.col("url")).alias("source"),
        F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_HREF), F.lit(1)))).alias("href"),
    )
    absolute = F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), F.col("href"))).otherwise(F.col("href"))
    named = links.where(F.col("href").rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:)?//")).select(
        "source", url_host(absolute).alias("target")
    )
    return named.where("source != '' and target != '' and source != target").distinct()


def page_rank(edges: DataFrame, seeds: DataFrame, damping: float, rounds: int) -> DataFrame:
    """``host, rank`` of the hosts that ``seeds(host, seed)`` reach over ``edges(source, target)``.

    Seeds are taken as shares of their sum. What reaches a host without links goes nowhere, as
    the ranks of a host are only compared with each other.
    """
    total = seeds.agg(F.sum("seed")).first()[0]
    if not total:
        return seeds.select("host", F.lit(0.0).alias("rank"))
    shares = seeds.where("seed > 0").select("host", (F.col("seed") / total).alias("seed"))
    degrees = edges.groupBy("source").agg(F.count("*").alias("degree"))
    weighted = stored(edges.join(degrees, "source").select("source", "target", "degree"))
    ranks = stored(shares.withColumnRenamed("seed", "rank"))
    if weighted.isEmpty():
        # The first round gives each seed its own part back, and so does every other.
        return ranks.select("host", (F.col("rank") * (1 - damping)).alias("rank"))
    for _ in range(rounds):
        passed = weighted.join(ranks, weighted.source == ranks.host).select(
            F.col("target").alias("host"), (F.col("rank") * damping / F.col("degree")).alias("rank")
        )
        own = shares.select("host", (F.col("seed") * (1 - damping)).alias("rank"))
        following = stored(passed.unionByName(own).groupBy("host").agg(F.sum("rank").alias("rank")))
        drop_stored(ranks)
        ranks = following
    return ranks


def _known(url: Column) -> Column:
    return F.coalesce(url, F.lit(""))
