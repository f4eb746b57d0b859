"""URL filters: rules first, then trust and distrust spread over the links between hosts.

Rules name a host (with all its subdomains) and the beginning of a path; the longest that fits decides. The pages that rules decide make seeds of their hosts: the share of a host's pages that is allowed, and the share that is blocked. A
personalised PageRank carries trust from the allowed along links, and distrust from the blocked against links (who links to blocked hosts is suspect). A host with more distrust than trust, by a margin, is blocked; its
other pages follow it. Links are counted once for each pair of hosts before anything is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.support import written

#: Rule and verdict.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Share of a score that comes over links; rounds after which lineage is cut and the change is measured; change at which the rounds end; distrust less trust, relative to a seed of its own, at which a host is blocked.
DAMPING, CUT, TOLERANCE, MARGIN = 0.85, 4, 1e-4, 0.5
#: Hosts in a page: the authority of absolute addresses in attributes, which ends where host_of() ends it (and at quotes, white space and tags), and the hosts of mail addresses.
LINK = r"""(?i)(?:href|src|action)[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?[\x20\x09-\x0D]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\x20\x09-\x0D]+)"""
MAIL = r"""(?i)[a-z0-9._%+-]@([a-z0-9-]+(?:\.[a-z0-9-]+)+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without :// or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, says in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, rest = name.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def host_verdicts(pages: DataFrame, links: DataFrame, damping: float = DAMPING, margin: float = MARGIN, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust, distrust, method (allow or block). pages: host and verdict (null where no rule fits) of each page; links: a, b and n for each pair of hosts.

    A seed's own score is 1 - damping times its share, whatever the number of seeds: a PageRank whose seeds add up to one, times their number, so that a verdict doesn't depend on seeds far away.
    Rounds go on until no score changes by more than the tolerance in CUT rounds. That ends, as the sum of all changes falls by 1 - damping in each.
    """
    share = lambda v: F.sum(F.when(F.col("verdict") == v, 1.0).otherwise(0.0)) / F.count(F.lit(1))
    seeds = pages.groupBy("host").agg(share("allow").alias("good"), share("block").alias("bad"))
    out, into = links.groupBy("a").agg(F.sum("n").alias("out")), links.groupBy("b").agg(F.sum("n").alias("into"))
    weighed = links.join(out, "a").join(into, "b")
    zero = F.lit(0.0)
    arcs = weighed.select(F.col("a").alias("host"), F.col("b").alias("to"), (F.col("n") / F.col("out")).alias("forth"), zero.alias("back"))
    arcs = written(arcs.unionAll(weighed.select("b", "a", zero, F.col("n") / F.col("into"))), "arcs")
    nodes = seeds.unionByName(arcs.select(F.col("to").alias("host"), zero.alias("good"), zero.alias("bad"))).groupBy("host").agg(F.max("good").alias("good"), F.max("bad").alias("bad"))
    nodes = written(nodes, "hosts")
    now = nodes.select("host", "good", "bad", (F.col("good") * (1 - damping)).alias("trust"), (F.col("bad") * (1 - damping)).alias("distrust"))
    done = arcs.isEmpty()
    while not done:
        before = now
        for _ in range(CUT):
            moved = arcs.join(now.select("host", "trust", "distrust"), "host").groupBy(F.col("to").alias("host"))
            moved = moved.agg(F.sum(F.col("trust") * F.col("forth")).alias("t"), F.sum(F.col("distrust") * F.col("back")).alias("d"))
            fresh = lambda seed, got: (F.col(seed) * (1 - damping) + F.coalesce(got, zero) * damping)
            now = nodes.join(moved, "host", "left").select("host", "good", "bad", fresh("good", "t").alias("trust"), fresh("bad", "d").alias("distrust"))
        now = written(now, "ranks")
        change = [F.abs(F.col(c) - F.col(f"old_{c}")) for c in ("trust", "distrust")]
        old = before.select("host", *[F.col(c).alias(f"old_{c}") for c in ("trust", "distrust")])
        done = now.join(old, "host").agg(F.max(F.greatest(*change)).alias("most")).first()["most"] <= tolerance
    bad = (F.col("distrust") - F.col("trust")) >= margin * (1 - damping)
    return now.select("host", "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("method"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict.

    A url that is null or has no :// has an empty host and path, fits no rule, is no part of the graph, and is allowed. Null html has no links; a host's links to itself don't count. Repeated rows each give their row and count in their host's shares. A host
    without seeds near it is allowed. An empty table gives an empty result; other columns are ignored. A host that holds much of the table is one row before any join of hosts, and the join that brings verdicts back can be split.
    """
    url = F.col(f"`{url_col}`")
    host, path = host_of(url), path_of(url)
    split = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    ruled = split.withColumn("rule", rule).withColumn("ruled", verdict)
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    found = pages.select(host.alias("a"), F.explode(F.concat(*[F.regexp_extract_all(html, F.lit(x), F.lit(1)) for x in (LINK, MAIL)])).alias("b"))
    links = found.withColumn("b", F.translate("b", _UPPER, _LOWER)).where("a != '' AND a != b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    verdicts = host_verdicts(ruled.where("host != ''").select("host", F.col("ruled").alias("verdict")), written(links, "links"))
    verdicts = written(verdicts, "verdicts")
    return ruled.join(verdicts, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("ruled", "method", F.lit("allow")).alias("verdict"))
