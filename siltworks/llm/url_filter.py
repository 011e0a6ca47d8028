"""URL verdicts from rules, and from trust that spreads over links between hosts, in column expressions only.

A rule fits a host and its subdomains below a path; the longest decides. For urls without one, hosts are judged: a host
with most of its pages allowed by rules is trusted, one with most of them blocked is not; hosts without pages are
judged so by the urls that link to them. Trust follows links (personalised PageRank from the trusted hosts): ``(1 - DAMPING)
* DAMPING ** steps`` for each walk from a trusted host. Distrust of a host is the sum of the same over the blocked hosts that
a walk from it meets, so it is a matter of the share of its own links, however many others link to the same
hosts. A walk that reaches a host without links ends. A host is blocked if its distrust is above its trust and at
least ``THRESHOLD`` of what a blocked host gives itself.

Links are counted per pair of hosts before anything is joined, so the graph has as many rows as hosts have links to
different hosts. Each step is one join and one sum with partial sums, stored in the shared folder.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and is allowed; equal rows
get equal verdicts; links without a host, or to the own host, count nothing; null html has no links; empty
tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.session import stored

DAMPING = 0.85
#: So many steps leave out walks that carry less than 0.002 of the weight of all.
STEPS = math.ceil(math.log(0.002) / math.log(DAMPING))
THRESHOLD = 0.2
#: Host and path of links with a scheme, or with two slashes.
LINK = "(?i)<a\\s[^>]*?href\\s*=\\s*[\"']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\\s>]+(?:/[^?#\"'\\s>]*)?)"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: str) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: Sequence[UrlRule], host: str = "host", path: str = "path") -> Column:
    """The longest fitting rule as a struct of ``size, rule, verdict``, or null. ``rules`` is a list of the driver's.

    Of equally long ones the greater text decides, and block over allow.
    """
    if not rules:
        return F.lit(None).cast("struct<size:int,block:boolean,rule:string,verdict:string>")
    every = [
        F.when(
            ((F.col(host) == r.host) | F.endswith(F.col(host), F.lit("." + r.host))) & F.startswith(F.col(path), F.lit(r.path)),
            F.struct(
                F.lit(len(r.host + r.path)).alias("size"), F.lit(r.verdict == "block").alias("block"),
                F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"),
            ),
        )
        for r in rules
    ]
    return F.array_max(F.array(*every))


def host_links(pages: DataFrame, html: str = "html", rules: Sequence[UrlRule] = ()) -> DataFrame:
    """``src, dst, pages, urls, allowed, blocked``: how many pages of a host link to another, and to how many urls a page,

    with how many of these the rules allow and block.
    """
    urls = F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)))
    host = lambda u: lower_ascii(F.regexp_extract(u, "^[^/]*", 0))
    one = lambda dst, path: F.struct(dst.alias("dst"), path.cast("string").alias("path"))
    targets = F.array_distinct(F.transform(urls, lambda u: one(host(u), F.regexp_extract(u, "/.*$", 0))))
    hosts = F.array_distinct(F.transform(urls, lambda u: one(host(u), F.lit(None))))  # without a path: the page itself
    pairs = pages.select(F.col("host").alias("src"), F.explode(F.concat(hosts, targets)).alias("_to")).select("src", "_to.*")
    verdict = longest_rule(rules, "dst")["verdict"]
    pairs = pairs.filter("src <> '' and src <> dst").withColumn("_verdict", F.when(F.col("path").isNotNull(), verdict))
    return pairs.groupBy("src", "dst").agg(
        F.count_if(F.col("path").isNull()).alias("pages"), F.count("path").alias("urls"),
        F.count_if(F.col("_verdict") == "allow").alias("allowed"), F.count_if(F.col("_verdict") == "block").alias("blocked"),
    )


def spread(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """``host, trust, distrust`` from ``seeds``, which has the same columns, after ``steps`` steps or when all walks have ended."""
    out = links.groupBy(F.col("src").alias("_s")).agg(F.sum("pages").alias("_out"))
    edges = links.join(out, F.col("src") == F.col("_s"))
    forth = edges.select(F.col("src").alias("_from"), F.col("dst").alias("_to"), (F.col("pages") / F.col("_out")).alias("_t"), F.lit(0.0).alias("_b"))
    back = edges.select(F.col("dst").alias("_from"), F.col("src").alias("_to"), F.lit(0.0).alias("_t"), (F.col("pages") / F.col("_out")).alias("_b"))
    both = stored(forth.unionByName(back), "host-edges")
    own = seeds.select("host", ((1 - damping) * F.col("trust")).alias("trust"), ((1 - damping) * F.col("distrust")).alias("distrust"))
    now = own
    if both.isEmpty():
        return own
    before = None
    for _ in range(steps):
        sent = both.join(now, F.col("_from") == F.col("host")).select(
            F.col("_to").alias("host"),
            (damping * F.col("_t") * F.col("trust")).alias("trust"),
            (damping * F.col("_b") * F.col("distrust")).alias("distrust"),
        )
        total = own.unionByName(sent).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        now = stored(total.filter("trust > 0 or distrust > 0"), "host-scores")
        # Scores only grow from step to step, so equal sums are equal scores.
        held = now.agg(F.count("*"), F.round(F.sum("trust"), 9), F.round(F.sum("distrust"), 9)).first()
        if held == before:
            break
        before = held
    return now


def judge(pages: DataFrame, rules: Sequence[UrlRule], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``key, host, path, rule, verdict``, and the host's ``trust`` and ``distrust`` where it has any."""
    parsed = pages.select(F.col(key), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html).alias("_html"))
    ruled = parsed.withColumn("_rule", longest_rule(rules))
    part = lambda verdict: F.avg(F.when(F.col("_rule.verdict") == verdict, 1.0).otherwise(0.0))
    links = stored(host_links(parsed, "_html", rules), "host-links")
    hosts = ruled.filter("host <> ''").groupBy("host").agg(part("allow").alias("_allowed"), part("block").alias("_blocked"))
    linked = links.groupBy(F.col("dst").alias("host")).agg(*((F.sum(c) / F.sum("urls")).alias(f"_{c}") for c in ("allowed", "blocked")))
    hosts = hosts.unionByName(linked.join(hosts.select("host"), "host", "left_anti"))
    seeds = hosts.filter("_allowed > 0.5 or _blocked > 0.5").select(
        "host", (F.col("_allowed") > 0.5).cast("double").alias("trust"), (F.col("_blocked") > 0.5).cast("double").alias("distrust")
    )
    scores = spread(links, stored(seeds, "host-seeds"))
    scores = scores.withColumnRenamed("host", "_host")
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= THRESHOLD * (1 - DAMPING))
    judged = F.when(F.coalesce(blocked, F.lit(False)), "block").otherwise("allow")
    rows = ruled.drop("_html").join(scores, F.col("host") == F.col("_host"), "left")
    rule = F.col("_rule.rule")
    return rows.select(key, "host", "path", rule.alias("rule"), F.coalesce(F.col("_rule.verdict"), judged).alias("verdict"), "trust", "distrust")
