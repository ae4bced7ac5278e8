"""URL filter by rules and, where no rule fits, by trust and distrust that spread over the links between hosts.

Hosts whose pages the rules allow are seeds of trust, those whose pages they block are seeds of distrust, each by its
number of such pages. Trust follows the links, distrust goes against them: a host is suspect if it links to suspect ones.
Both are personalised PageRank; a host is blocked if its distrust is more than its trust and its share of all pages
together. DataFrame operations throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import few, stored

#: (verdict, rule); a rule is a host, a slash and how the path goes on.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Hosts named by absolute links, and by the notice of who owns the page.
LINKS = r"(?i)(?:(?:href|src)\s*=\s*[\"']?\s*(?:https?:)?//|(?:&copy;|©)\s*)([a-z0-9-]+(?:\.[a-z0-9-]+)+)"
DAMPING = 0.85
#: Steps of PageRank: what is still to come is below DAMPING to this power. The plan is cut after STEPS_AT_ONCE of them.
STEPS, STEPS_AT_ONCE = 20, 5


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda i: F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", i), F.lit(""))
    return lower_ascii(part(1)), part(2)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, null if none does."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits.append(F.when(((host == name) | host.endswith("." + name)) & path.startswith("/" + rest), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def link_edges(pages: DataFrame) -> DataFrame:
    """Links between different hosts: (host, target, links)."""
    links = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(LINKS), 1)).alias("target"))
    links = links.withColumn("target", lower_ascii(F.col("target"))).where("host <> '' and host <> target")
    return links.groupBy("host", "target").agg(F.count("*").alias("links"))


def spread(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """Personalised PageRank of two kinds at once: (kind, host, value), values of a kind adding up to 1.

    seeds: (kind, host, value); kind ``trust`` follows the edges, ``distrust`` goes against them. What reaches a host
    without further edges is lost, which after scaling is the same as a return to the seeds.
    """
    both = edges.select(F.lit("trust").alias("kind"), F.col("host").alias("from"), F.col("target").alias("to"), "links")
    both = both.unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("from"), F.col("host").alias("to"), "links"))
    total = both.groupBy("kind", "from").agg(F.sum("links").alias("all"))
    both = stored(both.join(total, ["kind", "from"]).select("kind", "from", "to", (F.col("links") / F.col("all")).alias("part")), "edges")
    begin = seeds.select("kind", "host", (F.col("value") * (1 - DAMPING)).alias("value"))
    value = seeds
    if not both.isEmpty():
        for step in range(STEPS):
            sent = value.withColumnRenamed("host", "from").join(both, ["kind", "from"])
            sent = sent.select("kind", F.col("to").alias("host"), (F.col("value") * F.col("part") * DAMPING).alias("value"))
            value = begin.unionByName(sent).groupBy("kind", "host").agg(F.sum("value").alias("value"))
            if step % STEPS_AT_ONCE == STEPS_AT_ONCE - 1:
                value = stored(value, "ranks")
    totals = {r.kind: r.total for r in value.groupBy("kind").agg(F.sum("value").alias("total")).collect()}  # two rows
    scale = F.when(F.col("kind") == "trust", totals.get("trust") or 1.0).otherwise(totals.get("distrust") or 1.0)
    return value.withColumn("value", F.col("value") / scale)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, margin: float = 1.0) -> DataFrame:
    """A row for each row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict, and trust, distrust of the host.

    host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``,
    ``#`` or the end; both empty for a null url or one without ``://``. A rule fits its host and all below it if the path
    goes on as the rule does; the longest rule gives the verdict. Else the host is blocked if its distrust exceeds its
    trust plus ``margin`` times its share of the pages. Without seeds, and for pages without a host, that is: allow.
    A null html has no links. Repeated rows have a row each and count as pages. An empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    named = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    named = named.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    verdicts = F.coalesce(*[F.when(F.col("rule") == rule, F.lit(v)) for v, rule in rules], F.lit(None).cast("string"))
    named = named.withColumn("ruled", verdicts)
    hosts = named.groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("ruled") == "allow").alias("trust"), F.count_if(F.col("ruled") == "block").alias("distrust")
    )
    hosts = stored(hosts, "hosts")
    edges = link_edges(named)
    sums = hosts.agg(*[F.sum(c).alias(c) for c in ("pages", "trust", "distrust")]).first()
    seeds = [
        hosts.where(f"{kind} > 0 and host <> ''").select(F.lit(kind).alias("kind"), "host", (F.col(kind) / F.lit(sums[kind] or 1)).alias("value"))
        for kind in ("trust", "distrust")
    ]
    ranks = spread(seeds[0].unionByName(seeds[1]), edges)
    ranks = ranks.groupBy("host").agg(*[F.round(F.sum(F.when(F.col("kind") == k, F.col("value")).otherwise(0.0)), 12).alias(k) for k in ("trust", "distrust")])
    judged = hosts.select("host", "pages").join(ranks, "host", "left").fillna(0.0, ["trust", "distrust"])
    share = F.col("pages") / F.lit(sums["pages"] or 1)
    blocked = F.col("distrust") > F.col("trust") + margin * share
    judged = few(stored(judged.select("host", "trust", "distrust", F.when(blocked, "block").otherwise("allow").alias("spread")), "judged"))
    out = named.drop("html").join(judged, "host")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", "spread").alias("verdict"), "trust", "distrust")
