"""URL filter: listed rules first, else a path-template tree with labelled purity.

Per host, paths form a tree of segments.  Level by level, numbers and long hexadecimal
runs in a segment become a wildcard; where a node has many children, the rare ones become
one wildcard; and branches whose share of bad pages does not differ by more than chance
are merged.  The labels come from the listed rules: a page that an ``allow`` rule names is
good, one that a ``block`` rule names is bad, all others are unlabelled and count for
neither.  A template's purity is the bad share of its labelled pages, smoothed towards
its parent's.  It is rejected when that is high and enough of its pages are labelled;
with fewer it is undecided and its pages pass.  So an unlabelled branch is never judged by
its neighbours.

Pages are reduced to counts per distinct (host, path) before the tree is grown,
and to counts per branch on every level; all of it is joins and aggregations.  A level
is added while some node still mixes labelled with other pages, or good with bad ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import ascii_lower, land

ALLOW, BLOCK = "allow", "block"
CHILDREN = 16  # above so many, rare children become one wildcard
RARE = 0.05  # share of a node's pages below which a child is rare
WEIGHT = 20.0  # labelled pages that the parent's purity counts for
SUPPORT = 10  # labelled pages below which a template is undecided
PURITY = 0.9
DEVIATIONS = 1.96
ANY = "*"
ENDED = "$"


@dataclass(frozen=True)
class UrlRule:
    """A verdict for a host with its subdomains, and paths from a prefix on."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A to Z lower-cased) and path; both empty without ``://``."""
    rest = F.coalesce(F.get(F.split(url, "://", 2), F.lit(1)), F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _first(rules: list[UrlRule], value, host: Column, path: Column) -> Column:
    """The value of the longest rule that fits; ties go to the rule named first."""
    chain = F.when(F.lit(False), F.lit(""))
    for rule in sorted(rules, key=lambda rule: -len(rule.name)):
        chain = chain.when(rule.fits(host, path), F.lit(value(rule)))
    return chain


def _grow(nodes: DataFrame, level: int) -> DataFrame:
    """One more level: each path's prefix, purity and support, from its next segment."""
    nodes = nodes.drop("shut", "support")
    part = F.coalesce(F.get("segments", F.lit(level)), F.lit(ENDED))
    part = F.regexp_replace(part, "[0-9a-f]*[0-9][0-9a-f]{7,}|[0-9a-f]{7,}[0-9][0-9a-f]*", "{h}")
    nodes = nodes.withColumn("branch", F.regexp_replace(part, "[0-9]+", "{n}"))
    counts = nodes.groupBy("host", "prefix", "branch").agg(
        F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("bad").alias("bad"), F.max("purity").alias("above"),
        F.count(F.lit(1)).alias("paths"),
    )
    counts = land(counts, "branches")
    sizes = counts.groupBy("host", "prefix").agg(
        F.count(F.lit(1)).alias("children"), F.sum("n").alias("all")
    )
    keys = ["host", "prefix"]
    rare = (F.col("children") > CHILDREN) & (F.col("n") < RARE * F.col("all"))
    named = counts.join(sizes, keys).withColumn("name", F.when(rare, ANY).otherwise(F.col("branch")))
    named = land(named.select(*keys, "branch", "name", "n", "known", "bad", "above", "paths"), "named")

    # At most 16 children, or those above the rare share and the wildcard, remain.
    merged = named.groupBy(*keys, "name").agg(
        F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("bad").alias("bad"), F.max("above").alias("above"),
        F.sum("paths").alias("paths"),
    )
    # Branches without labels come first and stay together; they never join labelled ones.
    merged = merged.withColumn("rate", F.try_divide("bad", "known"))
    beside = Window.partitionBy(*keys).orderBy(F.col("rate").asc_nulls_first(), "name")
    last_known, last_bad, last_rate = (F.lag(name).over(beside) for name in ("known", "bad", "rate"))
    pooled = (F.col("bad") + last_bad + 1) / (F.col("known") + last_known + 2)
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), "known") + F.try_divide(F.lit(1), last_known)))
    apart = (F.col("rate") - last_rate > DEVIATIONS * spread) | (F.col("rate").isNotNull() & last_rate.isNull())
    merged = merged.withColumn("break", F.coalesce(apart.cast("int"), F.lit(0)))
    merged = merged.withColumn("group", F.sum("break").over(beside))
    groups = merged.groupBy(*keys, "group").agg(
        F.array_join(F.sort_array(F.collect_set("name")), "|").alias("label"),
        F.collect_set("name").alias("names"),
        ((F.sum("bad") + WEIGHT * F.max("above")) / (F.sum("known") + WEIGHT)).alias("next"),
        F.sum("known").alias("labelled"),
        # Nothing is left to tell apart: one path, no labels, or labels of one kind on every page.
        ((F.sum("paths") == 1) | (F.sum("known") == 0) | ((F.sum("known") == F.sum("n")) & F.sum("bad").isin(0, F.sum("known")))).alias("shut"),
    )
    groups = groups.select(*keys, F.explode("names").alias("name"), "label", "next", "labelled", "shut")
    found = named.join(groups, [*keys, "name"]).select(
        F.col("host").alias("h"), F.col("prefix").alias("p"), F.col("branch").alias("b"), "label", "next", "labelled", "shut"
    )
    found = land(found, "grown")
    joined = nodes.join(
        found, (F.col("host") == F.col("h")) & (F.col("prefix") == F.col("p")) & (F.col("branch") == F.col("b"))
    )
    return joined.select(
        "host", "path", "n", "known", "bad", "segments", "rule", "listed",
        F.concat("prefix", F.lit("/"), "label").alias("prefix"), F.col("next").alias("purity"),
        F.col("labelled").alias("support"), (F.col("shut") | (F.size("segments") <= level)).alias("shut"),
    )


def judge(
    pages: DataFrame, rules: list[UrlRule], purity: float = PURITY, support: int = SUPPORT
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, template, purity, support.

    ``rule`` is the longest listed rule that fits and decides.  Without one, a page is
    blocked if its template's purity reaches ``purity`` and at least ``support`` of the
    template's pages are labelled; undecided templates pass.  Null urls and urls without
    ``://`` have an empty host and path; repeated rows stay and count as often; an empty
    table gives no rows; further columns are not read.
    """
    host, path = parts(F.coalesce(pages["url"], F.lit("")))
    rows = land(
        pages.select(pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path")), "pages"
    )
    at = (rules, lambda rule: rule.verdict, F.col("host"), F.col("path"))
    distinct = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    nodes = distinct.select(
        "host",
        "path",
        "n",
        _first(rules, lambda rule: rule.name, F.col("host"), F.col("path")).alias("rule"),
        _first(*at).alias("listed"),
        F.filter(F.split("path", "/"), lambda part: part != "").alias("segments"),
    )
    nodes = nodes.withColumns(
        {
            "known": F.when(F.col("listed").isNotNull(), F.col("n")).otherwise(0),
            "bad": F.when(F.col("listed") == BLOCK, F.col("n")).otherwise(0),
        }
    )
    nodes = land(nodes, "paths")
    known, bad = nodes.agg(F.sum("known"), F.sum("bad")).first()
    prior = (bad or 0) / (known or 1)
    hosts = nodes.groupBy("host").agg(F.sum("known").alias("labelled"), F.sum("bad").alias("bads"))
    hosts = hosts.select(
        F.col("host").alias("h"),
        ((F.col("bads") + WEIGHT * prior) / (F.col("labelled") + WEIGHT)).alias("purity"),
        F.col("labelled").alias("support"),
    )
    nodes = nodes.join(land(hosts, "hosts"), F.col("host") == F.col("h")).drop("h")
    grown, level = nodes.withColumns({"prefix": F.lit(""), "shut": F.lit(False)}), 0
    done = []
    while not grown.where("not shut").isEmpty():
        done.append(grown.where("shut"))
        grown = land(_grow(grown.where("not shut"), level), "level")
        level += 1
    for part in done:
        grown = grown.unionByName(part.select(*grown.columns))
    method = F.when((F.col("purity") >= purity) & (F.col("support") >= support), BLOCK).otherwise(ALLOW)
    verdicts = grown.select(
        F.col("host").alias("h"),
        F.col("path").alias("p"),
        "rule",
        F.coalesce("listed", method).alias("verdict"),
        F.col("prefix").alias("template"),
        "purity",
        "support",
    )
    found = rows.join(land(verdicts, "verdicts"), (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")))
    return found.select("page_id", "host", "path", "rule", "verdict", "template", "purity", "support")
