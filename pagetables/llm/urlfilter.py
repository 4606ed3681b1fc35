"""URL filters whose block decisions follow redirects and canonical links.

Rules name a host, with all its subdomains, and a path prefix; the longest rule that fits a
URL decides on it.  URLs that redirect to one another, or that name another URL as their
canonical one, are aliases: the connected components of those edges.  A URL no rule fits is
blocked if an alias is blocked by a rule, unless an alias is explicitly allowed, which goes
first; with neither it is allowed.  Fragments are not part of a URL's identity.  Targets are
resolved as browsers do: against the page's URL, or the one its base element names.

Rules meet URLs by an equi-join on host suffixes, then by prefix; only the best rule's place
is kept, by a partial maximum.  Decisions reach aliases through one boolean pair a component.

Defined cases: a NULL URL or one without ``://`` has an empty host and path, fits no rule,
has no alias and is allowed; repeated rows each get a row; NULL html has no links; an empty
table gives no rows; columns that clash with the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.llm.common import Tucked, stored
from pagetables.llm.components import components

# The rules of the contract.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A tag's text, its attributes in any order: canonical links and refreshing redirects.
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*['"]?([^"'\s>]+)"""

BASE = r"""(?is)<base\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"
ROOT, DOTS = r"(?s)^.*?://[^/?#]*", r"/\.\.?(/|\z)"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """What identifies a URL: scheme, lower-cased host and the rest without fragment."""
    found = url.contains("://")
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    scheme = F.translate(F.substring_index(url, "://", 1), UPPER, LOWER)
    return F.when(found, F.concat(scheme, F.lit("://"), host_of(url), F.when(~rest.startswith("/"), "/").otherwise(""), rest))


def without_dots(path: Column) -> Column:
    """A path that starts with a slash, without its ``.`` and ``..`` segments."""

    def step(kept: Column, part: Column) -> Column:
        return (
            F.when(part == ".", kept)
            .when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.lit(0), F.size(kept) - 1)))
            .otherwise(F.concat(kept, F.array(part)))
        )

    # A dot segment at the end leaves the slash before it.
    parts = F.split(F.regexp_replace(path, r"(/\.\.?)\z", "$1/"), "/")
    kept = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.array().cast("array<string>"), step)
    return F.when(path.rlike(DOTS), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def resolved(base: Column, link: Column) -> Column:
    """An absolute link as it is, any other as seen from the base; NULL if it has no host."""
    root, here = F.regexp_extract(base, ROOT, 0), F.regexp_extract(base, ROOT + "([^?#]*)", 1)
    scheme = F.concat(F.substring_index(base, "://", 1), F.lit(":"))
    path, query = F.regexp_extract(link, r"(?s)^[^?#]*", 0), F.regexp_extract(link, r"(?s)^[^?#]*(\?[^#]*)", 1)
    folder = F.when(here == "", "/").otherwise(F.regexp_extract(here, "(?s)^.*/", 0))
    local = (
        F.when(path.startswith("/"), F.concat(without_dots(path), query))
        .when(path != "", F.concat(without_dots(F.concat(folder, path)), query))
        .when(query != "", F.concat(here, query))
        .otherwise(F.regexp_extract(base, ROOT + "([^#]*)", 1))
    )
    return (
        F.when(link.rlike(SCHEME + "//"), link)
        .when(link.rlike(SCHEME) | ~base.contains("://"), F.lit(None).cast("string"))
        .when(link.startswith("//"), F.concat(scheme, link))
        .otherwise(F.concat(root, local))
    )


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(a, b)``: a page's node and the nodes of its canonical links and refresh targets."""
    links = F.concat(*[F.regexp_extract_all(html, F.lit(pattern), F.lit(1)) for pattern in (CANONICAL, REFRESH)])
    linked = F.col(html).rlike(r"(?i)canonical|refresh")

    def plain(link: str) -> Column:
        return F.replace(F.col(link), F.lit("&amp;"), F.lit("&"))

    found = pages.filter(linked & F.col(url).contains("://")).select(
        F.col(url).alias("page"), F.regexp_extract(html, BASE, 1).alias("base"), F.explode(F.array_distinct(links)).alias("link")
    )
    base = F.coalesce(resolved(F.col("page"), plain("base")), F.col("page"))
    seen = found.select("page", "link", base.alias("base"))
    return seen.select(node_of(F.col("page")).alias("a"), node_of(resolved(F.col("base"), plain("link"))).alias("b")).filter(
        F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    )


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def best_rules(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """``nodes(host, path)`` that a rule fits, with ``rule`` and ``ruled``: the longest's.

    Of rules of the same host and path, allow goes first.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    spread = nodes.filter("host <> ''").withColumn("suffix", F.explode(F.array_distinct(suffixes)))
    named = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("ruled"),
        F.concat("host", "path").alias("rule"),
    )
    fits = (F.col("suffix") == F.col("rule_host")) & F.col("path").startswith(F.col("rule_path"))
    rank = F.struct(F.length("rule").alias("n"), (F.col("ruled") == "allow").alias("first"), F.col("rule"), F.col("ruled"))
    best = spread.join(named, fits).groupBy("host", "path").agg(F.max(rank).alias("best"))
    return best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.ruled").alias("ruled"))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, url: str = "url",
          html: str | None = "html") -> DataFrame:
    """All rows with ``host``, ``path``, ``rule`` and ``verdict``.

    ``redirects(a, b)`` are pairs of URLs, ``b`` as seen from ``a``; edges of the pages' own html are added if given.
    """
    added = ("host", "path", "rule", "verdict")
    tucked = Tucked(pages)
    address = tucked[url]
    rows = tucked.frame.select(
        "*", host_of(address).alias("host"), path_of(address).alias("path"), node_of(address).alias("node")
    )
    edges = page_edges(pages, url, html) if html else None
    if redirects is not None:
        given = redirects.select(node_of(F.col("a")).alias("a"), node_of(resolved(F.col("a"), F.col("b"))).alias("b"))
        edges = given if edges is None else edges.unionByName(given)
    best = stored(best_rules(rows.select("host", "path").distinct(), rules), "rules")
    ruled = rows.join(
        best, ["host", "path"], "left"
    )
    if edges is None:
        spread = ruled.withColumn("aliases", F.lit(None).cast("string"))
    else:
        spread = _with_aliases(ruled, edges, rules)
    verdict = F.coalesce("ruled", "aliases", F.lit("allow"))
    return spread.select(*tucked.back(*added), "host", "path", "rule", verdict.alias("verdict"))


def _with_aliases(ruled: DataFrame, edges: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``aliases``: what the rules say of a node's component.

    Nodes that are linked but are no page count as well, so their rules are looked up too.
    """
    members = stored(components(stored(edges, "links")), "aliases")
    parts = members.select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    said = parts.join(best_rules(parts.select("host", "path").distinct(), rules), ["host", "path"])
    decided = said.groupBy("component").agg(
        F.max(F.col("ruled") == "allow").alias("allowed"), F.max(F.col("ruled") == "block").alias("blocked")
    )
    word = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block")
    by_node = members.join(decided, "component").select(F.col("node").alias("_n"), word.alias("aliases"))
    return ruled.join(by_node, F.col("node") == F.col("_n"), "left").drop("_n")
