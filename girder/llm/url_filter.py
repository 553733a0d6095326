"""URL filter with redirect equivalence.

Every URL is judged by the longest rule that fits its host (or a parent of it) and starts its path.
Pages also name other addresses of themselves, by a canonical link or a refresh; those edges join
addresses to components (distributed, see ``components``). An address without a rule of its own takes
its component's decision: allow if any address there is explicitly allowed, else block if any
is blocked. What nothing decides is allowed.

An address is host, path and query: scheme and fragment don't tell pages apart, nor do ``.`` and ``..``
in a path. Relative links are resolved against the page; ``&amp;`` in a link is ``&``. Rules fit the path as the
page's URL writes it.

Defined results. Null URL or one without ``://``: empty host and path, no rule, no address, allowed.
Null page text: no edges. Ties of rules: the one that sorts first. Repeated rows: each is judged. Very long
texts are searched whole; a link's tag ends at the first ``>``. Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder.llm.common import written
from girder.llm.components import connected_components

ALLOW, BLOCK = "allow", "block"
#: host and path of each rule, and what it says.
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ATTRIBUTE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to / ? # or the end, A to Z in lower case."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(raw, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def undotted(path: Column) -> Column:
    """A path without the segments ``.`` and ``..``, the latter taking the one before it along."""
    kept = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == ".", acc)
        .when(x == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(x))),
    )
    ended = F.when(path.rlike(r"/\.\.?$"), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(F.contains(path, F.lit("/.")), F.array_join(ended, "/")).otherwise(path)


def address_of(url: Column) -> Column:
    """Host, path and query; null without ``://``."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    path = undotted(path_of(url))
    whole = F.concat(host_of(url), F.when(path == "", "/").otherwise(path), query)
    return F.when(F.contains(url, F.lit("://")), whole)


def _rule(host: Column, path: Column, rules: tuple) -> Column:
    """The longest fitting rule as a struct of rule and verdict, or null; rules are a literal list."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag; null if it has none."""
    pattern = rf"(?i)\s{name}{ATTRIBUTE}"
    parts = [F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]
    return F.nullif(F.trim(F.replace(F.concat(*parts), F.lit("&amp;"), F.lit("&"))), F.lit(""))


def _resolved(link: Column, url: Column) -> Column:
    """A link as a whole URL."""
    base = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    return (
        F.when(F.contains(link, F.lit("://")), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(base, link))
        .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), link))
    )


def edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """a, b: a page's address and another address that it says is its own."""
    html, url = F.col(html_col), F.col(url_col)
    links = F.regexp_extract_all(html, F.lit(r"(?i)<link\b[^>]*>"), F.lit(0))
    metas = F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*>"), F.lit(0))
    canonical = F.filter(
        links, lambda t: F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical")
    )
    refresh = F.filter(metas, lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh")
    to = F.concat(
        F.transform(canonical, lambda t: _attribute(t, "href")),
        F.transform(
            refresh,
            lambda t: F.nullif(
                F.regexp_extract(_attribute(t, "content"), r"(?i)url\s*=\s*['\"]?([^'\"]+)", 1),
                F.lit(""),
            ),
        ),
    )
    some = pages.filter(F.lower(html).rlike("canonical|refresh"))
    found = some.select(url.alias("u"), F.explode(to).alias("link")).filter("link IS NOT NULL")
    return found.select(
        address_of(F.col("u")).alias("a"), address_of(_resolved(F.col("link"), F.col("u"))).alias("b")
    ).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")


def judge(
    pages: DataFrame,
    rules: tuple = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    more_edges: DataFrame | None = None,
) -> DataFrame:
    """id, host, path, rule, verdict, component (null: no aliases) of every page.

    more_edges: a, b as addresses, such as redirects that a crawler saw.
    """
    links = edges(pages, url_col, html_col)
    if more_edges is not None:
        links = links.unionByName(more_edges.select("a", "b"))
    members = written(connected_components(links), "addresses")
    split = F.split("node", "/", 2)
    member_rule = _rule(split[0], F.concat(F.lit("/"), split[1]), rules)
    decided = members.withColumn("r", member_rule).groupBy("component").agg(
        F.when(F.max((F.col("r.verdict") == ALLOW).cast("int")) == 1, ALLOW)
        .when(F.max((F.col("r.verdict") == BLOCK).cast("int")) == 1, BLOCK)
        .alias("shared")
    )
    named = members.join(decided, "component").withColumnRenamed("node", "met")
    url = F.col(url_col)
    rows = pages.select(
        F.col(id_col).alias("id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        address_of(url).alias("address"),
    ).withColumn("r", _rule(F.col("host"), F.col("path"), rules))
    # a page without an address can't be a member; it is kept from meeting all others at null
    own = F.concat(F.lit("\0"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    joined = rows.join(named, F.coalesce("address", own) == F.col("met"), "left")
    return joined.select(
        "id",
        "host",
        "path",
        F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", "shared", F.lit(ALLOW)).alias("verdict"),
        "component",
    )
