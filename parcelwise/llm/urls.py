"""URL filters: host and path rules, and block decisions that follow redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import ascii_lower, empty, store
from parcelwise.llm.components import components

#: (verdict, host, path); the production rules.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

TAG = r"<(?:link|meta)\b[^>]*+>"
CANONICAL = r"""(?i)\brel\s*=\s*["']?\s*canonical\b"""
HREF = r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
TARGET = r"""(?i)\burl\s*=\s*["']?([^"'>\s]+)"""


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*+)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*+([^?#]*+)", 1)


def match_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits host and path as ``struct<rule, verdict>``; NULL without one."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in reversed(ordered):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


URL = r"^([^:/?#]+)://([^/?#]*)([^?#]*)(\?[^#]*)?"


def _without_dots(path: Column) -> Column:
    """A path that begins with ``/``, its ``.`` and ``..`` segments resolved."""
    whole = F.regexp_replace(path, r"(/\.{1,2})$", "$1/")

    def walk(done: Column, s: Column) -> Column:
        back = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(s == ".", done).when(s == "..", back).otherwise(F.concat(done, F.array(s)))

    kept = F.aggregate(F.split(F.substring(whole, 2, F.length(whole)), "/", -1), empty("string"), walk)
    return F.when(F.contains(whole, F.lit("/.")), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(whole)


def node_of(url: Column) -> Column:
    """A url as a node: scheme and host in lower case, no default port, ``/`` for an empty path, no dot segments, no fragment."""
    scheme, host, path, query = (F.regexp_extract(url, URL, k) for k in range(1, 5))
    scheme = ascii_lower(scheme)
    port = F.when(scheme == "http", ":80").when(scheme == "https", ":443").otherwise("")
    host = ascii_lower(host)
    bare = F.when((port != "") & F.endswith(host, port), F.substring(host, F.lit(1), F.length(host) - F.length(port))).otherwise(host)
    path = F.when(path == "", "/").otherwise(_without_dots(path))
    return F.when(scheme != "", F.concat(scheme, F.lit("://"), bare, path, query)).otherwise(F.regexp_replace(url, "#.*$", ""))


def _absolute(link: Column, url: Column) -> Column:
    """The node of a link found in the page at ``url``; NULL if it names no web address."""
    scheme, host, path = (F.regexp_extract(url, URL, k) for k in (1, 2, 3))
    origin = F.concat(scheme, F.lit("://"), host)
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, "[^/]*$", ""))
    whole = (
        F.when(link.rlike("(?i)^https?://"), link)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | (scheme == ""), F.lit(None))
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(origin, link))
        .when(F.startswith(link, F.lit("?")), F.concat(origin, path, link))
        .when((link != "") & ~F.startswith(link, F.lit("#")), F.concat(origin, folder, link))
    )
    return node_of(whole)


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(a, b)``: the nodes of a page and of the url that its canonical link or its refresh redirect names, relative ones too."""
    likely = F.col(html_col).rlike("(?i)canonical|http-equiv")
    tags = pages.where(F.col(url_col).isNotNull() & likely).select(
        F.col(url_col).alias("url"), F.explode_outer(F.regexp_extract_all(html_col, F.lit("(?i)" + TAG), F.lit(0))).alias("tag")
    )
    tag = F.col("tag")
    href = F.concat(*[F.regexp_extract(tag, HREF, g) for g in (1, 2, 3)])
    link = F.when(tag.rlike(CANONICAL), href).when(tag.rlike(REFRESH), F.regexp_extract(tag, TARGET, 1))
    links = tags.select("url", F.trim(F.replace(link, F.lit("&amp;"), F.lit("&"))).alias("link")).where("link is not null")
    return links.select(node_of(F.col("url")).alias("a"), _absolute(F.col("link"), F.col("url")).alias("b")).where("b is not null and a <> b")


def judge_urls(pages: DataFrame, redirects: DataFrame | None = None, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every row of ``pages``.

    A url's own rule decides. A url without a rule is an alias of all urls that redirects
    and canonical links reach from it, in either direction: it is blocked if one of them is
    blocked by a rule and none is allowed by one, and allowed otherwise, so an explicit allow
    comes before any propagated block. ``redirects(source, target)`` adds edges of a crawl
    log; its urls need not be pages. Fragments, the case of scheme and host, default ports, dot
    segments and an empty path do not tell urls apart. NULL urls, urls
    without ``://`` and repeated rows are judged by the same rules (empty host and path); NULL
    html has no links; an empty table gives an empty result; further columns are not read.

    Only urls with an edge enter the components, and one decision row per component is
    joined back, so the pages themselves are not shuffled by a hot host or a large alias group.
    """
    edges = page_links(pages, url_col, html_col)
    if redirects is not None:
        logged = redirects.select(*[node_of(F.col(c)).alias(n) for c, n in (("source", "a"), ("target", "b"))])
        edges = edges.union(logged.where("a is not null and b is not null and a <> b"))
    member = components(edges)
    own = match_rule(*split_url(F.col("node")), rules)["verdict"]
    decided = member.groupBy("component").agg(F.bool_or(F.coalesce(own == "block", F.lit(False))).alias("block"), F.bool_or(F.coalesce(own == "allow", F.lit(False))).alias("allow"))
    blocked = decided.where("block and not allow").select("component")
    aliases = store(member.join(blocked, "component", "left_semi").select(F.col("node").alias("_url"), F.lit(True).alias("_alias")), "aliases")
    host, path = split_url(F.col("_full"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_full"))
    rows = rows.withColumn("_url", node_of(F.col("_full"))).withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    rows = rows.withColumn("_rule", match_rule(F.col("host"), F.col("path"), rules)).join(aliases, "_url", "left")
    verdict = F.coalesce(F.col("_rule")["verdict"], F.when(F.col("_alias"), "block"), F.lit("allow"))
    return rows.select("page_id", "host", "path", F.col("_rule")["rule"].alias("rule"), verdict.alias("verdict"))
