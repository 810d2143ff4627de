"""URL filtering by host and path rules, with block decisions carried over redirect and canonical-link aliases.

Rules decide first: a rule fits its host and every subdomain when the URL's path starts with the rule's path, and the
longest fitting rule wins. A URL that no rule fits takes its verdict from its redirect-equivalence class: pages, the
targets of their ``<link rel=canonical>`` and of their meta refresh are nodes, those relations are edges, and connected
components are the classes. A class that holds a blocked URL blocks all its URLs except those that an explicit allow
rule fits; all others are allowed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.llm.common import Scratch, fresh, table
from rollweave.llm.components import connected_components


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


#: The contract's rules.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_REST = r"^.*?://"
#: HTML's white space; names and values of attributes.
_WS = r"[ \t\n\f\r]"
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^ \t\n\f\r"'>][^ \t\n\f\r>]*)"""
_NAME = r"[^ \t\n\f\r/>=]+"
ATTRIBUTE = rf"[ \t\n\f\r/]?{_NAME}{_WS}*={_WS}*{_VALUE}"
#: Elements whose content is text, or inert.
_RAW = "script style textarea title xmp iframe noembed noframes template".split()


def token(loop: str = "*+") -> str:
    """A pattern for comments, elements of raw text as a whole, and all other tags, in whose attributes any of these may stand.

    Whatever follows a tag's name belongs to it up to its end or the page's, so no page is read twice. ``loop``: how
    often a tag has attributes; the possessive form needs no stack in Java, other engines want ``*``.
    """
    value = rf"""(?:"[^"]*(?:"|\z)|'[^']*(?:'|\z)|[^ \t\n\f\r"'>][^ \t\n\f\r>]*)?"""
    attributes = rf"(?:[ \t\n\f\r/]+|=|{_NAME}(?:{_WS}*={_WS}*{value})?){loop}(?:>|\z)"
    raw = "|".join(rf"<{name}(?:[ \t\n\f\r/]{attributes}|>).*?(?:</{name}|\z)" for name in _RAW)
    return rf"(?is)<!--(?:-?>|.*?(?:--!?>|\z))|{raw}|<[a-z][^ \t\n\f\r/>]*{attributes}"


def link_tag(loop: str = "*+") -> str:
    """A pattern for link, meta and base tags as a whole: their quotes are closed and they end."""
    return rf"(?is)^<(?:link|meta|base)(?:[ \t\n\f\r/](?:[ \t\n\f\r/]+|{_NAME}(?:{_WS}*={_WS}*{_VALUE})?){loop}(?:={_WS}*)?)?>$"


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_replace(url, "(?s)" + _REST, "")).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, or nulls. Among rules of one length the first listed wins."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host_ == rule.host) | host_.endswith("." + rule.host)) & path_.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def node(url: Column) -> Column:
    """What identifies a URL in the alias graph: host, path and query; scheme and fragment don't matter. Null without a host."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*(\?[^#]*)?", 1)
    spot = F.when(path(url) == "", F.lit("/")).otherwise(path(url))
    return F.when(host(url) != "", F.concat(host(url), spot, F.coalesce(query, F.lit(""))))


def without_dots(url: Column) -> Column:
    """An absolute URL without ``.`` and ``..`` segments in its path, by RFC 3986, 5.2.4."""
    none = F.array().cast("array<string>")
    parts = F.split(F.regexp_replace(path(url), "^/", ""), "/", -1)
    step = lambda held, x: (
        F.when(x == "..", F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0)))).when(x == ".", held).otherwise(F.concat(held, F.array(x)))
    )
    open_end = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(none)
    clean = F.concat(F.lit("/"), F.array_join(F.concat(F.aggregate(parts, none, step), open_end), "/"))
    start, end = F.regexp_extract(url, r"^(.*?://[^/?#]*)", 1), F.regexp_extract(url, r"^.*?://[^?#]*(.*)$", 1)
    return F.when(path(url).rlike(r"(^|/)\.\.?(/|$)"), F.concat(start, clean, end)).otherwise(url)


def resolved(base: Column, link: Column) -> Column:
    """A link as an absolute URL: absolute, ``//host/..``, ``/path``, ``?query`` and relative forms; ``.`` and ``..`` stay as written (see without_dots)."""
    root = F.regexp_extract(base, r"^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^(.*?:)//", 1)
    folder = F.concat(root, F.when(path(base) == "", F.lit("/")).otherwise(F.regexp_extract(path(base), r"^(.*/)", 1)))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(root, path(base), link))
        .otherwise(F.concat(folder, link))
    )


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's first attribute of that name as it is written, without quotes; null without one."""
    found = F.filter(F.regexp_extract_all(tag, F.lit("(?s)" + ATTRIBUTE), F.lit(0)), lambda a: F.lower(F.regexp_extract(a, rf"^[ \t\n\f\r/]?({_NAME})", 1)) == name)
    value = F.regexp_extract(F.get(found, F.lit(0)), rf"(?s)^[^=]*={_WS}*(.*)$", 1)
    return F.when(F.left(value, F.lit(1)).isin('"', "'"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


_REFERENCE = re.compile(r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)(;|(?![=A-Za-z0-9]))")


def unescaped(value: str) -> str:
    """An attribute's value with its character references decoded; one without a semicolon counts where no = or letter follows."""

    def one(found: re.Match) -> str:
        if found[1][0] == "#":
            return unescape(f"&{found[1]};")
        return html5.get(found[1] + found[2], found[0])

    return _REFERENCE.sub(one, value)


def _target(value: Column) -> Column:
    """A link up to its first white space, references decoded; null if nothing is left."""
    decoded = F.udf(lambda v: v if v is None else unescaped(v), "string", useArrow=True)  # for the few links that hold a reference
    text = F.when(F.contains(value, F.lit("&")), decoded(value)).otherwise(value)
    return F.nullif(F.regexp_extract(text, r"(?s)^\s*(\S*)", 1), F.lit(""))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(page, from_url, place, kind: base, canonical or refresh, link) of pages that have a canonical link or a meta refresh.

    Only tags count: what stands in comments, scripts, other raw text, templates or attribute values doesn't. Pages that
    hold neither word cost one substring test.
    """
    body, base = F.col(html), F.col(url)
    has = F.contains(F.lower(body), F.lit("canonical")) | F.contains(F.lower(body), F.lit("refresh"))
    tags = F.filter(F.regexp_extract_all(body, F.lit(token()), F.lit(0)), lambda t: F.rlike(t, F.lit(link_tag())))
    rows = pages.where(has & (F.instr(base, "://") > 0)).select(base.alias("from_url"), F.xxhash64(body).alias("page"), F.posexplode(tags).alias("place", "tag"))
    sort = F.lower(F.regexp_extract("tag", r"^<([A-Za-z]+)", 1))
    rel, equiv = attribute(F.col("tag"), "rel"), attribute(F.col("tag"), "http-equiv")
    kind = (
        F.when(sort == "base", "base")
        .when((sort == "link") & F.rlike(rel, F.lit(r"(?i)(^|\s)canonical(\s|$)")), "canonical")
        .when((sort == "meta") & F.rlike(equiv, F.lit(r"(?i)^\s*refresh\s*$")), "refresh")
    )
    href = F.when(sort == "meta", F.regexp_extract(attribute(F.col("tag"), "content"), r"""(?is)\burl\s*=\s*["']?\s*([^"'\s]+)""", 1)).otherwise(attribute(F.col("tag"), "href"))
    found = rows.select("page", "from_url", "place", kind.alias("kind"), href.alias("href")).where("kind is not null")
    return found.select("page", "from_url", "place", "kind", _target(F.col("href")).alias("link")).where("link is not null")


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(from_url, to_url) for every canonical link and meta refresh of a page, resolved against the page's first base.

    A target with dot segments is an alias both without them and as written, since a page's own URL is taken as written.
    Links in comments, scripts and other raw text are none; null and very long pages are read like others, and rows that
    repeat a page's URL and HTML give the same edges.
    """
    links = page_links(pages, url, html)
    rows = links.groupBy("page", "from_url").agg(F.array_sort(F.collect_set(F.struct("place", "kind", "link"))).alias("links"))  # a page's links
    bases = F.filter("links", lambda x: x["kind"] == "base")
    rows = rows.withColumn("base", F.coalesce(resolved(F.col("from_url"), F.get(bases, F.lit(0))["link"]), F.col("from_url")))
    found = rows.select("from_url", "base", F.explode(F.filter("links", lambda x: x["kind"] != "base")).alias("x"))
    found = found.select("from_url", resolved(F.col("base"), F.col("x.link")).alias("to_url"))
    return found.select("from_url", F.explode(F.array_distinct(F.array("to_url", without_dots(F.col("to_url"))))).alias("to_url"))


def judge(pages: DataFrame, edges: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict to every row of ``pages``; columns of these names are replaced.

    ``edges``: (from_url, to_url). Null and malformed URLs have an empty host and path, fit no rule, have no aliases and
    are allowed. Repeated URLs share a node; empty tables give empty results. Only URLs that take part in an edge enter
    the component search, and only those rows are looked up; the others keep their rule or are allowed.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "urls")
    pages = pages.drop(*(c for c in pages.columns if c.lower() in ("host", "path", "rule", "verdict")))
    links = scratch.keep(
        edges.select(F.explode(F.array(F.struct(F.col("from_url").alias("u"), F.col("to_url").alias("v")))).alias("e"))
        .select(node(F.col("e.u")).alias("a"), node(F.col("e.v")).alias("b"))
        .where("a is not null and b is not null")
        .distinct(),
        "links",
    )
    (key,) = fresh(pages, "alias_key")
    h, p = host(F.col(url)), path(F.col(url))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    judged = pages.withColumns({"host": h, "path": p}).withColumns({"rule": rule, "verdict": verdict})
    if links.isEmpty():
        return judged.withColumn("verdict", F.coalesce("verdict", F.lit("allow")))
    classes = connected_components(links, scratch)
    at = F.regexp_extract("node", r"^([^/]*)", 1)
    spot = F.regexp_extract("node", r"^[^/]*(/[^?]*)", 1)
    known = classes.select("node", "component", matched(at, spot, rules)[1].alias("own"))
    bad = known.where("own = 'block'").select("component").distinct()
    aliases = known.join(bad, "component", "left_semi").select(F.col("node").alias(key), F.lit(True).alias("aliased"))
    return (
        judged.withColumn(key, node(F.col(url)))
        .join(aliases, key, "left")
        .withColumn("verdict", F.coalesce("verdict", F.when(F.col("aliased"), F.lit("block")), F.lit("allow")))
        .drop(key, "aliased")
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(pages.select("page_id", "url"), alias_edges(pages)).select("page_id", "host", "path", "rule", "verdict")
