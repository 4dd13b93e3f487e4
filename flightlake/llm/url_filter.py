"""URL filter with redirect equivalence.

Rules (host, path) decide a url directly: a rule fits its host and every
subdomain, when the url's path starts with the rule's path; the longest fitting
rule wins. Urls that no rule fits take the decision of their aliases: redirect
(``meta refresh``) and canonical links are edges between urls, and the connected
components of those edges are the alias classes. A class that holds an
explicitly allowed url is allowed, else one that holds a blocked url is
blocked, else (as for a url without aliases) it is allowed.

Null urls and urls without ``://`` have an empty host and path and fit no rule;
null html has no links; repeated urls are one node and get one decision.
"""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components

#: Fixed values: (verdict, host, path) of the rules.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without one."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def node(url: Column) -> Column:
    """Name of a url in the alias graph: host, path and query; the scheme and
    the fragment name the same resource. Null for null or without ``://``."""
    rest = _rest(url)
    return F.when(rest != "", F.concat(host(url), F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1)))


def rule_of(host_col: Column, path_col: Column, rules: list[tuple] = RULES) -> tuple[Column, Column]:
    """Name (host + path) and verdict of the longest fitting rule, or nulls.
    Longest: by the length of host and path together; block before allow and
    then by name where two are as long."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    name = verdict = None
    for v, h, p in order:
        fits = ((host_col == h) | F.endswith(host_col, F.lit("." + h))) & F.startswith(path_col, F.lit(p))
        if name is None:
            name, verdict = F.when(fits, h + p), F.when(fits, v)
        else:
            name, verdict = name.when(fits, h + p), verdict.when(fits, v)
    return name, verdict


_OFF = re.compile(r"(?is)<!--.*?-->|<script\b.*?</script>")
_TAG = re.compile(r"(?is)<(?:link|meta)\b[^>]*>")
_ATTRIBUTE = re.compile(r"(?is)\s([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


def linked(url: str, html: str) -> list[str]:
    """Absolute targets of the canonical links and refreshes of one page,
    outside of scripts and comments; a target that is no valid url is left out."""
    out = []
    for tag in _TAG.findall(_OFF.sub("", html)):
        at = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "").strip() for m in _ATTRIBUTE.finditer(tag)}
        href = at.get("href") if at.get("rel", "").lower() == "canonical" else None
        if at.get("http-equiv", "").lower() == "refresh":
            found = re.search(r"(?i)url\s*=\s*['\"]?([^'\"]*)", at.get("content", ""))
            href = found and found[1]
        try:
            if href and "://" in (target := urljoin(url, href)):
                out.append(target)
        except ValueError:
            pass
    return out


def _linked(frames):
    for f in frames:
        yield pd.DataFrame([(u, t) for u, h in zip(f["url"], f["html"]) for t in linked(u, h)], columns=["url", "target"])


def alias_edges(pages: DataFrame) -> DataFrame:
    """``(a, b)`` of node names: one for each canonical link and refresh target
    in ``pages(url, html)``. Only pages that hold such a tag reach Python."""
    found = (pages.where(F.col("url").isNotNull() & F.col("html").rlike(r"(?i)canonical|http-equiv"))
             .select("url", "html").mapInPandas(_linked, "url string, target string"))
    return found.select(node(F.col("url")).alias("a"), node(F.col("target")).alias("b"))


def url_filter(pages: DataFrame, redirects: DataFrame | None = None,
               rules: list[tuple] = RULES) -> DataFrame:
    """``pages(page_id, url, html)`` judged: ``page_id, host, path, rule,
    verdict``. ``redirects(source, target)`` adds logged redirects to the links
    found in the pages. Targets that are no page of the table still join their
    aliases, and a rule that fits such a target counts."""
    own = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
                       node(F.col("url")).alias("node"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = own.withColumn("rule", name).withColumn("own", verdict)
    edges = alias_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node(F.col("source")).alias("a"), node(F.col("target")).alias("b")).dropna())
    parts = components(edges)
    urls = F.concat(F.lit("x://"), F.col("node"))
    _, direct = rule_of(host(urls), path(urls), rules)
    classes = (parts.withColumn("direct", direct).groupBy("component")
               .agg(F.max(F.col("direct") == "allow").alias("ok"), F.max(F.col("direct") == "block").alias("bad")))
    passed = (parts.join(classes.where("coalesce(bad, false) and not coalesce(ok, false)"), "component", "left_semi")
              .select("node", F.lit("block").alias("passed")))
    return (own.join(passed, "node", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("own", "passed", F.lit("allow")).alias("verdict")))
