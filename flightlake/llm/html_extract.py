"""Main text of web pages by site style trees.

The pages of one host are merged into a style tree: a node is an element's path
of block elements with their classes, and holds the texts found there on all
pages of the host. A node whose texts say the same on page after page (the mean
over its texts of one less their entropy over the pages is under ``LEAST``) is
presentation, and its branches are removed from each page. Entropy alone cannot
tell an article from menus and adverts that differ on every page, so elements
and class names that name their part (fixed table below) are decided first:
their importance is 0, and every other node, inside an ``article`` or ``main``
too, is weighed by entropy. Nodes that hold half or more of an article's own
text are the article, whatever they weigh. A page's text is what is left in its
``article`` or ``main``; where that is less than ``TEASER`` of all that is left
of the page, or where there is none, it is all that is left.

Null and empty pages have an empty text; cut-off pages are read to their end.
Repeated pages count each outside of articles; within, an article is known by
its longest block and counts once, so that copies of it do not look like a
site's presentation. Nodes on under ``MIN_PAGES`` pages keep what is not named.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .url_filter import host

#: Importance under which a node is presentation, and pages that a tree needs.
LEAST = 0.2
MIN_PAGES = 4
#: Share of a page's text under which an ``article`` is not all of its main text.
TEASER = 0.25

#: Elements and names of parts that are not the article.
PARTS = set("""head nav aside footer form script style noscript template iframe svg math button select textarea
dialog object canvas audio video map menu datalist""".split())
NAMES = set("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies
consent gdpr notice notices alert nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside widget widgets
footer comment comments reply replies disqus share sharing social related recommended newsletter subscribe subscription
signup login popup modal overlay contentinfo complementary search pagination pager skip""".split())
#: The same, only outside of an article.
OUTSIDE = set("header masthead topbar toolbar".split())
MAIN = {"article", "main"}
INLINE = set("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp
small span strike strong sub sup time tt u var wbr""".split())
VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
#: Elements that end when one of the same group begins beside them.
_CLOSES = {x: group for group in ({"li"}, {"dt", "dd"}, {"tr"}, {"td", "th"}, {"option"}) for x in group}
_STOPS = {"table", "ul", "ol", "dl", "body", "article", "main", "section", "div", "td", "th", "select"}

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z))""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")


def blocks(html: str) -> tuple[bool, list[tuple[str, bool, str]]]:
    """Whether the page has a main element, and ``(path, inside it, text)`` of
    every block of text that no name rules out, in page order."""
    # A stack entry: tag, ruled out, inside the main element, path.
    stack = [("", False, False, "")]
    out: list[tuple[str, bool, str]] = []
    text: list[str] = []
    has_main = False
    at = 0

    def flush():
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                out.append((stack[-1][3], stack[-1][2], joined))
            text.clear()

    def add(part: str):
        if part and not stack[-1][1]:
            text.append(part)

    def close(tag: str):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return
            if stack[i][0] in _STOPS and (tag in INLINE or tag == "p"):
                return

    while at < len(html):
        m = _TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at:m.start()])
        at = m.end()
        end, tag, rest = m[1], (m[2] or "").lower(), m[3] or ""
        if not tag:
            continue
        if tag not in INLINE:
            flush()
        if tag == "br":
            continue
        if end:
            close(tag)
            continue
        if tag not in INLINE:
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i][0] == "p":
                    del stack[i:]
                    break
                if stack[i][0] in _STOPS:
                    break
            group = _CLOSES.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in group:
                    del stack[i:]
                    break
                if stack[i][0] in _STOPS:
                    break
        if tag in VOID:
            continue
        _, gone, inside, path = stack[-1]
        named = [x for a in _NAMED.finditer(rest) for x in _WORDS.findall((a[2] or a[3] or a[4] or "").lower())] if "=" in rest else []
        if tag == "body":
            named = []
        if tag in PARTS or not NAMES.isdisjoint(named) or (not inside and (tag in OUTSIDE or not OUTSIDE.isdisjoint(named))):
            gone = True
        elif tag in MAIN and not gone:
            has_main = inside = True
        if rest.endswith("/") and tag in ("svg", "math", "path"):
            continue
        stack.append((tag, gone, inside, path if tag in INLINE else f"{path}/{'.'.join([tag, *sorted(set(named))])}"))
        if tag in RAW:
            close_at = re.compile(rf"</{tag}\b", re.I).search(html, at)
            if not gone and close_at:
                add(html[at:close_at.start()])
            at = close_at.start() if close_at else len(html)
    flush()
    return has_main, out


_PARTS_SQL = "article long, parts array<struct<path:string,name:long,inside:boolean,text:string>>"
_PART = pa.list_(pa.struct([("path", pa.string()), ("name", pa.int64()), ("inside", pa.bool_()), ("text", pa.string())]))


def _parsed(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, article, parts``: every block that no name rules
    out, and the name of the longest one inside the main element (else null)."""
    def run(batches):
        for b in batches:
            articles, rows = [], []
            for html in b.column("html").to_pylist():
                parts = [{"path": p, "name": xxhash.xxh3_64_intdigest(t) >> 1, "inside": inside, "text": t}
                         for p, inside, t in blocks(html or "")[1]]
                longest = max((p for p in parts if p["inside"]), key=lambda p: (len(p["text"]), p["name"]), default=None)
                articles.append(longest and longest["name"])
                rows.append(parts)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("page_id", "url", "host")), pa.array(articles, pa.int64()),
                                              pa.array(rows, _PART)], names=["page_id", "url", "host", "article", "parts"])

    kinds = dict(pages.dtypes)
    return (pages.select("page_id", "url", host(F.col("url")).alias("host"), "html")
            .mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, host string, {_PARTS_SQL}"))


def style_tree(parsed: DataFrame) -> DataFrame:
    """``host, path, pages, importance`` of each style node. For a node on ``m``
    pages, a text on ``k`` of them has entropy log k / log m; the node's
    importance is the mean of one less that, weighted by ``k``. Texts are
    counted before anything of one host meets."""
    parts = parsed.select("host", F.xxhash64("page_id", "url").alias("page"), "article", F.explode("parts").alias("part"))
    on = (parts.select("host", F.col("part.path").alias("path"), F.col("part.name").alias("name"),
                       F.when(F.col("part.inside"), F.col("article")).otherwise(F.col("page")).alias("page"))
          .groupBy("host", "path", "name", "page").agg(F.lit(1).alias("one")))
    pages = on.groupBy("host", "path", "page").agg(F.lit(1).alias("one")).groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))
    texts = on.groupBy("host", "path", "name").agg(F.count(F.lit(1)).cast("double").alias("k"))
    sums = texts.groupBy("host", "path").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.log("k")).alias("nats"))
    spread = F.when(F.col("pages") > 1, F.col("nats") / F.log(F.col("pages").cast("double"))).otherwise(0.0)
    return sums.join(pages, ["host", "path"]).select("host", "path", "pages", (1 - spread / F.col("n")).alias("importance"))


def _chars(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n + F.length(p["text"]))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``pages(page_id, url, html)``."""
    parsed = stored(_parsed(pages), "parsed")
    # At most the nodes of one site's tree in a row; stored, so that its size decides how the texts meet it.
    low = stored(style_tree(parsed).where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < LEAST))
                 .groupBy("host").agg(F.collect_set("path").alias("low")), "low")
    own = F.filter("parts", lambda p: p["inside"])
    is_low = lambda p: F.coalesce(F.array_contains("low", p["path"]), F.lit(False))
    mostly_low = 2 * _chars(F.filter(own, is_low)) >= _chars(own)
    weighed = (parsed.join(low, "host", "left")
               .withColumn("mostly_low", F.col("low").isNotNull() & mostly_low)
               .withColumn("parts", F.filter("parts", lambda p: ~is_low(p) | (p["inside"] & F.col("mostly_low")))))
    main = F.when(F.exists("parts", lambda p: p["inside"]) & (_chars(own) >= TEASER * _chars(F.col("parts"))), own).otherwise(F.col("parts"))
    text = F.array_join(F.transform(main, lambda p: p["text"]), " ")
    return weighed.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
