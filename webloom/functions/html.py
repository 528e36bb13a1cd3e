"""HTML to text, links and metadata with the standard library's parser, as Arrow UDFs.

Noise is given by a rule set: tags to skip, and substrings of the class or id of
given tags.  Text after a skipped element is kept.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_LINE = {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "table", "ul", "ol", "title", "body", "blockquote", "pre", "dd", "dt"}
_SILENT = {"script", "style", "noscript", "head", "template"}


@dataclasses.dataclass(frozen=True)
class Noise:
    """Tags to skip, and (tag, attribute, part of its value) of elements to skip."""

    tags: frozenset[str]
    marked: tuple[tuple[str, str, str], ...] = ()

    def skips(self, tag: str, attrs: dict[str, str]) -> bool:
        return tag in self.tags or any(tag == t and part in attrs.get(a, "") for t, a, part in self.marked)


_FRAME = frozenset({"script", "style", "noscript", "nav", "footer", "header", "aside"})
# What the three cleaners leave out.
COOKIE_NOISE = Noise(_FRAME, (("div", "class", "cookie"), ("div", "id", "cookie"), ("a", "class", "skip-link")))
SIDEBAR_NOISE = Noise(_FRAME, (("div", "class", "nav"), ("div", "class", "footer"), ("div", "class", "sidebar"), ("div", "id", "sidebar")))
MENU_NOISE = Noise(
    _FRAME,
    (("div", "id", "cookie"), ("div", "class", "cookie"), ("div", "class", "menu"), ("div", "class", "navigation"), ("a", "class", "skip-link"), ("div", "role", "navigation")),
)
SKIP_PHRASE = "Skip to main content"

PAGE_TYPE = "struct<title: string, og_title: string, content: string, links: array<string>, published: string, time_tag: string, description: string>"
_PAGE_ARROW = pa.struct([(k, pa.list_(pa.string()) if k == "links" else pa.string()) for k in ("title", "og_title", "content", "links", "published", "time_tag", "description")])


class _Reader(HTMLParser):
    def __init__(self, noise: Noise):
        super().__init__(convert_charrefs=True)
        self.noise, self.skipped, self.open = noise, 0, []
        self.lines, self.hrefs, self.title, self.meta, self.time = [[]], [], [], {}, None
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        found = {k: v or "" for k, v in attrs}
        if tag == "a" and "href" in found:
            self.hrefs.append((found["href"], bool(self.skipped) or self.noise.skips(tag, found)))
        if tag == "meta" and (name := found.get("property") or found.get("name")):
            self.meta.setdefault(name, found.get("content"))
        if tag == "time" and self.time is None:
            self.time = found.get("datetime")
        if tag == "title":
            self.in_title = True
        if tag in _LINE:
            self.lines.append([])
        if tag in _VOID:
            return
        skip = self.noise.skips(tag, found) or tag in _SILENT
        self.open.append((tag, skip))
        self.skipped += skip

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        if tag in _LINE:
            self.lines.append([])
        if any(t == tag for t, _ in self.open):
            while self.open:
                t, skip = self.open.pop()
                self.skipped -= skip
                if t == tag:
                    break

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.skipped:
            self.lines[-1].append(data)

    def text(self) -> str:
        rows = (" ".join(x.split()) for line in self.lines for x in "".join(line).split("\n"))
        return "\n".join(x for x in rows if x)


def read_page(html: str | None, url: str | None, noise: Noise = COOKIE_NOISE, links_from: str = "raw") -> dict:
    """Fields of one page; a document that the parser gives up on keeps what was read."""
    r = _Reader(noise)
    try:
        r.feed(html or "")
        r.close()
    except (AssertionError, ValueError):
        pass
    links = []
    for ref, noisy in r.hrefs:
        if links_from == "raw" or not noisy:
            try:
                links.append(urldefrag(urljoin(url or "", ref)).url)
            except ValueError:
                continue
    return {
        "title": " ".join("".join(r.title).split()) or None,
        "og_title": r.meta.get("og:title") or None,
        "content": r.text(),
        "links": links,
        "published": r.meta.get("article:published_time") or None,
        "time_tag": r.time or None,
        "description": r.meta.get("description") or None,
    }


#: Pages are read in slices of at most this many rows and about this many bytes of html; a longer page is alone.
_SLICE_ROWS, _SLICE_BYTES = 256, 1 << 20


def _slices(html: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows that are read at once."""
    size, i = pc.fill_null(pc.binary_length(html), 0).to_numpy(zero_copy_only=False).cumsum(dtype=np.int64), 0
    while i < len(html):
        before = size[i - 1] if i else 0
        j = min(max(i + 1, int(np.searchsorted(size, before + _SLICE_BYTES, "right"))), i + _SLICE_ROWS)
        yield i, j
        i = j


def page_udf(noise: Noise = COOKIE_NOISE, links_from: str = "raw"):
    """A UDF of (html, url) that gives :data:`PAGE_TYPE`.

    A worker holds the fields of one slice of a batch at a time.  It counts as
    nondeterministic, or a filter on a field would be moved below it and every page be read twice.
    """

    @F.arrow_udf(PAGE_TYPE)
    def read(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for html, url in parts:
            for i, j in _slices(html):
                rows = zip(html[i:j].to_pylist(), url[i:j].to_pylist(), strict=True)
                yield pa.array([read_page(h, u, noise, links_from) for h, u in rows], _PAGE_ARROW)

    return read.asNondeterministic()


def parse_pages(pages: DataFrame, root_domain: str = "", noise: Noise = COOKIE_NOISE, min_content: int = 50, links_from: str = "raw") -> DataFrame:
    """url, title, content, links, published_at of pages (url, html) with enough content; links in scope only."""
    from webloom.functions.url import in_parse_scope

    p = F.col("p")
    links = F.filter(p["links"], lambda x: in_parse_scope(x, root_domain))
    return (
        pages.withColumn("p", page_udf(noise, links_from)("html", "url"))
        .filter(F.length(p["content"]) >= min_content)
        .select("url", F.coalesce(p["title"], F.lit("No Title")).alias("title"), p["content"].alias("content"), links.alias("links"), F.coalesce(p["published"], p["time_tag"]).alias("published_at"))
    )


def page_metadata(pages: DataFrame, noise: Noise = SIDEBAR_NOISE) -> DataFrame:
    """url, title (og:title first), publish_time and description, with their defaults."""
    p = F.col("p")
    return pages.withColumn("p", page_udf(noise)("html", "url")).select(
        "url",
        F.coalesce(p["og_title"], p["title"], F.lit("No Title")).alias("title"),
        F.coalesce(p["published"], p["time_tag"], F.lit("Unknown")).alias("publish_time"),
        F.coalesce(p["description"], F.lit("")).alias("description"),
    )


def extraction_report(pages: DataFrame, noise: Noise = MENU_NOISE) -> DataFrame:
    """Sizes before and after cleaning, the share of noise in per cent (null for an empty page), and warnings."""
    text = F.col("p")["content"]
    return pages.withColumn("p", page_udf(noise)("html", "url")).select(
        "url",
        F.length("html").alias("raw_chars"),
        F.length(text).alias("clean_chars"),
        F.round((1 - F.try_divide(F.length(text), F.length("html"))) * 100, 1).alias("noise_reduction"),
        text.contains(SKIP_PHRASE).alias("has_residue"),
        (F.length(text) < 200).alias("too_short"),
    )


def hrefs(html: Column) -> Column:
    """Values of ``href`` of all ``a`` elements, in order, by regular expression."""
    return F.regexp_extract_all(html, F.lit('<a [^>]*href="([^"]*)"'), F.lit(1))


def title_text(html: Column) -> Column:
    """The text of the title element as it is written, or ``No Title``."""
    return F.coalesce(F.nullif(F.regexp_extract(html, "<title>([^<]*)</title>", 1), F.lit("")), F.lit("No Title"))


def visible_lines(text: Column) -> Column:
    """Lines stripped, blank ones dropped."""
    return F.array_join(F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != ""), "\n")
