"""Column functions on URLs: hosts, resolving references, scope of links."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Endings of links to files that are not pages.
ASSET_ENDINGS = ["css", "js", "png", "jpg", "pdf"]
# Parts of host names that are not crawled.
IGNORED_HOST_PARTS = [
    "auth", "login", "sso", "shibboleth", "vpn", "mail", "email", "outlook", "exchange", "kronos", "canvas", "compass", "moodle",
    "test", "dev", "stage", "staging", "demo", "admin", "intranet", "printing", "calendar", "directory", "files", "ftp", "remote",
    "cites", "help", "support", "status",
]
# Parts of URLs whose pages need a browser.
BROWSER_PARTS = ["courses", "schedule", "calendar", "events", "directory", "apps"]
# Host prefixes that are tried where few seeds were found.
COMMON_PREFIXES = [
    "www", "cs", "ece", "math", "physics", "chem", "engr", "lib", "housing", "academics", "admissions", "grad", "research",
    "news", "athletics", "engineering", "education", "law", "business", "medicine", "pharmacy", "arts", "music",
    "provost", "chancellor", "hr", "it", "ics", "gis", "data", "api", "web", "blog", "media", "studentaffairs",
]
# Host prefixes of the seeds of last resort.
FALLBACK_PREFIXES = ["www", "housing", "academics", "cs"]


def host_of(url: Column) -> Column:
    """Host with port and user part; null for what is no URL."""
    return F.try_parse_url(url, F.lit("AUTHORITY"))


@F.pandas_udf(T.StringType())
def resolve(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Reference (second) against page URL (first), without its fragment; null where it is no URL."""
    for base, ref in parts:
        yield pd.Series([_resolved(b, r) for b, r in zip(base, ref, strict=True)], dtype=object)


def _resolved(base: str | None, ref: str | None) -> str | None:
    try:
        return urldefrag(urljoin(base or "", ref)).url if ref is not None else None
    except ValueError:
        return None


def resolve_simple(base: Column, ref: Column) -> Column:
    """:func:`resolve` in built-in functions for absolute and root-relative references; others are null."""
    bare = F.substring_index(ref, "#", 1)
    origin = F.regexp_extract(base, "^(https?://[^/?#]+)", 1)
    return F.when(bare.rlike("^https?://"), bare).when(bare.startswith("//"), F.concat(F.regexp_extract(base, "^(https?:)", 1), bare)).when(bare.startswith("/"), F.concat(origin, bare))


def is_asset(url: Column) -> Column:
    return url.rlike(r"\.(" + "|".join(ASSET_ENDINGS) + r")\z")


def in_parse_scope(url: Column, root: str) -> Column:
    """Links kept when a page is parsed: the root domain is anywhere in them, and they are no assets."""
    return url.contains(root) & ~is_asset(url)


def in_crawl_scope(url: Column, root: str, strict: bool = False) -> Column:
    """Links that may be crawled: the host ends with the root domain (``strict``: at a dot), by http or https."""
    host = F.coalesce(host_of(url), F.lit(""))
    inside = host.endswith(root) if not strict else (host == root) | host.endswith("." + root)
    return inside & F.lower(F.coalesce(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit(""))).isin("http", "https")


def ignored_host(host: Column) -> Column:
    """Whether any of :data:`IGNORED_HOST_PARTS` is anywhere in the host."""
    return host.rlike("|".join(IGNORED_HOST_PARTS))


def fetch_route(url: Column, html: Column, network_error: Column, blacklisted: Column, dns_failures: Column) -> Column:
    """``browser`` for URLs that need one, ``browser_fallback`` for short static results without another cause, else ``static``."""
    short = F.length(F.coalesce(html, F.lit(""))) < 500
    return F.when(url.rlike("|".join(BROWSER_PARTS)), "browser").when(short & ~network_error & ~blacklisted & (dns_failures < 3), "browser_fallback").otherwise("static")
