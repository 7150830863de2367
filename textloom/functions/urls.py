"""Column expressions on URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def part(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(F.coalesce(_c(c), F.lit("")), pattern, group)


URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def host(c: Column | str) -> Column:
    """Host in lower case without port and leading www."""
    return F.regexp_replace(F.regexp_replace(F.lower(part(c, URL, 2)), r":\d+$", ""), r"^www\.", "")


def canonical(c: Column | str) -> Column:
    """Scheme and host in lower case, no trailing slash or fragment, query sorted without empty values."""
    query = F.regexp_replace(part(c, URL, 4), r"^\?", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: x.rlike(r"^[^=]+=.+")))
    tail = F.array_join(kept, "&")
    path = F.regexp_replace(part(c, URL, 3), "/+$", "")
    base = F.concat(F.lower(part(c, URL, 1)), F.lit("://"), F.lower(part(c, URL, 2)), path)
    return F.when(F.coalesce(_c(c), F.lit("")) == "", "").otherwise(F.concat(base, F.when(tail == "", "").otherwise(F.concat(F.lit("?"), tail))))


def thread_id(c: Column | str) -> Column:
    """The last segment of the path, at most 128 characters; null without one."""
    last = F.try_element_at(F.filter(F.split(part(c, URL, 3), "/"), lambda x: x != ""), F.lit(-1))
    return F.substring(last, 1, 128)


def kind(c: Column | str) -> Column:
    """api_json, feed or html_page by the form of the URL."""
    u = F.lower(F.coalesce(_c(c), F.lit("")))
    api = u.endswith(".json") | u.contains("/api/") | u.contains("format=json") | u.contains("/v1/") | u.contains("/v2/")
    feed = u.contains("rss") | u.endswith(".xml") | u.contains("/feed")
    return F.when(api, "api_json").when(feed, "feed").otherwise("html_page")


def allowed(c: Column | str, domains: Column) -> Column:
    """Whether the host is one of the domains or below one; no domains allow all."""
    h = host(c)
    return (F.size(domains) == 0) | F.exists(domains, lambda d: (h == d) | h.endswith(F.concat(F.lit("."), d)))


def repository(c: Column | str) -> Column:
    """owner, name, ref and path of a repository URL (tree, blob or bare)."""
    p = r"^https?://[^/]+/([^/]+)/([^/#?]+?)(?:\.git)?(?:/(?:tree|blob|raw)/([^/]+)/?(.*))?/?$"
    none = lambda g: F.nullif(part(c, p, g), F.lit(""))
    return F.struct(none(1).alias("owner"), none(2).alias("name"), none(3).alias("ref"), none(4).alias("path"))
