"""Paged payloads, repository listings and responses that were staged as tables, and the rules that go with them.

A staged response is a row (url, status, content_type, disposition, payload). No request is made here: the rules that
decide which page comes next, what may be read and what has to be tried again work on what is there.
"""

from __future__ import annotations

import json
from pathlib import Path, PurePosixPath
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.sources import files
from textloom.sources.json_records import explode_records

# Endings of landing pages, HTML types, answers worth another try, and names that aren't data.
LANDING = (".html", ".htm", ".php", ".asp", ".aspx", ".jsp")
HTML_TYPES = ("text/html", "application/xhtml+xml")
AGAIN = (429, 503)
NOT_DATA = ("readme", "license", "requirements", "setup.py", ".ipynb")
#: Longest wait before another try, in seconds, and bytes that tell a page from a table.
LONGEST_WAIT, SNIFFED = 300.0, 8192


def pagination(raw: dict | None) -> dict:
    """Paging settings with defaults: the first page is 1, one page is read, and an empty page ends."""
    r = raw or {}
    return {
        "param": r.get("page_param") or r.get("param"), "start": int(r.get("start", r.get("start_page", 1))), "pages": max(1, int(r.get("max_pages", 1))),
        "size_param": r.get("page_size_param") or r.get("size_param"), "size": r.get("page_size"), "stop_when_empty": bool(r.get("stop_when_empty", True)),
    }


def page_urls(endpoint: str, params: dict | None = None, paging: dict | None = None) -> list[str]:
    """The addresses of an API's pages in order; one where paging has no parameter."""
    p = pagination(paging)
    parts = urlsplit(endpoint)
    out = []
    for k in range(p["pages"] if p["param"] else 1):
        query = dict(parse_qsl(parts.query, keep_blank_values=True)) | {k_: str(v) for k_, v in (params or {}).items()}
        if p["param"]:
            query[p["param"]] = str(p["start"] + k)
        if p["size_param"] and p["size"] is not None:
            query[p["size_param"]] = str(p["size"])
        out.append(urlunsplit((parts.scheme, parts.netloc, parts.path, urlencode(query), parts.fragment)))
    return out


def paged_records(staged: DataFrame, endpoint: str, fields: dict[str, str], path: str | None = None, params: dict | None = None, paging: dict | None = None) -> DataFrame:
    """(page, fields...) of an API's staged pages, up to the first empty or missing page; an answer of 400 or above is an error."""
    p = pagination(paging)
    turns = staged.sparkSession.createDataFrame(list(enumerate(page_urls(endpoint, params, paging), start=p["start"])), "page int, url string")
    got = staged.join(F.broadcast(turns), "url")
    bad = got.where(F.coalesce("status", F.lit(200)) >= 400).select("url", "status").first()
    if bad:
        raise ValueError(f"answer {bad['status']} of {bad['url']}")
    rows = explode_records(got, "payload", path, fields, ["page"])
    if not p["param"] or not p["stop_when_empty"]:
        return rows
    # pages with records, which are as many as pages were asked for
    full = {r["page"] for r in rows.select("page").distinct().collect()}
    end = next((k for k in range(p["start"], p["start"] + p["pages"]) if k not in full), p["start"] + p["pages"])
    return rows.where(F.col("page") < end)


def retry_after(status: int, header: str | None, attempt: int, base: float = 1.0) -> float | None:
    """Seconds to wait before another try: what the answer says, at most LONGEST_WAIT, else doubling; None for no other try."""
    if status not in AGAIN:
        return None
    try:
        wait = float(header) if header else base * 2**attempt
    except ValueError:
        wait = base * 2**attempt
    return min(max(wait, 0.0), LONGEST_WAIT)


def is_html_type(c: Column | str) -> Column:
    x = F.lower(F.trim(F.split_part(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), F.lit(";"), F.lit(1))))
    return x.isin(*HTML_TYPES)


def is_landing(url: Column | str) -> Column:
    """Whether an address ends like a page."""
    path = F.lower(F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1))
    out = F.lit(False)
    for ending in LANDING:
        out = out | path.endswith(ending)
    return out


def refused(staged: DataFrame) -> DataFrame:
    """(url, reason) of staged responses that aren't files: errors, pages by type, ending or beginning, and empty ones."""
    head = F.lower(F.substring("payload", 1, SNIFFED))
    page = is_html_type("content_type") | head.contains("<!doctype html") | head.contains("<html")
    reason = (
        F.when(F.coalesce("status", F.lit(200)) >= 400, F.concat(F.lit("answer "), F.col("status")))
        .when(T.missing("payload"), "empty")
        .when(page & is_landing("url"), "a landing page")
        .when(page, "a page, not a file")
    )
    return staged.select("url", reason.alias("reason")).where("reason is not null")


def payload_format(url: str, content_type: str | None, disposition: str | None, head: str) -> str | None:
    """Format of a response: by name and type, else by what it begins with."""
    got = files.detect_format(urlsplit(url).path, None, disposition, content_type)
    if got:
        return got
    start = head[:SNIFFED].lstrip()
    if start[:1] == "[" or start[:1] == "{":
        lines = [x for x in start.splitlines() if x.strip()][:2]
        if start[0] == "{" and len(lines) == 2:
            try:
                json.loads(lines[0])
                return "jsonl"
            except ValueError:
                pass
        return "json"
    if files.looks_like_html(start.encode()):
        return None
    first = start.splitlines()[0] if start else ""
    return "tsv" if "\t" in first else "csv" if "," in first else None


def listed(listing: DataFrame, depth: int = 4, subpath: str = "") -> DataFrame:
    """(path, size) of a repository's staged listing: files below the subpath, at most ``depth`` folders deep, that may hold data."""
    path = F.col("path")
    inside = path.startswith(subpath.strip("/") + "/") if subpath.strip("/") else F.lit(True)
    below = F.substring(path, len(subpath.strip("/")) + 2, 1 << 20) if subpath.strip("/") else path
    low = F.lower(path)
    kind = F.regexp_extract(low, r"(\.[a-z0-9]+)$", 1).isin(*files.SUFFIXES, ".zip")
    noise = F.lit(False)
    for w in NOT_DATA:
        noise = noise | low.contains(w)
    return listing.where(inside & (F.size(F.split(below, "/")) - 1 <= depth) & kind & ~noise).select("path", "size")


def local_listing(root: str) -> list[tuple[str, int]]:
    """(path, size) of the files under a staged folder."""
    base = Path(root)
    return sorted((PurePosixPath(p.relative_to(base)).as_posix(), p.stat().st_size) for p in base.rglob("*") if p.is_file())


def loader_options(spec: dict) -> dict:
    """What a hub's loader would be asked for: the name, subset, split with its row cap, revision and streaming."""
    split = spec.get("split") or "train"
    n = spec.get("sample_size")
    cap = f"{split}[:{n}]" if n and "[" not in split and not spec.get("streaming") else split
    return {k: v for k, v in {"path": spec.get("dataset_id") or spec.get("name"), "name": spec.get("subset"), "split": cap, "revision": spec.get("revision"), "streaming": bool(spec.get("streaming"))}.items() if v is not None}


def flattened(df: DataFrame, deepest: int = 3) -> DataFrame:
    """Structs as columns with dotted names joined by underscores, level by level; lists stay."""
    for _ in range(deepest):
        structs = [c for c, t in df.dtypes if t.startswith("struct")]
        if not structs:
            return df
        out = []
        for c, t in df.dtypes:
            if c in structs:
                out += [F.col(f"`{c}`.`{f.name}`").alias(f"{c}_{f.name}") for f in df.schema[c].dataType.fields]
            else:
                out.append(F.col(f"`{c}`"))
        df = df.select(*out)
    return df
