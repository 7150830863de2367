"""Rows from HTML by a declarative spec: items by tag and class, fields by tag, class or attribute.

The spec is interpreted; no code is generated or run.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Element:
    def __init__(self, tag: str, attrs: dict) -> None:
        self.tag, self.attrs, self.parts = tag, attrs, []

    def text(self) -> str:
        out = []
        for p in self.parts:
            out.append(p if isinstance(p, str) else p.text() if p.tag not in ("script", "style") else "")
        return " ".join(" ".join(out).split())

    def walk(self) -> Iterator[_Element]:
        for p in self.parts:
            if isinstance(p, _Element):
                yield p
                yield from p.walk()

    def matches(self, selector: str) -> bool:
        """tag, .class, tag.class or tag#id."""
        tag, _, cls = selector.partition(".")
        tag, _, ident = tag.partition("#")
        return (not tag or tag == self.tag) and (not cls or cls in (self.attrs.get("class") or "").split()) and (not ident or ident == self.attrs.get("id"))

    def find(self, selector: str) -> _Element | None:
        return next(self.all(selector), None)

    def all(self, selector: str) -> Iterator[_Element]:
        """Elements that match the last part below matches of the parts before it."""
        head, _, rest = selector.strip().partition(" ")
        for e in self.walk():
            if e.matches(head):
                yield from e.all(rest) if rest else (e,)


class _Parser(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.root = _Element("", {})
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        e = _Element(tag, dict(attrs))
        self.stack[-1].parts.append(e)
        if tag not in _VOID:
            self.stack.append(e)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        if data.strip():
            self.stack[-1].parts.append(data)


def parse(html: str) -> _Element:
    p = _Parser()
    p.feed(html)
    p.close()
    return p.root


def extract(html: str, base: str, spec: dict) -> list[dict[str, str | None]]:
    """One dict per item: ``fields`` maps names to {selector, attr}; href and src come absolute."""
    out = []
    for item in parse(html or "").all(spec["item_selector"]):
        row: dict[str, str | None] = {}
        for name, f in spec["fields"].items():
            e = item if not f.get("selector") else item.find(f["selector"])
            if e is None:
                row[name] = None
            elif f.get("attr"):
                v = e.attrs.get(f["attr"])
                row[name] = urljoin(base, v) if v and f["attr"] in ("href", "src") else v
            else:
                row[name] = e.text() or None
        if any(row.values()):
            out.append(row)
        if spec.get("first_only") and out:
            break
    return out


def next_page(html: str, base: str, selector: str) -> str | None:
    e = parse(html or "").find(selector)
    return urljoin(base, e.attrs["href"]) if e is not None and e.attrs.get("href") else None


def scrape(pages: DataFrame, spec: dict, url: str = "url", html: str = "html") -> DataFrame:
    """(page_url, position, fields...) of all pages."""
    names = list(spec["fields"])

    def go(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = [(u, i, *r.values()) for u, h in zip(pdf[url], pdf[html]) for i, r in enumerate(extract(h, u or "", spec))]
            yield pd.DataFrame(rows, columns=["page_url", "position", *names])

    return pages.select(url, html).mapInPandas(go, "page_url string, position int, " + ", ".join(f"{n} string" for n in names))


# Where items of a page usually are, the words of forums, and the least sizes and scores.
ITEMS = (
    "li.topic-post", "li.discussion-item", "article.post", "*topic-post", "*forum-post", "*thread-", "*discussion-",
    "article", "*post", "*comment", "*card",
)
FIRST_POSTS = ("article.first-post", "article.post", "article", "*first-post")
MAINS = ("main", "#content", ".content", "article", "body")
FORUM_WORDS = ("post", "thread", "topic", "discussion", "question", "article", "message", "reply", "forum", "comment")
ITEM_CHARS, FIRST_CHARS, MAIN_CHARS, LEAST_SCORE, MOST_ITEMS = 25, 80, 350, 12.0, 200


def _select(root: _Element, selector: str) -> list[_Element]:
    """``*part`` selects elements with part in their class, anything else is a plain selector."""
    if selector.startswith("*"):
        return [e for e in root.walk() if selector[1:] in (e.attrs.get("class") or "")]
    return list(root.all(selector))


def outermost(elements: list[_Element]) -> list[_Element]:
    """Elements that lie in no other of the list; none if fewer than two are left."""
    inner = {id(x) for e in elements for x in e.walk()}
    out = [e for e in elements if id(e) not in inner]
    return out if len(out) >= 2 else []


def forum_bonus(elements: list[_Element], first: int = 4) -> float:
    """Points for the first elements that a forum's words name, at most 15."""
    def named(e: _Element) -> bool:
        marks = " ".join([e.tag, *(str(v) for x in (e, *e.walk()) for v in x.attrs.values()), e.text()[:2000]]).lower()
        return any(w in marks for w in FORUM_WORDS)

    return min(15.0, 5.0 * sum(map(named, elements[:first])))


def group_score(elements: list[_Element]) -> float:
    """How much elements look like a page's repeated items: their number and length, their links, a forum's words."""
    n = len(elements)
    length = sum(len(e.text()) for e in elements) / n if n else 0.0
    if n < 2 or length < 20:
        return 0.0
    linked = sum(e.find("a") is not None for e in elements) / n
    return n * math.log1p(length) + 20.0 * linked + forum_bonus(elements)


def preview(e: _Element, base: str) -> dict[str, str | None]:
    """Title, body, link, date and section of an item."""
    first = lambda *ss: next((x for s in ss if (x := next(iter(_select(e, s)), None)) is not None), None)
    title, body, link, date, section = first("h1", "h2", "h3", ".title", ".post-title"), first(".body", ".post-body", ".preview", ".content", "p"), first("a"), first("time"), first(".tag", ".section-label")
    return {
        "title": title.text() or None if title else None, "body": (body or e).text() or None, "link": urljoin(base, link.attrs["href"]) if link and link.attrs.get("href") else None,
        "date": date.attrs.get("datetime") or date.text() or None if date else None, "section": section.attrs.get("data-section") or section.text() or None if section else None,
    }


def probe(html: str, base: str = "") -> dict:
    """How a page can be read: as repeated items, as a first post, as one main text, or not at all (mode none).

    Gives the mode, the selector, the number of items, score and confidence, and previews of the first items.
    """
    root = parse(html or "")
    best, selector, items = 0.0, None, []
    for s in ITEMS:
        found = _select(root, s)
        if not 2 <= len(found) <= MOST_ITEMS:
            continue
        good = outermost([e for e in found if len(e.text()) >= ITEM_CHARS])
        score = group_score(good)
        if score > best:
            best, selector, items = score, s, good
    result = lambda mode, s, es, score, full: {"mode": mode, "item_selector": s, "items": len(es), "score": round(score, 4), "confidence": round(min(1.0, score / full), 4), "previews": [preview(e, base) for e in es[:8]]}
    if best >= LEAST_SCORE:
        return result("repeated_items", selector, items, best, 45.0)
    for s in FIRST_POSTS:
        found = _select(root, s)
        if found and len(found[0].text()) >= FIRST_CHARS:
            return result("forum_first_post", s, found[:1], 18.0 + math.log1p(len(found[0].text())) + forum_bonus(found[:1]), 45.0)
    for s in MAINS:
        e = next(iter(_select(root, s)), None)
        if e is not None and len(e.text()) >= MAIN_CHARS:
            return result("main_text", s, [e], 10.0 + math.log1p(len(e.text())), 40.0)
    return {"mode": "none", "item_selector": None, "items": 0, "score": 0.0, "confidence": 0.0, "previews": []}


PROBED = "url string, mode string, item_selector string, items int, score double, confidence double, previews string"


def probed(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``probe`` of every page of a table, previews as JSON."""
    def go(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for u, h in zip(pdf[url], pdf[html]):
                p = probe(h, u or "")
                rows.append((u, p["mode"], p["item_selector"], p["items"], p["score"], p["confidence"], json.dumps(p["previews"], ensure_ascii=False)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PROBED.split(", ")])

    return pages.select(url, html).mapInPandas(go, PROBED)


def planned_spec(url: str, found: dict) -> dict:
    """A scraper spec from a probe: items, fields and how sure it is; pages that can't be read give a spec without items."""
    if found["mode"] == "none":
        return {"entry_url": url, "item_selector": None, "fields": {}, "confidence": 0.0}
    whole = found["mode"] == "main_text"
    fields = {"title": {"selector": "h1"}, "body": {}} if whole else {"title": {"selector": "h2"}, "body": {"selector": "p"}, "link": {"selector": "a", "attr": "href"}, "date": {"selector": "time", "attr": "datetime"}}
    return {"entry_url": url, "item_selector": found["item_selector"], "fields": fields, "confidence": found["confidence"], "mode": found["mode"], **({"first_only": True} if found["mode"] == "forum_first_post" else {})}


def readable_spec(spec: dict) -> bool:
    """Whether a spec can be interpreted: items and at least one field."""
    return bool(spec.get("item_selector")) and bool(spec.get("fields"))


def spec_mode(spec: dict, notes: list[str] = ()) -> str:
    """The mode that a spec, or a note of its planner, states."""
    noted = next((n.split("mode=", 1)[1].split()[0].rstrip(",;") for n in (*spec.get("planner_notes", ()), *notes) if "mode=" in n), None)
    return spec.get("mode") or spec.get("extraction_mode") or noted or "repeated_items"


def crawl(pages: DataFrame, spec: dict, most_pages: int = 10, most_rows: int | None = None, hosts: tuple[str, ...] = (), url: str = "url", html: str = "html") -> DataFrame:
    """Rows of a listing that goes on over pages: from the entry page along next links, over staged pages.

    Pages outside the allowed hosts end the crawl, as do pages that aren't staged or were seen; rows stop at the cap.
    """
    from pyspark.sql import functions as F

    at, seen, order = spec["entry_url"], [], []
    while at and at not in seen and len(seen) < most_pages:
        host = (urlsplit(at).hostname or "").lower()
        if hosts and not any(host == h or host.endswith("." + h) for h in hosts):
            break
        page = pages.where(F.col(url) == at).select(html).first()
        if page is None:
            break
        seen.append(at)
        order.append((at, len(seen)))
        at = next_page(page[0] or "", at, spec["next_selector"]) if spec.get("next_selector") else None
    spark = pages.sparkSession
    turns = spark.createDataFrame(order, f"{url} string, page int")
    rows = scrape(pages.join(F.broadcast(turns), url, "left_semi"), spec, url, html).join(F.broadcast(turns.withColumnRenamed(url, "page_url")), "page_url")
    rows = rows.orderBy("page", "position")
    return rows.limit(most_rows) if most_rows is not None else rows


def enriched(rows: DataFrame, source: str, section: str | None = None, mode: str = "repeated_items") -> DataFrame:
    """Scraped rows as records: source_url, thread_id, created_at and forum_section in metadata, with how they were read."""
    from pyspark.sql import functions as F

    from textloom.functions import urls

    have = set(rows.columns)
    link = F.coalesce(F.col("link"), F.col("page_url")) if "link" in have else F.col("page_url")
    col = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    meta = F.struct(urls.thread_id(link).alias("thread_id"), col("date").alias("created_at"), F.coalesce(col("section"), F.lit(section)).alias("forum_section"), F.lit(mode).alias("extraction_mode"))
    return rows.withColumns({"source": F.lit(source), "source_url": link, "metadata": F.to_json(meta)})


def spec_json(spec: dict) -> str:
    return json.dumps(spec, sort_keys=True)
