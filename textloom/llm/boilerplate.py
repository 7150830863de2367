"""The main body of web pages: layout-aware rendering and furniture lines.

A page in HTML is parsed by a tree builder with implied end tags; hidden elements, scripts and styles are dropped, and
all visible text comes out in lines that keep block spacing, list marks and aligned table cells (``render``). Text
that comes already rendered enters as its lines.

The rendered lines form blocks. What a site puts around its posts repeats from page to page: a line's key is its words
without case, accents, list marks, numbers and host names, and the share of a site's pages that carry a key tells
furniture from post. Lines of several cells (menus, counters, breadcrumbs) also count by their cells, lines about author
and time by their ends. Furniture lines that head runs of short lines on most pages (links to other threads) take
those runs with them. Forms, quotations and a page's own title are never furniture. Where a page has markup, lines of its
framing elements (navigation, asides, footers) are furniture by themselves, and lines count as rendered.

Null and empty texts have no lines; very long pages are read whole; pages may repeat; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.fieldcodes import form_fields
from textloom.plans.staging import spread, stage

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("script style noscript template head title svg canvas iframe object select option datalist dialog".split())
BLOCK = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre article section figure".split())
FRAMES = frozenset("nav aside footer".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search".split())
_FRAME_NAME = re.compile(r"(?<![a-z])(?:cookie|consent|breadcrumb|sidebar|navbar|menu|footer|share|related)s?(?![a-z])", re.I)
#: Open elements of a page.
DEEPEST = 150
#: Start tags that end an open element of the given kinds, up to the nearest of the barriers.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_HIDE_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_TAG = re.compile(r"<(?:!doctype|html|body|div|p|ul|ol|table|article|section|span|br|h[1-6])\b[^>]*>", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict | None = None) -> None:
        self.tag, self.attrs, self.children = tag, attrs or {}, []

    def hidden(self) -> bool:
        a = self.attrs
        return self.tag in HIDDEN or "hidden" in a or a.get("aria-hidden") == "true" or bool(_HIDE_STYLE.search(a.get("style") or "")) or (self.tag == "input" and a.get("type") == "hidden")


    def frames(self) -> bool:
        """Whether the element holds what a site puts around its content."""
        names = f"{self.attrs.get('class') or ''} {self.attrs.get('id') or ''}"
        return self.tag in FRAMES or (self.attrs.get("role") or "") in FRAME_ROLES or bool(_FRAME_NAME.search(names))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in IMPLIED_END:
            ends, walls = IMPLIED_END[tag]
            self._close(ends, walls)
        elif tag in BLOCK:
            self._close({"p"}, BLOCK - {"p"})
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        # deeper elements join the deepest that is kept open
        if tag not in VOID and len(self.open) < DEEPEST:
            self.open.append(node)

    def _close(self, ends, walls):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in walls:
                return
            if self.open[i].tag in ends:
                del self.open[i:]
                if not ends - {"p", "li", "dt", "dd", "option"}:
                    return
                return self._close(ends, walls)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    """The element tree of a page."""
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


class Around(str):
    """A line of an element that frames the content."""


class _Renderer:
    def __init__(self, around: bool = False) -> None:
        self.lines: list[str] = []
        self.now = ""
        self.around = around

    def flush(self, gap: bool = False) -> None:
        if self.now.strip():
            self.lines.append(Around(self.now.rstrip()) if self.around else self.now.rstrip())
        self.now = ""
        if gap and self.lines and self.lines[-1]:
            self.lines.append("")

    def node(self, n: Node, pre: bool = False, depth: int = 0) -> None:
        item = 0
        for c in n.children:
            if isinstance(c, str):
                if pre:
                    parts = c.split("\n")
                    for k, p in enumerate(parts):
                        self.now += p
                        if k < len(parts) - 1:
                            self.flush()
                else:
                    words = re.sub(r"\s+", " ", c)
                    self.now += words.lstrip() if not self.now or self.now.endswith((" ", "\t")) else words
                continue
            if c.hidden():
                continue
            if c.tag == "br":
                self.flush()
            elif c.tag == "table":
                self.flush(True)
                self.lines += map(Around, table(c)) if self.around else table(c)
                self.flush(True)
            elif c.frames() and not self.around:
                self.flush(True)
                self.around = True
                self.node(c, pre, depth)
                self.flush(True)
                self.around = False
            elif c.tag in BLOCK:
                self.flush(c.tag in SPACED)
                if c.tag == "li":
                    item += 1
                    self.now = "  " * max(depth - 1, 0) + (f"{item}. " if n.tag == "ol" else "* ")
                elif c.tag == "blockquote":
                    inner = _Renderer()
                    inner.node(c, pre, depth)
                    inner.flush()
                    self.lines += [f"> {x}" if x else "" for x in inner.lines]
                    self.flush(True)
                    continue
                self.node(c, pre or c.tag == "pre", depth + (c.tag in ("ul", "ol")))
                self.flush(c.tag in SPACED)
            else:
                self.node(c, pre, depth)


def table(t: Node) -> list[str]:
    """A table's rows as lines with cells aligned to columns."""
    rows: list[list[str]] = []

    def walk(n: Node) -> None:
        for c in n.children:
            if not isinstance(c, Node) or c.hidden():
                continue
            if c.tag == "tr":
                cells = []
                for d in c.children:
                    if isinstance(d, Node) and d.tag in ("td", "th") and not d.hidden():
                        r = _Renderer()
                        r.node(d)
                        r.flush()
                        cells.append(" ".join(x.strip() for x in r.lines if x.strip()))
                        span = d.attrs.get("colspan") or "1"
                        cells += [""] * (min(int(span), 50) - 1 if span.isdigit() else 0)
                rows.append(cells)
            elif c.tag != "table":
                walk(c)

    walk(t)
    width: list[int] = []
    for r in rows:
        for i, x in enumerate(r):
            if i == len(width):
                width.append(0)
            width[i] = max(width[i], len(x))
    return ["  ".join(x.ljust(width[i]) for i, x in enumerate(r)).rstrip() for r in rows if any(r)]


def rendered(html: str) -> list[str]:
    """The lines of all visible text of a page, those of framing elements as ``Around``."""
    r = _Renderer()
    r.node(parse(html))
    r.flush()
    while r.lines and not r.lines[-1]:
        r.lines.pop()
    return r.lines


def render(html: str) -> str:
    """All visible text of a page, with block spacing, list marks, quotations and aligned tables."""
    return "\n".join(rendered(html))


def lines_of(text: str) -> list[str]:
    """The rendered lines of a page; text without tags is already rendered."""
    if "<" in text and len(_TAG.findall(text)) >= 2:
        return rendered(text)
    if text.lstrip().startswith("&lt;") and len(_TAG.findall(unescape(text))) >= 2:
        return rendered(unescape(text))
    return text.split("\n")


#: Share of a site's pages that makes a line furniture, and of all pages for lines of any site; least pages with it.
OF_SITE, OF_ALL, LEAST = 0.025, 0.0008, 4
#: Words of the longest line that may be furniture, and of the longest title.
LONGEST, TITLE = 24, 14
#: Mean run of short lines that makes a furniture line the head of links.
HEAD = 1.5
#: Keys (about 60 bytes each) that may be sent to all workers; beyond, pages meet the keys of their lines in a shuffle.
SENT = 100_000
_HOST = re.compile(r"(?<![\w@])[a-z0-9][\w\-]*(?:\.[\w\-]+)*\.[a-z]{2,}(?![\w@])")
_WORD = re.compile(r"[^\W\d_]+|\d+")
_CELL = re.compile(r"\s*[|·»›>*•]\s*|\s+/\s+|\s{2,}|\s+-\s+")
_ENDS = re.compile(r"[.!?…:][\"'»”)]*\s*$")
_MARK = re.compile(r"^\s*(?:[*\-•›»–—]|\d+[.)])\s+")


def _fold(s: str) -> str:
    if s.isascii():
        return s.lower()
    s = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", s).lower())
    return "".join(c for c in s if unicodedata.category(c) not in ("Mn", "Cf"))


def _hash(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key) - (1 << 63)


class Line:
    """What the marking of a line needs."""

    __slots__ = ("no", "blank", "long", "short", "quote", "keys", "cells", "text", "host", "around")

    def __init__(self, no: int, raw: str, own: frozenset) -> None:
        self.no, self.text, self.around = no, raw, isinstance(raw, Around)
        self.keys: list[int] = []
        self.cells: list[int] = []
        self.host = False
        flat = _fold(raw).strip()
        self.blank = not flat
        self.quote = flat.startswith(">")
        words = _WORD.findall(flat)
        self.long = len(words) > LONGEST or len(flat) > 200
        self.short = bool(words) and len(words) <= TITLE and not _ENDS.search(flat) and len(flat) < 100
        if self.blank or self.long or not words:
            return
        self.keys.append(_hash(_key(flat, own)))
        self.host = " h " in f" {_key(flat, own)} "
        if any(w[0].isdigit() for w in words) and 3 <= len(words) <= 14:
            key = _key(flat, own).split()
            self.keys.append(_hash("ends " + " ".join(key[:2]) + " … " + key[-1]))
        cells = [c for c in _CELL.split(flat) if c and _WORD.search(c)]
        if len(cells) >= 2:
            self.cells = [_hash(_key(c, own)) for c in cells]


def _key(flat: str, own: frozenset) -> str:
    ws: list[str] = []
    for w in _WORD.findall(_HOST.sub(" hhost ", flat)):
        w = "0" if w[0].isdigit() else "h" if w == "hhost" or w in own else w
        if not (ws and w == ws[-1] and w in "0h"):
            ws.append(w)
    return " ".join(ws)


def page(text: str, site: str) -> list[Line] | None:
    """The lines of a page; None for a form."""
    rows = lines_of(text)
    if len(rows) == 1 and len(text) > 200:
        return [Line(1, text, frozenset())]
    if form_fields(text) is not None:
        return None
    parts = set(re.findall(r"[^\W\d_]{3,}", site)) if "." in site else set()
    return [Line(i + 1, r, frozenset(parts)) for i, r in enumerate(rows)]


def runs_after(lines: list[Line], i: int) -> int:
    """Short lines that follow line i without a gap."""
    n = 0
    while i + 1 + n < len(lines) and lines[i + 1 + n].short and not lines[i + 1 + n].quote:
        n += 1
    return n


def _site(column: str = "source"):
    return F.coalesce(F.lower(F.trim(F.col(column))), F.lit(""))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n: Counter = Counter()
        run: Counter = Counter()
        for site, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lines = page(text, site) if text else None
            if not lines:
                continue
            n[site, 0] += 1
            seen = set()
            for i, line in enumerate(lines):
                for k in {*line.keys, *line.cells}:
                    if k not in seen:
                        seen.add(k)
                        n[site, k] += 1
                        run[site, k] += min(runs_after(lines, i), 4) if k in line.keys else 0
        keys = list(n)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array([n[k] for k in keys], pa.int64()), pa.array([run[k] for k in keys], pa.int64())], names=["site", "key", "n", "run"])


def furniture(df: DataFrame) -> DataFrame:
    """(site, key, mean_run) of each site's furniture; site null: furniture on any site."""
    raw = spread(df.select(_site().alias("site"), "text")).mapInArrow(_counts, "site string, key bigint, n bigint, run bigint")
    counts = stage(raw.groupBy("site", "key").agg(F.sum("n").alias("n"), F.sum("run").alias("run")), "line_counts")
    pages = counts.where("key = 0").select("site", F.col("n").alias("pages"))
    of_site = counts.where("key <> 0").join(pages, "site").where((F.col("n") >= LEAST) & (F.col("n") >= OF_SITE * F.col("pages"))).select("site", "key", (F.col("run") / F.col("n")).alias("mean_run"))
    total = pages.agg(F.sum("pages")).first()[0] or 0
    everywhere = counts.where("key <> 0").groupBy("key").agg(F.sum("n").alias("n"), F.sum("run").alias("run"))
    # lines of at least a share of OF_ALL of all pages number at most (lines of a page / OF_ALL); lines that are furniture
    # on a site count on every other where they are that frequent
    of_all = everywhere.where(F.col("n") >= max(LEAST, OF_ALL * total)).join(of_site.select("key").distinct(), "key", "left_semi").select(F.lit(None).cast("string").alias("site"), "key", (F.col("run") / F.col("n")).alias("mean_run"))
    return stage(of_site.unionByName(of_all), "furniture")


def mark(lines: list[Line], known: dict[int, float], title: str | None, own: frozenset = frozenset()) -> list[int]:
    """Numbers of the lines that aren't the post."""
    want = _hash(_key(_fold(title), own)) if title and title.strip() else None
    flagged = [False] * len(lines)
    head = [False] * len(lines)
    titled = False
    for i, line in enumerate(lines):
        if line.around and not line.blank:
            flagged[i] = True
            continue
        if line.blank or line.long or line.quote:
            continue
        if want is not None and not titled and line.keys and line.keys[0] == want:
            titled = True
            continue
        hit = [k for k in line.keys if k in known]
        if hit:
            flagged[i] = True
            head[i] = known[hit[0]] >= HEAD
        elif line.cells and (sum(k in known for k in line.cells) == len(line.cells) or line.host and len(line.cells) <= 5):
            flagged[i] = True
    i = 0
    while i < len(lines):
        if head[i] and not lines[i].cells:
            j = i + 1
            while j < len(lines) and lines[j].short and not lines[j].quote and not flagged[j]:
                flagged[j] = True
                j += 1
            i = j
        else:
            i += 1
    if all(f or x.blank for f, x in zip(flagged, lines)) and not any(x.long for x in lines):
        return []
    return [x.no for f, x in zip(flagged, lines) if f]


Known = Callable[[str], dict[int, float]]


def _shared(model: dict) -> Known:
    def known(site: str) -> dict[int, float]:
        return model[site] if site in model else model[None]

    return known


def _own(site: str) -> frozenset:
    return frozenset(re.findall(r"[^\W\d_]{3,}", site)) if "." in site else frozenset()


def _marks(batch: pa.RecordBatch, known: Known | None) -> Iterator[tuple[int, list[int], list[Line] | None, str | None]]:
    """Marked lines of each page; with no ``known``, columns 4 and 5 name the page's own furniture keys and mean runs."""
    for row, site, title, text, *keys in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns))):
        lines = page(text, site) if text else None
        its = known(site) if known else dict(zip(keys[0] or [], keys[1] or []))
        yield row, mark(lines, its, title, _own(site)) if lines else [], lines, text


def _found(model: dict | None):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if model is None else _shared(model)
        for batch in batches:
            rows = [(r, n) for r, nos, _, _ in _marks(batch, known) for n in nos]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32())], names=["row_id", "line_no"])

    return go


def _kept(model: dict | None):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if model is None else _shared(model)
        for batch in batches:
            ids, texts, gone = [], [], []
            for row, nos, lines, text in _marks(batch, known):
                drop = set(nos)
                ids.append(row)
                gone.append(len(nos))
                texts.append(text if not nos else re.sub(r"\n{3,}", "\n\n", "\n".join(x.text for x in lines if x.no not in drop)).strip("\n"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(gone, pa.int32())], names=["row_id", "text", "removed"])

    return go


def _page_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], []]
        for row, site, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            for key in {k for line in (page(text, site) if text else None) or [] for k in (*line.keys, *line.cells)}:
                for col, v in zip(out, (row, site, key)):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["row_id", "site", "key"])


def _apply(df: DataFrame, work, schema: str) -> DataFrame:
    model = furniture(df)
    pages = spread(df.select(F.col("row_id").cast("bigint").alias("row_id"), _site().alias("site"), "title", "text"))
    if model.count() <= SENT:
        return pages.mapInArrow(work(_model(model)), schema)
    # each page meets the keys of its own lines, so no worker holds more than a page's; a site's own run counts before the common one
    keys = pages.select("row_id", "site", "text").mapInArrow(_page_keys, "row_id bigint, site string, key bigint")
    own = model.where("site is not null").withColumnRenamed("mean_run", "of_site")
    common = model.where("site is null").select("key", F.col("mean_run").alias("of_all"))
    met = keys.join(own, ["site", "key"], "left").join(common, "key", "left").select("row_id", "site", "key", F.coalesce("of_site", "of_all").alias("run")).where("run is not null")
    held = met.groupBy("row_id", "site").agg(F.collect_list(F.struct("key", "run")).alias("held")).select("row_id", "site", F.col("held.key").alias("keys"), F.col("held.run").alias("runs"))
    return pages.join(stage(held, "page_keys"), ["row_id", "site"], "left").select("row_id", "site", "title", "text", "keys", "runs").mapInArrow(work(None), schema)


def _model(model: DataFrame) -> dict:
    by: dict = {None: {}}
    for r in model.collect():
        by.setdefault(r["site"], {})[r["key"]] = r["mean_run"]
    return {site: by[None] | keys for site, keys in by.items()}


def found(df: DataFrame) -> DataFrame:
    """(row_id, line_no) of each non-blank line that isn't the post; lines count from 1."""
    return _apply(df, _found, "row_id bigint, line_no int")


def main_text(df: DataFrame) -> DataFrame:
    """(row_id, text, removed): each page's main body, rendered, and the number of lines removed."""
    return _apply(df, _kept, "row_id bigint, text string, removed int")
