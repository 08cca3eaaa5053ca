"""The per-page helper of the extraction stage: one HTML text to field values.

A scan over the tags with a short stack of the open elements that matter, so
implicit closes, nesting and truncated pages behave as in a browser-like tree
without building one. Spark partitions the pages; this sees one at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape
from urllib.parse import urldefrag, urljoin, urlsplit

# A comment, a start tag with its attributes, an end tag, or other markup. What the
# end of the page cuts off is matched to the end; a lone '<' is text.
_MARKUP = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)
        |(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*(?:"[^"]*"|'[^']*')?)*+)(?P<whole>>|\Z)
        |/(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)
        |[!?/][^>]*(?:>|\Z))""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/=>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^>\s]*)))?""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in ("script", "style")}
# A rooted path that resolves to itself on the page's origin.
_ROOTED = re.compile(r"/(?![/.])(?:[^?#;\s\\/]|/(?!\.))*\Z")

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
LIST_TAGS = ("ul", "ol")
CELLS = ("td", "th")
TRACKED = {*HEADINGS, *LIST_TAGS, *CELLS, "li", "table", "tr", "title"}
SILENT = {"script", "style", "template"}
HEAD_ONLY = {"html", "head", "title", "meta", "link", "base", "script", "style", "noscript", "template"}
# Starting one of these ends an open heading.
ENDS_HEADING = {*HEADINGS, "p", "li", "table", "form"}
# An end tag looks for its element no further than these.
WALLS = {"table", "tr", "td", "th"}
_QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
# The start of an unquoted attribute value.
_VALUE = re.compile(r"=[^\"']")


class _Span:
    """An element's texts, as a slice of all texts of the page, and its place among the opened elements."""

    __slots__ = ("tag", "first", "last", "opened", "closed")

    def __init__(self, tag: str, first: int, opened: int) -> None:
        self.tag, self.first, self.last, self.opened, self.closed = tag, first, None, opened, None


class PageEvents:
    def __init__(self) -> None:
        self.texts: list[str] = []
        self.open: list[_Span] = []
        self.depths: dict[str, list[int]] = {}
        self.opened = 0
        self.silent = 0
        self.in_title = 0
        self.body_from: int | None = None
        self.title: _Span | None = None
        self.meta: dict[str, str] = {}
        self.hrefs: list[str] = []
        self.sources: list[tuple[str, str]] = []
        self.headings: list[_Span] = []
        self.lists: list[_Span] = []
        self.tables: list[_Span] = []
        self.items: list[_Span] = []
        self.rows: list[_Span] = []
        self.cells: list[_Span] = []

    def read(self, html: str) -> None:
        at, size, search = 0, len(html), _MARKUP.search
        while at < size:
            found = search(html, at)
            text_end = found.start() if found else size
            if text_end > at and not self.silent:
                self._text(html[at:text_end])
            if not found:
                break
            at = found.end()
            if tag := found["start"]:
                if not found["whole"]:
                    break
                tag, attrs = tag.lower(), found["attrs"]
                closed = tag not in _RAW_END and _self_closed(attrs)
                self._start(tag, attrs)
                if tag in _RAW_END:
                    hidden = _RAW_END[tag].search(html, at)
                    at = hidden.start() if hidden else size
                if closed:
                    self._end(tag)
            elif tag := found["end"]:
                self._end(tag.lower())
        self._close_to(0)

    def _text(self, raw: str) -> None:
        text = (unescape(raw) if "&" in raw else raw).strip()
        if text:
            if self.body_from is None and not self.in_title:
                self.body_from = len(self.texts)
            self.texts.append(text)

    def _close_to(self, depth: int) -> None:
        for span in self.open[depth:]:
            span.last, span.closed = len(self.texts), self.opened
            self.in_title -= span.tag == "title"
            self.depths[span.tag].pop()
        del self.open[depth:]

    def _innermost(self, tags) -> int:
        found = -1
        for tag in tags:
            if (held := self.depths.get(tag)) and held[-1] > found:
                found = held[-1]
        return found

    def _find(self, tags, walls=()) -> int:
        """Depth of the innermost open element of ``tags`` with no wall inside it, else -1."""
        depth = self._innermost(tags)
        return depth if depth >= self._innermost(walls) else -1

    def _close_implied(self, tag: str) -> None:
        if tag in ENDS_HEADING and self.open and self.open[-1].tag in HEADINGS:
            self._close_to(len(self.open) - 1)
        if tag == "li":
            depth = self._find(("li",), (*LIST_TAGS, *WALLS))
        elif tag in CELLS:
            depth = self._find(CELLS, ("tr", "table"))
        elif tag == "tr":
            depth = self._find(("tr",), ("table",))
        else:
            depth = -1
        if depth >= 0:
            self._close_to(depth)

    def _start(self, tag: str, attrs: str) -> None:
        if tag in SILENT:
            self.silent += 1
        if self.body_from is None and tag not in HEAD_ONLY:
            self.body_from = len(self.texts)
        if tag == "a":
            if href := _attributes(attrs).get("href"):
                self.hrefs.append(href.strip())
        elif tag == "img":
            values = _attributes(attrs)
            if src := values.get("src"):
                self.sources.append((src.strip(), values.get("alt", "").strip()))
        elif tag == "meta":
            values = _attributes(attrs)
            if values.get("name") in ("description", "keywords"):
                self.meta.setdefault(values["name"], values.get("content", "").strip())
        if tag in ENDS_HEADING or tag in TRACKED:
            self._close_implied(tag)
        if tag in TRACKED:
            self._open(tag)

    def _open(self, tag: str) -> None:
        span = _Span(tag, len(self.texts), self.opened)
        self.opened += 1
        if tag == "title":
            self.title = self.title or span
            self.in_title += 1
        elif tag in ("h1", "h2", "h3"):
            self.headings.append(span)
        elif tag in LIST_TAGS:
            self.lists.append(span)
        elif tag == "table":
            self.tables.append(span)
        elif tag == "li":
            self.items.append(span)
        elif tag == "tr":
            self.rows.append(span)
        elif tag in CELLS:
            self.cells.append(span)
        self.depths.setdefault(tag, []).append(len(self.open))
        self.open.append(span)

    def _end(self, tag: str) -> None:
        if tag in SILENT and self.silent:
            self.silent -= 1
        if tag in TRACKED:
            depth = self._find((tag,), () if tag in WALLS else WALLS)
            if depth >= 0:
                self._close_to(depth)

    def text_of(self, span: _Span) -> str:
        return " ".join(self.texts[span.first:span.last])


def _inside(parts: list[_Span], outers: list[_Span]) -> list[slice]:
    """Where the ``parts``, in order of opening, stand that opened while each of ``outers`` was open."""
    opened = [span.opened for span in parts]
    return [slice(bisect_left(opened, outer.opened), bisect_left(opened, outer.closed)) for outer in outers]


def _self_closed(attrs: str) -> bool:
    """Whether a start tag ends in a slash of its own, not in one of an unquoted value."""
    if not attrs.endswith("/"):
        return False
    *before, last = _QUOTED.sub('""', attrs).rsplit(None, 1)
    # A value of more than the slash takes it, whether it stands right after its sign or after white space.
    apart = bool(before) and before[0].endswith("=") and len(last) > 1 and last[0] not in "\"'"
    return not (apart or _VALUE.search(last[:-1]))


def _attributes(text: str) -> dict[str, str]:
    """Attributes by lower-cased name, the first of a name winning."""
    values: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        values.setdefault(name.lower(), unescape(double or single or bare))
    return values


def resolve(base: str, reference: str) -> str | None:
    """Absolute http(s) URL with a host, else None; a malformed one is None too."""
    try:
        url = urljoin(base, reference)
        parts = urlsplit(url)
        good = parts.scheme in ("http", "https") and parts.hostname is not None
    except ValueError:
        return None
    return url if good else None


def _resolver(base: str):
    """:func:`resolve` for one page, short for plain rooted paths."""
    root = resolve(base, "/")
    origin = root[:-1] if root else None

    def run(reference: str) -> str | None:
        if origin and _ROOTED.match(reference):
            return origin + reference
        return resolve(base, reference)

    return run


def _links(page: PageEvents, url: str) -> list[str]:
    found: dict[str, None] = {}
    to_absolute = _resolver(url)
    for href in page.hrefs:
        absolute = to_absolute(href)
        if absolute is not None:
            found.setdefault(urldefrag(absolute).url if "#" in absolute else absolute)
    return list(found)


def _images(page: PageEvents, url: str) -> list[dict]:
    to_absolute = _resolver(url)
    resolved = ((to_absolute(src), alt) for src, alt in page.sources)
    return [{"src": src, "alt": alt} for src, alt in resolved if src is not None]


def _covered(parts: list[_Span], outers: list[_Span]) -> list[_Span]:
    """The ``parts`` that opened while any of ``outers`` was open, all in order of opening."""
    outermost, end = [], 0
    for outer in outers:
        if outer.opened >= end:
            outermost.append(outer)
            end = outer.closed
    return [span for place in _inside(parts, outermost) for span in parts[place]]


def _range(part: slice) -> dict:
    """A range as Spark's ``slice`` takes it, from 1."""
    return {"start": part.start + 1, "length": part.stop - part.start}


def _list_spans(page: PageEvents, _url: str) -> dict:
    """Every item's text once, and of each list the range of its items: nested lists share the texts."""
    items = _covered(page.items, page.lists)
    places = zip(page.lists, _inside(items, page.lists))
    lists = [{"type": span.tag, **_range(place)} for span, place in places if place.start < place.stop]
    return {"texts": [page.text_of(item) for item in items], "lists": lists}


def _table_spans(page: PageEvents, _url: str) -> dict:
    """Every cell's text once, of each row the range of its cells, of each table that of its rows with cells."""
    rows = _covered(page.rows, page.tables)
    cells = _covered(page.cells, rows)
    filled = [(row, place) for row, place in zip(rows, _inside(cells, rows)) if place.start < place.stop]
    tables = _inside([row for row, _ in filled], page.tables)
    return {
        "texts": [page.text_of(cell) for cell in cells], "rows": [_range(place) for _, place in filled],
        "tables": [_range(place) for place in tables if place.start < place.stop],
    }


def _taken(values: list, place: dict) -> list:
    return values[place["start"] - 1:place["start"] - 1 + place["length"]]


def _lists(page: PageEvents, url: str) -> list[dict]:
    spans = _list_spans(page, url)
    return [{"type": found["type"], "items": _taken(spans["texts"], found)} for found in spans["lists"]]


def _tables(page: PageEvents, url: str) -> list[list[list[str]]]:
    spans = _table_spans(page, url)
    rows = [_taken(spans["texts"], row) for row in spans["rows"]]
    return [_taken(rows, table) for table in spans["tables"]]


def _headings(page: PageEvents, _url: str) -> list[dict]:
    return [{"level": span.tag, "text": page.text_of(span)} for span in page.headings]


def _title(page: PageEvents, _url: str = "") -> str:
    return page.text_of(page.title) if page.title else ""


def _metadata(page: PageEvents, _url: str) -> dict:
    return {
        "title": _title(page),
        "description": page.meta.get("description", ""),
        "keywords": page.meta.get("keywords", ""),
    }


def _text(page: PageEvents, _url: str) -> str:
    return " ".join(page.texts[page.body_from or 0:])


EXTRACTORS = {
    "title": (_title, str),
    "text": (_text, str),
    "links": (_links, list),
    "tables": (_tables, list),
    "lists": (_lists, list),
    "images": (_images, list),
    "headings": (_headings, list),
    "metadata": (_metadata, lambda: {"title": "", "description": "", "keywords": ""}),
    # Lists and tables as they are sent to Spark, which builds the nested values from them.
    "list_spans": (_list_spans, lambda: {"texts": [], "lists": []}),
    "table_spans": (_table_spans, lambda: {"texts": [], "rows": [], "tables": []}),
}


def extract(html: str | None, url: str, fields) -> tuple[list, str | None]:
    """The values of ``fields``, and why the page could not be read, None if it could.

    A field that fails keeps its default, others survive; a page that cannot be read keeps
    every default. A page without html, as opposed to an empty one, has nothing to read.
    """
    values = [EXTRACTORS[name][1]() for name in fields]
    if not html:
        return values, "no html" if html is None else None
    page = PageEvents()
    try:
        page.read(html)
    except Exception as error:  # noqa: BLE001 - whatever a page brings up is that page's error
        return values, str(error) or type(error).__name__
    for index, name in enumerate(fields):
        try:
            values[index] = EXTRACTORS[name][0](page, url or "")
        except Exception:
            continue
    return values, None
