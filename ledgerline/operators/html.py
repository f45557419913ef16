"""Rows and links of archived pages in one pass; one Arrow batch of pages at a time, no shuffle.

Python only turns markup into rows of cells and links. Everything after that
(sections, labels, officers, publications) is done with DataFrame operations. Link targets
alone are found without Python, see ``links``.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# executors need not have this package installed: the parser travels with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: One tag in plain markup with the text behind it: groups are closing slash, name, attributes, self-closing slash, text; or a
#: comment or doctype with the text behind it. Anything else (stray ``<``, odd quoting, markup sections) is left to HTMLParser.
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'=<>`&]+(?=[ \t\r\n\f>]|$))"""
_TAG = re.compile(
    rf"<(/?)([A-Za-z][A-Za-z0-9]*)((?:[ \t\r\n\f]+[A-Za-z][A-Za-z0-9:_.-]*(?:={_VALUE})?)*)[ \t\r\n\f]*(/?)>([^<]*)"
    r"|<!(?:--(?!-?>)(?:[^-]|-(?!-))*--|[dD][oO][cC][tT][yY][pP][eE][^<>]*)>([^<]*)")
_ATTRIBUTE = re.compile(rf"([A-Za-z][A-Za-z0-9:_.-]*)(?:=({_VALUE}))?")
#: A reference in an attribute that parsers of all versions read alike.
_LOOSE = re.compile(r"&(?!(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);)")
#: Elements whose text is no markup. A script or style must end with the first tag that closes it.
_RAW = {name: re.compile(rf"<\s*/\s*{name}|<!--", re.I) for name in ("script", "style")}
_PLAIN = {"title", "textarea"}
_OPAQUE = {"xmp", "iframe", "noembed", "noframes", "plaintext", "noscript", "svg", "math"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_ENDS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "li": ("li",), "p": ("p",)}
_SCOPE = {"table", "ul", "ol", "div", "body", "html"}


class Page(HTMLParser):
    """Elements in document order, each with the span of text pieces it covers."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.elements: list[dict] = []
        self.open: list[dict] = []
        self.depth: Counter[str] = Counter()  # open elements per tag
        self.raw = 0
        if not self._scan(html):
            self.texts, self.elements, self.open = [], [], []
            self.depth.clear()
            self.feed(html)
            self.close()
        while self.open:
            self._shut()

    def _scan(self, html: str) -> bool:
        """Read plain markup tag by tag, with the same outcome as HTMLParser; False where the page has anything else."""
        match, attributes, lowered, start, end = _TAG.match, {"": {}}, {}, self.handle_starttag, self.handle_endtag
        texts, opened, depth = self.texts, self.open, self.depth
        at, size = html.find("<"), len(html)
        if at < 0:
            at = size
        if at:
            self.handle_data(unescape(html[:at]))
        while at < size:
            found = match(html, at)
            if found is None:
                return False
            closing, tag, source, empty, text, after = found.groups()
            at = found.end()
            if tag is None:
                text = after
            else:
                tag = lowered.get(tag) or lowered.setdefault(tag, tag.lower())
                if closing:
                    if source or empty:
                        return False
                    if opened and opened[-1]["tag"] == tag:
                        opened.pop()["end"] = len(texts)
                        depth[tag] -= 1
                    else:
                        end(tag)
                else:
                    given = attributes.get(source)
                    if given is None:
                        given = {}
                        for name, value in _ATTRIBUTE.findall(source):
                            if not value:
                                value = None
                            else:
                                value = value[1:-1] if value[0] in "'\"" else value
                                if "&" in value:
                                    if _LOOSE.search(value):
                                        return False
                                    value = unescape(value)
                            given[name.lower()] = value
                        attributes[source] = given
                    if tag in _OPAQUE:
                        return False
                    start(tag, given)
                    if empty:
                        end(tag)
                    elif tag in _RAW:
                        close = _RAW[tag].search(html, found.start(5))
                        if close is None or not re.match(rf"</{tag}[ \t\r\n\f]*>", html[close.start():close.start() + 40], re.I):
                            return False
                        at = close.start()
                        continue
                    elif tag in _PLAIN and not re.match(rf"</{tag}[ \t\r\n\f]*>", html[at:at + 40], re.I):
                        return False
            if text:
                text = (unescape(text) if "&" in text else text).strip()
                if text and not (opened and opened[-1]["tag"] in _RAW):
                    texts.append(text)
        return True

    def _shut(self) -> None:
        element = self.open.pop()
        element["end"] = len(self.texts)
        self.depth[element["tag"]] -= 1

    def handle_starttag(self, tag, attrs):
        for ended in _ENDS.get(tag, ()):
            if not self.depth.get(ended):
                continue
            for element in reversed(self.open):
                if element["tag"] in _SCOPE:
                    break
                if element["tag"] == ended:
                    self.handle_endtag(ended)
                    break
        element = {"tag": tag, "attrs": attrs if isinstance(attrs, dict) else dict(attrs), "start": len(self.texts), "end": None,
                   "up": self.open[-1] if self.open else None}
        self.elements.append(element)
        if tag in _VOID:
            element["end"] = element["start"]
        else:
            self.open.append(element)
            self.depth[tag] += 1

    def handle_endtag(self, tag):
        if self.depth[tag]:
            while self.open[-1]["tag"] != tag:
                self._shut()
            self._shut()

    def handle_data(self, data):
        if data.strip() and not (self.open and self.open[-1]["tag"] in ("script", "style")):
            self.texts.append(data.strip())

    def text(self, element: dict) -> str:
        return " ".join(" ".join(self.texts[element["start"]:element["end"]]).split())

    def enclosing(self, element: dict, tags: tuple[str, ...]) -> dict | None:
        up = element["up"]
        while up is not None and up["tag"] not in tags:
            up = up["up"]
        return up


def _rows(page: Page) -> list[list[tuple]]:
    """Cells ``(tag, class, text)`` of every table row."""
    rows: dict[int, list[tuple]] = {}
    for element in page.elements:
        tag = element["tag"]
        if tag == "tr":
            rows[id(element)] = []
        elif tag in ("td", "th"):
            row = page.enclosing(element, ("tr",))
            if row is not None:
                rows[id(row)].append((tag, element["attrs"].get("class") or "", page.text(element)))
    return list(rows.values())


_ITEM = pa.schema([
    ("num", pa.string()), ("page", pa.int64()), ("kind", pa.string()), ("no", pa.int32()),
    ("cells", pa.list_(pa.struct([("tag", pa.string()), ("cls", pa.string()), ("text", pa.string())]))),
    ("href", pa.string()), ("text", pa.string()), ("row_text", pa.string()), ("block_text", pa.string())])
ITEM = (
    "num string, page long, kind string, no int, cells array<struct<tag:string,cls:string,text:string>>, "
    "href string, text string, row_text string, block_text string")
#: Pages whose items are handed on together.
_PAGES = 200


def _items(num: str, page: int, html: str | None) -> Iterator[tuple]:
    parsed = Page(html or "")
    for i, cells in enumerate(_rows(parsed)):
        if cells:
            yield num, page, "row", i, cells, None, None, None, None
    links = [e for e in parsed.elements if e["tag"] == "a" and e["attrs"].get("href") is not None]
    for i, link in enumerate(links):
        row = parsed.enclosing(link, ("tr",)) or parsed.enclosing(link, ("td",)) or link["up"] or link
        block = parsed.enclosing(link, ("li", "tr", "div", "p")) or link
        yield num, page, "link", i, None, link["attrs"]["href"], parsed.text(link), parsed.text(row), parsed.text(block)


def _batch(items: list[tuple]) -> pa.RecordBatch:
    """Items as one Arrow batch; the cells of all rows lie in flat arrays under their offsets."""
    columns = list(zip(*items, strict=True)) if items else [()] * len(_ITEM)
    counts = [None if cells is None else len(cells) for cells in columns[4]]
    flat = [cell for cells in columns[4] if cells is not None for cell in cells]
    kind = _ITEM.field("cells").type
    texts = [pa.array(c, pa.string()) for c in (zip(*flat, strict=True) if flat else [()] * 3)]
    offsets, at = [], 0
    for n in counts:
        offsets.append(None if n is None else at)
        at += n or 0
    cells = pa.ListArray.from_arrays(pa.array([*offsets, at], pa.int32()), pa.StructArray.from_arrays(texts, fields=list(kind.value_type)))
    return pa.RecordBatch.from_arrays(
        [cells if f.name == "cells" else pa.array(c, f.type) for c, f in zip(columns, _ITEM, strict=True)], schema=_ITEM)


def page_items(pages: DataFrame) -> DataFrame:
    """Table rows with cells and links with a target, as one stream: a page is parsed once for both.

    ``kind`` is ``row`` (number among the page's rows, cells) or ``link`` (number among the links, href and texts). A page
    without either gives nothing.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _PAGES):
                yield _batch([item for page in zip(*(c.to_pylist() for c in batch.slice(start, _PAGES).columns), strict=True) for item in _items(*page)])

    return pages.select("num", F.col("page").cast("long").alias("page"), "html").mapInArrow(parse, ITEM)


def rows_of(items: DataFrame) -> DataFrame:
    """``(num, page, row_no, cells)`` of every table row that has cells."""
    return items.where(F.col("kind") == "row").select("num", "page", F.col("no").alias("row_no"), "cells")


def links_of(items: DataFrame) -> DataFrame:
    """``(num, page, link_no, href, text, row_text, block_text)`` of every link with a target."""
    return items.where(F.col("kind") == "link").select("num", "page", F.col("no").alias("link_no"), "href", "text", "row_text", "block_text")


def page_rows(pages: DataFrame) -> DataFrame:
    return rows_of(page_items(pages))


def page_links(pages: DataFrame) -> DataFrame:
    return links_of(page_items(pages))
