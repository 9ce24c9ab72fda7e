"""Page HTML to one row of elements, parsed once per page.

Python only builds the tree and lists the elements; every rule about titles,
years, links and sections is a column expression in ``pages.py``.
"""

from __future__ import annotations

import sys
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions.urls import absolute_url

VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
HIDDEN = {"script", "style", "template"}
# Pages are read and handed on in stretches of this many rows and characters at most, or one page.
STRETCH_ROWS, STRETCH_CHARS = 256, 1 << 20

_strings = pa.list_(pa.string())
ELEMENTS = pa.schema([
    ("lang", pa.string()),
    ("title_tag", pa.string()),
    ("page_text", pa.string()),
    ("all_text", pa.string()),
    ("h2", _strings),
    ("row_links", _strings),
    ("links", pa.list_(pa.struct([
        ("href", pa.string()), ("label", pa.string()), ("text", pa.string()), ("css", _strings),
    ]))),
    ("frames", pa.list_(pa.struct([("src", pa.string()), ("leads_file", pa.bool_())]))),
    ("sections", pa.list_(pa.struct([
        ("heading", pa.string()), ("anchors", _strings), ("items", _strings), ("paragraph", pa.string()),
    ]))),
])
class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag, attrs=None, parent=None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs or {}, parent, []

    def walk(self):
        stack = [iter(self.children)]
        while stack:
            child = next(stack[-1], None)
            if child is None:
                stack.pop()
                continue
            yield child
            if isinstance(child, Node):
                stack.append(iter(child.children))

    def find_all(self, tag):
        return [n for n in self.walk() if isinstance(n, Node) and n.tag == tag]

    def pieces(self):
        """Visible text pieces: no comments, scripts or styles, unless inside one."""
        for n in self.walk():
            if isinstance(n, Text) and not n.comment and (n.hidden is None or n.hidden == self.tag):
                yield n.value

    def text(self):
        return "".join(self.pieces()).strip()

    def tight_text(self):
        return "".join(p.strip() for p in self.pieces())

    def label(self):
        """The only string inside, else None."""
        node = self
        while isinstance(node, Node):
            if len(node.children) != 1:
                return None
            node = node.children[0]
        return node.value

    def next_sibling(self, tag):
        later = self.parent.children[self.parent.children.index(self) + 1:]
        return next((n for n in later if isinstance(n, Node) and n.tag == tag), None)


class Text:
    __slots__ = ("value", "comment", "hidden")

    def __init__(self, value, comment=False, hidden=None):
        self.value, self.comment, self.hidden = value, comment, hidden


class TreeBuilder(HTMLParser):
    """Tree with the usual lenient rules: only an end tag closes an element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("[document]")
        self.buffer = []
        self.tags: dict[str, list[Node]] = {}
        self.strings: list[Text] = []

    def updatepos(self, i, j):
        """Line numbers are not needed."""
        return j

    def handle_starttag(self, tag, attrs):
        self.flush()
        node = Node(tag, {name: value or "" for name, value in attrs}, self.here)
        self.here.children.append(node)
        self.tags.setdefault(tag, []).append(node)
        if tag not in VOID:
            self.here = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        node = self.here
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.here = node.parent

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_comment(self, data):
        self.flush()
        self.add_text(Text(data, comment=True))

    def add_text(self, text):
        self.here.children.append(text)
        self.strings.append(text)

    def flush(self):
        if not self.buffer:
            return
        value = "".join(self.buffer)
        self.buffer.clear()
        if not value.strip(" \n\t\f\r") and self.here.tag not in ("pre", "textarea"):
            value = "\n" if "\n" in value else " "
        self.add_text(Text(value, hidden=self.here.tag if self.here.tag in HIDDEN else None))

    def release(self):
        """Take the tree apart, so that its nodes, which hold each other, go at once and not at some later collection."""
        self.root.children = []
        for nodes in self.tags.values():
            for node in nodes:
                node.parent, node.children = None, []


def build_tree(html: str | None) -> TreeBuilder:
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    builder.flush()
    return builder


def _lang(page: TreeBuilder):
    return page.tags["html"][0].attrs.get("lang") if "html" in page.tags else None


def _title_tag(page: TreeBuilder):
    return page.tags["title"][0].tight_text() if "title" in page.tags else None


def _row_links(page: TreeBuilder):
    firsts = (next((a for a in row.find_all("a") if "href" in a.attrs), None) for row in page.tags.get("tr", []))
    return [a.attrs["href"] for a in firsts if a is not None]


def _links(page: TreeBuilder):
    return [
        {"href": a.attrs.get("href"), "label": a.label(), "text": a.tight_text(), "css": a.attrs.get("class", "").split()}
        for a in page.tags.get("a", [])
    ]


def _frames(page: TreeBuilder):
    leading = [
        frame for div in page.tags.get("div", []) if div.attrs.get("id") == "the-statement-file"
        for frame in div.find_all("iframe")[:1]
    ]
    return [{"src": f.attrs.get("src"), "leads_file": any(f is x for x in leading)} for f in page.tags.get("iframe", [])]


def _sections(page: TreeBuilder):
    sections = []
    for h3 in page.tags.get("h3", []):
        listing, para = h3.next_sibling("ul"), h3.next_sibling("p")
        sections.append({
            "heading": h3.label(),
            "anchors": None if listing is None else [a.text() for a in listing.find_all("a")],
            "items": None if listing is None else [li.text() for li in listing.find_all("li")],
            "paragraph": None if para is None else para.text(),
        })
    return sections


READERS = {
    "lang": _lang,
    "title_tag": _title_tag,
    "page_text": lambda page: "".join(s.value for s in page.strings if not s.comment and s.hidden is None),
    "all_text": lambda page: "\n".join(s.value for s in page.strings),
    "h2": lambda page: [n.tight_text() for n in page.tags.get("h2", [])],
    "row_links": _row_links,
    "links": _links,
    "frames": _frames,
    "sections": _sections,
}


def page_elements(html: str | None, wanted: tuple[str, ...] = tuple(READERS)) -> dict:
    page = build_tree(html)
    found = {name: READERS[name](page) for name in wanted}
    page.release()
    return found


def stretches(sizes: list[int | None]):
    """First and last place (exclusive) of stretches of pages with these sizes, bounded by rows and characters."""
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and (i - first >= STRETCH_ROWS or total + (size or 0) > STRETCH_CHARS):
            yield first, i
            first, total = i, 0
        total += size or 0
    if len(sizes) > first:
        yield first, len(sizes)


def element_batches(batches, html: str, carried: list[str], fields: pa.Schema):
    """The carried columns and the page elements of Arrow batches, stretch by stretch."""
    for batch in batches:
        for first, last in stretches(pc.utf8_length(batch.column(html)).to_pylist()):
            part = batch.slice(first, last - first)
            rows = [page_elements(h.as_py(), tuple(fields.names)) for h in part.column(html)]
            found = pa.RecordBatch.from_pylist(rows, schema=fields)
            yield pa.RecordBatch.from_arrays([part.column(c) for c in carried] + found.columns, carried + fields.names)


def parse_pages(pages: DataFrame, html: str = "html", wanted: tuple[str, ...] = tuple(READERS)) -> DataFrame:
    """All columns but the HTML, plus the wanted elements of the page; narrow, one parse per page.

    Only wanted elements are read off the tree and leave the worker; ``pages.NEEDS`` tells which ones a rule takes.
    A worker holds the elements of one stretch of a batch at a time.
    """
    unknown = sorted(set(wanted) - set(READERS))
    if unknown:
        raise ValueError(f"no such page elements: {', '.join(unknown)}")
    carried = [c for c in pages.columns if c != html]
    fields = pa.schema([ELEMENTS.field(n) for n in ELEMENTS.names if n in wanted])

    def parse(batches):
        return element_batches(batches, html, carried, fields)

    kept = T.StructType([f for f in pages.schema if f.name != html])
    return pages.select(*carried, html).mapInArrow(parse, T.StructType([*kept, *from_arrow_schema(fields)]))


def extract_with(pages: DataFrame, fn, schema: str) -> DataFrame:
    """Run a caller's function over batches of pages.

    ``fn`` takes the tree of one page and returns a dict (or None to skip it);
    ``schema`` describes the dict's fields, which follow page_id and url. The tree
    is taken apart once ``fn`` returns. Records leave the worker stretch by stretch.
    """
    fields = T.StructType.fromDDL(schema).names

    def run(frames):
        import pandas as pd

        for frame in frames:
            for first, last in stretches([len(h or "") for h in frame["html"]]):
                part, out = frame.iloc[first:last], []
                for page_id, url, html in zip(part["page_id"], part["url"], part["html"]):
                    page = build_tree(html)
                    record = fn(page.root)
                    if record is not None:
                        out.append([page_id, url] + [record.get(f) for f in fields])
                    page.release()
                yield pd.DataFrame(out, columns=["page_id", "url", *fields])

    kept = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return pages.select("page_id", "url", "html").mapInPandas(run, f"{kept}, {schema}")


def links_with(pages: DataFrame, fn, base_url: str) -> DataFrame:
    """Absolute links that a caller's function finds on each page, with their position."""
    found = extract_with(pages, lambda root: {"links": list(fn(root))}, "links array<string>")
    rows = found.select("page_id", "url", F.posexplode("links").alias("position", "href"))
    return rows.withColumn("link", absolute_url(F.col("href"), F.lit(base_url)))


def page_table(fn, fields: str):
    """A table function over page HTML, for a lateral call: position and ``fields`` of every row that a caller's function finds.

    ``fn`` takes the tree of one page and returns tuples of the fields. The schema is settled when the call is analysed,
    where anything but one text argument is refused. Register it with ``spark.udtf.register``, or call it on columns.
    """
    schema = T.StructType.fromDDL(f"position int, {fields}")

    class PageTable:
        @staticmethod
        def analyze(html: AnalyzeArgument) -> AnalyzeResult:
            if not isinstance(html.dataType, (T.StringType, T.NullType)):
                raise TypeError(f"the page must be text, not {html.dataType.simpleString()}")
            return AnalyzeResult(schema)

        def eval(self, html):
            page = build_tree(html)
            for position, row in enumerate(fn(page.root)):
                yield (position, *row)
            page.release()

    return F.udtf(PageTable, useArrow=True)


def link_table(fn):
    """A table function of (position, href) for a link extractor, which takes a page's tree and returns links."""
    return page_table(lambda root: ((href,) for href in fn(root)), "href string")


def lateral_links(pages: DataFrame, fn, base_url: str) -> DataFrame:
    """The rows of ``links_with`` by a lateral call of a table function: links stream out of it one by one, and no page's are gathered."""
    found = pages.select("page_id", "url", "html").lateralJoin(link_table(fn)(F.col("html").outer()))
    rows = found.select("page_id", "url", "position", "href")
    return rows.withColumn("link", absolute_url(F.col("href"), F.lit(base_url)))


# Workers may lack this package, so its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
