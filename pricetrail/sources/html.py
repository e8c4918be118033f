"""Pages to ordered blocks: the one step that needs Python.

Spark spreads the pages; inside a task the standard-library parser walks one
page at a time. Everything after the blocks is DataFrame work.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = (
    "page_id bigint, block_ord int, kind string, tag string, text string, "
    "table_ord int, row_ord int, cells array<string>"
)
ARROW = pa.schema([
    ("page_id", pa.int64()),
    ("block_ord", pa.int32()),
    ("kind", pa.string()),
    ("tag", pa.string()),
    ("text", pa.string()),
    ("table_ord", pa.int32()),
    ("row_ord", pa.int32()),
    ("cells", pa.list_(pa.string())),
])
# Tags without an end, tags whose text is not page text, headings.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Tags that begin a block; one inside another ends an open paragraph.
BLOCK_TAGS = HEADINGS | set(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer "
    "form head header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())


# Texts of these take blocks inside them too.
KEEPING = HEADINGS | {"td", "th"}
# A tag as most pages write it and the text up to the next one. The parser of the library
# reads all others, texts with references, and what follows a tag whose content is no markup.
PLAIN = re.compile(
    r'<(?:/([a-z][a-z0-9]*)|([a-z][a-z0-9]*)(?:[\t\n\r\f ]+[a-z][a-z0-9-]*="[^"<>&]*")*)>(?:([^<&]*)(?=<))?').match
NO_MARKUP = set("script style textarea title iframe noembed noframes noscript plaintext xmp".split())


class _Node:
    __slots__ = ("tag", "ord", "parts", "outer", "rows", "cells")

    def __init__(self, tag: str, order: int):
        self.tag, self.ord = tag, order
        self.parts: list[str] = []
        self.outer = False
        self.rows: list[_Node] = []
        self.cells: list[_Node] = []

    @property
    def text(self) -> str:
        return " ".join(self.parts)


class PageBlocks(HTMLParser):
    """Collects headings, text blocks and table rows in document order.

    An end tag closes up to its nearest open match; one without a match is
    ignored; a new block closes an open paragraph. Text belongs to every open
    element. An element that holds no block is a label with its whole text, be it
    a paragraph or a word; one that holds blocks is told by these.

    ``takers``, ``tables``, ``lines`` and ``hidden`` are those of the open elements that
    take text, collect rows, collect cells and hide text, so a tag costs the same at
    any depth.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Node] = []
        self.nodes: list[_Node] = []
        self.takers: list[_Node] = []
        self.tables: list[_Node] = []
        self.lines: list[_Node] = []
        self.hidden: list[_Node] = []

    def updatepos(self, i, j):
        # Lines are not counted.
        return j

    def _plain_run(self, i):
        """Take plain tags and texts from ``i`` on; where they end."""
        while (plain := PLAIN(self.rawdata, i)) is not None:
            end, start, text = plain.groups()
            if end is not None:
                self.handle_endtag(end)
            elif start in NO_MARKUP:
                break
            else:
                self.handle_starttag(start, ())
            if text:
                self.handle_data(text)
            i = plain.end()
        return i

    def parse_starttag(self, i):
        k = self._plain_run(i)
        return k if k > i else super().parse_starttag(i)

    def parse_endtag(self, i):
        k = i if self.cdata_elem else self._plain_run(i)
        return k if k > i else super().parse_endtag(i)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self._begin_block()
        node = _Node(tag, len(self.nodes))
        self.nodes.append(node)
        if tag == "tr":
            for up in self.tables:
                up.rows.append(node)
        elif tag == "td" or tag == "th":
            for up in self.lines:
                up.cells.append(node)
        if tag in VOID:
            return
        self.open.append(node)
        self.takers.append(node)
        if tag == "table":
            self.tables.append(node)
        elif tag == "tr":
            self.lines.append(node)
        elif tag in HIDDEN:
            self.hidden.append(node)

    def _close(self, i):
        """Close the open element at ``i`` and all inside it."""
        start = self.open[i].ord
        del self.open[i:]
        for some in (self.takers, self.tables, self.lines, self.hidden):
            while some and some[-1].ord >= start:
                some.pop()

    def _begin_block(self):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == "p":
                self._close(i)
                break
            if self.open[i].tag in BLOCK_TAGS:
                break
        # Elements that took no text before are outer already.
        keeping = []
        for node in self.takers:
            node.outer = True
            if node.tag in KEEPING:
                keeping.append(node)
            else:
                node.parts.clear()
        self.takers = keeping

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                self._close(i)
                return

    def handle_data(self, data):
        if self.hidden or not self.takers:
            return
        text = " ".join(data.split())
        if text:
            for node in self.takers:
                node.parts.append(text)

    def blocks(self) -> Iterator[tuple]:
        tables = 0
        for node in self.nodes:
            if node.tag == "table":
                for row_ord, row in enumerate(self._matrix(node)):
                    yield (node.ord, "row", "table", None, tables, row_ord, row)
                tables += 1
            elif node.tag in HEADINGS:
                yield (node.ord, "heading", node.tag, node.text, None, None, None)
            elif not node.outer and node.parts:
                yield (node.ord, "label", node.tag, node.text, None, None, None)

    @staticmethod
    def _matrix(table: _Node) -> list[list[str]]:
        rows = [[c.text for c in r.cells] for r in table.rows]
        return [r for r in rows if any(r)]


def page_blocks(html: str) -> list[tuple]:
    parser = PageBlocks()
    parser.feed(html or "")
    parser.close()
    return list(parser.blocks())


FLUSH_ROWS = 20_000
PAGES_AT_ONCE = 256


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a batch of pages, sent on whenever enough rows have gathered."""
    rows: list[tuple] = []
    for batch in batches:
        ids, texts = batch.column("page_id"), batch.column("html")
        for page_id, html in zip(ids, texts):
            key = page_id.as_py()
            rows.extend((key, *b) for b in page_blocks(html.as_py()))
            if len(rows) >= FLUSH_ROWS:
                yield _batch(rows)
                rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), ARROW.types)]
    return pa.RecordBatch.from_arrays(columns, schema=ARROW)


def html_blocks(pages: DataFrame) -> DataFrame:
    """Blocks of each page in document order; ``pages`` has page_id and html."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "html").mapInArrow(_parse, BLOCKS)


TABLES = "page_id bigint, tables array<struct<heading: string, labels: map<string, string>, grid: array<array<string>>>>"
ARROW_TABLES = pa.schema([
    ("page_id", pa.int64()),
    ("tables", pa.list_(pa.struct([
        ("heading", pa.string()), ("labels", pa.map_(pa.string(), pa.string())), ("grid", pa.list_(pa.list_(pa.string()))),
    ]))),
])


def tables_of_blocks(blocks: list[tuple], headings: Sequence[str], watched: Mapping[str, Sequence[str]]) -> list[dict]:
    """Tables of a page with the last heading and the last watched texts before each."""
    heading, labels, tables, last = None, {}, [], None
    for _, kind, tag, text, table, _, cells in blocks:
        if kind == "row":
            if table != last:
                tables.append({"heading": heading, "labels": list(labels.items()), "grid": []})
                last = table
            tables[-1]["grid"].append(cells)
            continue
        if kind == "heading" and tag in headings:
            heading = text
        for name, options in watched.items():
            if text in options:
                labels[name] = text
    return tables


def page_tables(pages: DataFrame, headings: Sequence[str], watched: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per page: its tables with the texts that name them.

    ``watched`` lists texts by name; a table gets the last of each list before it. A
    page's tables are no larger than the page, and whatever is asked of a table, or of
    the tables of a page, needs no shuffle.
    """
    names = {k: frozenset(v) for k, v in watched.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = range(start, min(start + PAGES_AT_ONCE, batch.num_rows))
                tables = [tables_of_blocks(page_blocks(texts[i].as_py()), headings, names) for i in part]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, len(tables)), pa.array(tables, ARROW_TABLES.field("tables").type)], schema=ARROW_TABLES)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "html").mapInArrow(run, TABLES)
