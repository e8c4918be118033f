"""HTML extraction by consensus host paths.

Each page is read to a tree of containers (body, div, article, ...) with text
blocks; menus, adverts, forms and the like are marked. The page's best container
gives a vote for its path, written as tags and classes with digits generalised.
Spark counts the votes per host (combined map-side, so a host with a third of all
pages is no hot task), and every page is read again with its host's winning path:
the blocks in the containers of that path, in page order. A page that has no such
container, or one without text, falls back to its own best container.
"""

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import query, small_batches, table

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp textarea title svg math object select".split())
CONTAINERS = frozenset("html body div article main section td center blockquote".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside caption dd details dialog dir dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr legend li menu nav ol p pre search summary table tbody tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEFT_OUT = frozenset("nav footer aside form button dialog menu search fieldset label".split())
#: An opening tag of the key ends an open element of the values, up to a table or list.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
SCOPES = frozenset("table ul ol dl menu html body article main section div".split())

# Class, id and role words of what is no article text.
CHROME = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments disqus "
    "consent cookie cookies footer gdpr login masthead menu modal nav navbar navigation newsletter notice notification "
    "overlay pager pagination popup promo promotion recommended related replies reply respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar widget alert complementary contentinfo "
    "dialog form topbar skip paywall outbrain taboola".split())
HEADER = frozenset(["header", "head"])
#: First words of a class that tells what a page has or lacks (no-sidebar, has-related),
#: and last words of one that names a frame (content-sidebar-wrap).
STATES = frozenset("no not non without with has have is hide hidden".split())
FRAMES = frozenset("wrap wrapper container layout row grid inner outer area columns page".split())
ARTICLE = frozenset("article post entry content story main text body".split())
COMMENT_HEADING = re.compile(
    r"(?:\d+ )?(?:reader |user )?(?:comments?|leave a (?:reply|comment)|responses?|kommentare?|commentaires?|comentarios?)(?: ?\(\d+\))?:?", re.I)

#: What a page's best container must hold of its text.
LEAST_SHARE = 0.5

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>?",
    re.S)
_ATTR = re.compile(r"([A-Za-z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_CLOSE = {tag: re.compile(rf"</{tag}[\s/>]", re.I) for tag in RAW}


def _key(above: int, step: str) -> int:
    """Identity of a path, chained from the path above it."""
    return xxhash.xxh64_intdigest(f"{above}>{step}".encode())


class Node:
    """An element that begins a block. Its path is kept as a chained hash, so that
    deep nesting costs no more than wide."""

    __slots__ = ("tag", "parent", "step", "key", "out", "article", "depth", "chars", "links", "h1", "marked")

    def __init__(self, tag: str, parent: "Node | None", step: str, out: bool):
        self.tag, self.parent, self.step, self.out = tag, parent, step, out
        self.key = _key(parent.key if parent else 0, step)
        self.article = tag in ("article", "main") or (parent is not None and parent.article)
        self.depth = parent.depth + 1 if parent else 0
        self.chars = self.links = 0
        self.h1 = self.marked = False

    def path(self) -> str:
        steps, node = [], self
        while node is not None:
            steps.append(node.step)
            node = node.parent
        return ">".join(reversed(steps))


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTR.findall(raw)} if raw else {}


def _words(mark: str) -> list[str]:
    return [w.lower() for w in _SPLIT.split(mark) if w]


def _is_chrome(mark: list[str]) -> bool:
    """Whether one class, id or role names what is no article text: it has such a word,
    and neither only tells whether there is one nor frames it together with the article."""
    if not CHROME.intersection(mark) or mark[0] in STATES:
        return False
    return not (mark[0] in ARTICLE and mark[-1] in FRAMES)


def _left_out(tag: str, attrs: dict[str, str], parent: Node) -> bool:
    """Whether an element is no part of an article."""
    if tag in LEFT_OUT:
        return True
    inside = parent.article
    if tag == "header" and not inside:
        return True
    if not attrs or tag in ("html", "body"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    marks = [_words(mark) for k in ("class", "id", "role") for mark in attrs.get(k, "").split()]
    names = {w for mark in marks for w in mark}
    if any(map(_is_chrome, marks)):
        # <article class="post nav-on"> and the like stay: one of several words.
        return not (tag in ("article", "main") and names & ARTICLE)
    return bool(names & HEADER) and not inside and not names & ARTICLE


def _step(tag: str, attrs: dict[str, str]) -> str:
    """One step of a generalised path: the tag and its classes, digits as one sign."""
    classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in attrs.get("class", "").replace(">", "").split()})
    return ".".join([tag, *classes])


class Page:
    """Containers and text blocks of one page, in page order."""

    def __init__(self, source: str):
        root = Node("html", None, "html", False)
        self.nodes = [root]
        self.blocks: list[tuple[Node, str]] = []
        self._text: list[str] = []
        self._linked = 0
        stack = [root]
        at, links, heading = 0, 0, ""
        n = len(source)
        low_end = 0
        # No tag ends behind the last >, so what opens there is text and isn't tried.
        last = source.rfind(">") + 1
        for m in _TOKEN.finditer(source, 0, last):
            if m.start() < low_end:
                continue
            if m.start() > at:
                self._add(source[at:m.start()], links)
            at = m.end()
            closing, tag, attrs = m[1], m[2], m[3]
            if tag is None:
                closing, tag, attrs = m[4], m[5], m[6]
                if tag is None:
                    continue
            tag = tag.lower()
            if not closing:
                if tag in RAW and not attrs.endswith("/"):
                    end = _CLOSE[tag].search(source, at)
                    if end is None:
                        at = low_end = n
                    else:
                        at = low_end = source.find(">", end.start()) + 1 or n
                    continue
                if tag == "a":
                    links += 1
                if tag in ("br", "hr", "img", "wbr"):
                    self._text.append(" " if tag != "wbr" else "")
                if tag == "hr":
                    self._flush(stack[-1])
                if tag in VOID or (tag not in BLOCKS and tag != "button" and tag != "label"):
                    continue
                self._flush(stack[-1])
                links = 0 if tag in BLOCKS else links
                if stack[-1].tag == "p" or stack[-1].tag in HEADINGS:
                    stack.pop()
                ends = ENDS.get(tag)
                while ends and stack[-1].tag in ends:
                    stack.pop()
                if tag in ("html", "body") and any(s.tag == tag for s in stack):
                    continue
                parent, own = stack[-1], _attributes(attrs)
                out = parent.out or parent.marked or _left_out(tag, own, parent)
                node = Node(tag, parent, _step(tag, own), out)
                self.nodes.append(node)
                stack.append(node)
                heading = ""
            else:
                if tag == "a":
                    links = max(0, links - 1)
                if tag not in BLOCKS and tag not in ("button", "label"):
                    continue
                if tag == "p" and stack[-1].tag != "p":
                    self._flush(stack[-1])
                    continue
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
                if depth:
                    heading = self._flush(stack[-1])
                    del stack[depth:]
                    if tag in HEADINGS and heading and COMMENT_HEADING.fullmatch(heading):
                        # Reader comments: the heading and what follows it in its parent.
                        self.blocks.pop()
                        if len(stack) > 1:
                            stack[-1].marked = True
        if at < n:
            self._add(source[at:].partition("<!--")[0], links)
        self._flush(stack[-1])
        self._sum()

    def _add(self, text: str, links: int) -> None:
        self._text.append(text)
        if links:
            self._linked += len(text)

    def _flush(self, node: Node) -> str:
        """End the open block; its text, if it has one."""
        text = ""
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            if text and not (node.out or node.marked):
                self.blocks.append((node, text))
                node.chars += len(text)
                node.links += min(self._linked, len(text))
                node.h1 |= node.tag == "h1"
            elif text:
                text = ""
            self._text, self._linked = [], 0
        return text

    def _sum(self) -> None:
        for node in reversed(self.nodes):
            if node.parent is not None:
                node.parent.chars += node.chars
                node.parent.links += node.links
                node.parent.h1 |= node.h1

    def best(self) -> tuple[Node, float] | None:
        """The container with the best score, and the score."""
        total = self.nodes[0].chars
        found = None
        for node in self.nodes:
            if node.out or not node.chars or node.tag not in CONTAINERS or node.chars < LEAST_SHARE * total:
                continue
            score = (node.chars - node.links) / total + 0.01 * min(node.depth, 20)
            score += 0.3 * (node.tag == "article") + 0.2 * (node.tag == "main") + 0.2 * node.h1
            names = {w for w in _SPLIT.split(node.step.partition(".")[2]) if w}
            score += 0.1 * bool(names & ARTICLE)
            if found is None or score > found[1]:
                found = (node, score)
        return found

    def text(self, path: str | None) -> str:
        """The blocks inside the containers of ``path``, or of the best container."""
        def collect(good) -> list[str]:
            # Parents come before their children.
            inside = set()
            for node in self.nodes:
                if id(node.parent) in inside or good(node):
                    inside.add(id(node))
            return [text for node, text in self.blocks if id(node) in inside]

        rows = []
        if path:
            key = 0
            for step in path.split(">"):
                key = _key(key, step)
            rows = collect(lambda x: x.key == key and not x.out)
        if not rows:
            best = self.best()
            rows = collect(lambda x: x is best[0]) if best else []
        return "\n".join(rows)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best = [Page(t).best() if t else None for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([b and b[0].path() for b in best], pa.string()), pa.array([b and b[1] for b in best], pa.float64())],
            names=["host", "path", "score"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [Page(t).text(p) if t else "" for t, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes): the path most pages of a host vote for; of a tie the one with
    the higher summed score, then the smaller path."""
    votes = pages.select("host", "html").mapInArrow(_votes, "host string, path string, score double").filter("path IS NOT NULL")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.round(F.sum("score"), 6).alias("score"))
    best = counted.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("votes"), (-F.col("score")).alias("score"), "path")).alias("b"))
    return best.select("host", "b.path", (-F.col("b.votes")).alias("votes"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text): the main text of every row of ``pages`` (page_id, url, html).

    Defined cases: null and empty html give an empty text, as do pages with nothing
    but menus and the like; a null url, or one without a host, belongs to one host of
    that kind; repeated rows vote each and give equal texts; empty tables give no
    rows. Other columns are not read.
    """
    small_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    own = pages.select("page_id", "url", host.alias("host"), F.col("html").cast("string").alias("html"))
    paths = checkpointed(host_paths(own), "host_paths").select("host", "path")
    rows = own.join(paths, "host", "left").select("page_id", "url", "html", "path")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return rows.mapInArrow(_extract, f"{kinds}, text string")


@query("op3_html")
def op3_html(spark, sf_dir):
    """The main text of all pages."""
    rows = extract_pages(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
