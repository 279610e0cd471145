"""Main text of web pages by composite text density.

A page becomes a DOM tree. Every node counts its characters C, tags T, link characters LC and link tags LT; with the
body's LCb and Cb, its density is

    C / T * log(C * T / (LC * LT)) / log(ln(C / nLC * LC + LCb / Cb * C + e)),    nLC = C - LC

(zero counts are taken as 1), and its density sum adds its children's densities. The node of the greatest density sum
sets the threshold: the least density on its path to the body. Of nodes of equal sums the first in the page wins. That
node is the article, and all of its text is kept but for lists of links in it that stay below the threshold (two links
at least, which are most of the text). Inline elements count as tags and links of the block around
them but are no candidates and add no density of their own: one bold line would otherwise outweigh its article. Nodes that HTML itself marks as something else (nav, header, footer, aside, form,
script ...) or whose class, id or role names say so (menu, sidebar, advert, comment, cookie notice ...) are left out
before counting.

Character references are decoded, white space inside a block is one space, and blocks are joined by one newline.
Defined results: null, empty and textless pages give an empty text; unclosed and misnested tags are closed where HTML
would close them; pages without a body are read as one; repeated rows are separate rows; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import trimmed

# fixed values: names of HTML elements and of page furniture
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption option".split()
)
FURNITURE = frozenset("head nav header footer aside form script style noscript template iframe button select svg canvas object audio video dialog menu".split())
CLOSES_P = BLOCK - {"br", "option", "tbody", "td", "tfoot", "th", "thead", "tr", "caption", "body", "html"}
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
_NAMED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|advertisement|advertising|adbox|banner|breadcrumb|breadcrumbs|comment|comments|commentlist|disqus|cookie|cookies|consent|gdpr|"
    r"footer|footnav|header|masthead|menu|menubar|nav|navbar|navigation|newsletter|notice|notification|popup|modal|overlay|pager|pagination|promo|promoted|"
    r"recommended|related|respond|replies|share|sharing|sidebar|sidenav|social|sponsor|sponsored|subscribe|signup|login|toolbar|widget|widgets|alert|paywall|disclaimer|skip|toc)(?=$|[\s_-]|[0-9])",
    re.I,
)
#: Names of a block that has something beside it, and is not that thing itself.
_BESIDE = re.compile(r"(?:^|[_-])(?:has|with|without|no|hide|show)[_-]", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_TOKEN = re.compile(r"<!--(?:(?!-->)[\s\S])*+(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


class Node:
    __slots__ = ("tag", "parent", "items", "skip", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, skip: bool):
        self.tag, self.parent, self.items, self.skip = tag, parent, [], skip
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _furniture(tag: str, attributes: str) -> bool:
    if tag in FURNITURE:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id") and any(_NAMED.search(x) and not _BESIDE.search(x) for x in value.split()):
            return True
        if name == "role" and value.lower() in _ROLES:
            return True
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return True
    return False


def _close(node: Node, wanted: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> Node:
    """The parent of the nearest open element of ``wanted``, searched up to ``scope``; else ``node``."""
    at = node
    while at is not None and at.tag not in scope:
        if at.tag in wanted:
            return at.parent
        at = at.parent
    return node


_P_SCOPE = frozenset("html body article section div main td th table li ul ol blockquote aside nav header footer form button dd dt".split())


def tree(page: str) -> Node:
    root = Node("#root", None, False)
    node, at, n = root, 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            node.items.append(page[at:])
            break
        if m.start() > at:
            node.items.append(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, ending, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if ending:
            if tag == "br":
                node.items.append(Node("br", node, False))
                continue
            up = node
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                node = up.parent
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in ("html", "body"):
            # one of each; a second start tag only adds attributes
            up = node
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None:
                continue
            if tag == "body":
                node = _close(node, {"head"}, {"html"})
        elif tag in CLOSES_P:
            node = _close(node, {"p"}, _P_SCOPE)
        if tag in CLOSED_BY:
            wanted, scope = CLOSED_BY[tag]
            while (up := _close(node, wanted, scope)) is not node:
                node = up
        if node.tag == "head" and tag not in ("meta", "link", "base"):
            node = node.parent
        child = Node(tag, node, _furniture(tag, attributes))
        node.items.append(child)
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            node = child
        elif tag not in VOID and tag not in ("svg", "path", "circle", "rect", "use"):
            node = child  # a slash doesn't close HTML elements
    return root


def _length(text: str) -> int:
    return len("".join(text.split()))


def _in_order(root: Node) -> list[Node]:
    """Kept nodes, parents before children."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(x for x in reversed(node.items) if type(x) is Node and not x.skip)
    return found


def _measure(nodes: list[Node], body: Node) -> None:
    for node in reversed(nodes):
        for x in node.items:
            if type(x) is Node:
                if not x.skip:
                    node.chars += x.chars
                    node.tags += x.tags + 1
                    node.link_chars += x.link_chars
                    node.link_tags += x.link_tags + (x.tag == "a")
            else:
                node.chars += _length(x)
        if node.tag == "a":
            node.link_chars = node.chars
    ratio = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        c, t = node.chars, node.tags or 1
        if not c:
            continue
        lc, lt, plain = node.link_chars, node.link_tags, c - node.link_chars
        base = math.log(math.log(c / (plain or 1) * lc + ratio * c + math.e) + 1e-9) if lc or ratio else 0.0
        x = c / (lc or 1) * t / (lt or 1)
        # without links the logarithm's base tends to 1; the node is then as dense as its text
        node.density = c / t * (math.log(max(x, 1.0)) / base if base > 1e-6 else math.log(max(x, math.e)))
    for node in nodes:
        if node.tag in BLOCK:
            up = node.parent
            while up is not None and up.tag not in BLOCK and up is not body and up.parent is not None:
                up = up.parent
            if up is not None:
                up.total += node.density


def article(root: Node) -> Node:
    nodes = _in_order(root)
    body = next((x for x in nodes if x.tag == "body"), root)
    nodes = _in_order(body)
    _measure(nodes, body)
    nodes = [x for x in nodes if x.tag in BLOCK or x is body]
    peak = max(nodes, key=lambda x: x.total)
    threshold, at = peak.density, peak
    while at is not body:
        at = at.parent
        threshold = min(threshold, at.density)
    best = peak if peak.total > 0 else body
    for x in _in_order(best):
        if x is not best and x.tag in BLOCK and x.density < threshold and x.link_tags >= 2 and 2 * x.link_chars > x.chars:
            x.skip = True
    return best


def text_of(node: Node) -> str:
    blocks, parts = [], []

    def flush() -> None:
        if parts:
            joined = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if joined:
                blocks.append(joined)

    stack: list = [(node, False)]
    while stack:
        x, ended = stack.pop()
        if type(x) is not Node:
            parts.append(x)
        elif ended:
            flush()
        elif not x.skip or x is node:
            if x.tag in BLOCK:
                flush()
                stack.append((x, True))
            stack.extend((y, False) for y in reversed(x.items))
    flush()
    return "\n".join(blocks)


def extract(page: str | None) -> str:
    """The main text of one page."""
    return text_of(article(tree(page))) if page else ""


def extract_pages(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """(key, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
            texts = [extract(x) for x in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), batch.column(url), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=[key, url, "text", "n_chars"]
            )

    return pages.select(F.col(key), F.col(url), F.col(html)).mapInArrow(trimmed(run), f"`{key}` bigint, `{url}` string, text string, n_chars bigint")
