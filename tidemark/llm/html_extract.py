"""Main text of web pages by composite text density.

A page's tags are read into a small DOM. Every node gets its characters, tags, link characters and link tags; its density is
characters per tag, adjusted by links: text in links counts against it, the more so the higher the page's own share of link
text. A node's density sum adds its children's densities. The subtree with the largest density sum among the nodes above
the threshold, the least density on the path from the body to the densest node, is the main content.

Inside it, menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out, by
element and by the words of their class, id and role; words that articles use of themselves, too, count only where nothing
else is said ("notice", "cookie-notice", but not "article-header"). Blocks are joined in page order.

Nulls and ties: a null, empty or tagless page without text gives an empty text; of equal density sums the outermost node
wins, then the first in page order; repeated pages are rows of their own. Tags that are not closed, stray end tags and
unfinished comments are read as browsers read them, nearly; a tag that another "<" interrupts ends there. Pages of any length
and depth are read in one pass over their tags.
"""

from __future__ import annotations

import html
import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked

#: Fixed values of HTML: elements without content, with raw content, and blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas textarea title select option button xmp noembed".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An open element is closed by the start of another (the end tag may be left out).
CLOSED_BY = {
    "p": BLOCK - {"br", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "figcaption", "summary", "dd", "dt", "li"} | {"li", "dd", "dt"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"}, "option": {"option"},
}
#: Elements that hold another start tag's scope: an unclosed li outside of them is not closed.
SCOPE = frozenset("ul ol menu dl table article section div main aside nav header footer form body html td th".split())
DROPPED = frozenset("nav header footer aside form script style noscript template svg math iframe object canvas select textarea button head title dialog menu".split())
#: Words of clutter in a class or id, those that need company, and the company that changes nothing.
CLUTTER = frozenset(
    "nav navbar navigation menu footer sidebar aside ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr popup modal overlay "
    "newsletter subscribe signup share sharing breadcrumb breadcrumbs comment comments respond disqus replies reply pagination pager toolbar copyright masthead".split()
)
WEAK = frozenset("header side promo banner notice notices alert social related recommended search login widget skip".split())
GENERIC = frozenset(
    "site page top bottom left right main wrapper container content box bar area block list section inner outer global primary secondary fixed sticky small large "
    "links link posts articles items item button buttons icons icon form text slot unit col column row group panel js is u c".split()
)
_PARTS = re.compile(r"[A-Za-z]+")
_ROLES = re.compile(r"navigation|banner|contentinfo|complementary|search|form|dialog|alert|menu|menubar", re.IGNORECASE)
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"[^<>\"']*")  # of a tag, up to a quote or its end
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")


class _Node:
    __slots__ = ("tag", "items", "dropped", "chars", "tags", "link_chars", "link_tags", "density", "total", "parent")

    def __init__(self, tag: str, parent: _Node | None, dropped: bool):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.items: list = []  # texts and nodes, in order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _is_clutter(tag: str, attrs: str) -> bool:
    if tag in DROPPED:
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in _ATTR.findall(attrs):
        value = next((v for v in values if v), "")
        name = name.lower()
        if name in ("class", "id") and any(map(_names_clutter, value.split())) or name == "role" and _ROLES.search(value):
            return True
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return True
    return False


@lru_cache(100_000)
def _names_clutter(name: str) -> bool:
    """A class or id that names clutter: by a word of CLUTTER, or by WEAK words in no other company than GENERIC ones."""
    words = [w.lower() for w in _PARTS.findall(name)]
    return any(w in CLUTTER for w in words) or any(w in WEAK for w in words) and all(w in WEAK or w in GENERIC for w in words)


class _Tags:
    """The tags of a page, in order: (start, end, closing, name, attributes); name is None for comments and the like."""

    def __init__(self, page: str):
        self.page, self.last = page, {q: page.rfind(q) for q in "\"'>"}

    def next(self, pos: int) -> tuple[int, int, bool, str | None, str] | None:
        page, size = self.page, len(self.page)
        while (start := page.find("<", pos)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, size if end < 0 else end + 3, False, None, ""
            if page.startswith(("<!", "<?"), start):
                end = page.find(">", start) if start < self.last[">"] else -1
                return start, size if end < 0 else end + 1, False, None, ""
            m = _NAME.match(page, start + 1)
            if m:
                begin, end = m.end(), self._end(m.end())
                stop = end - 1 if page[end - 1 : end] == ">" else end
                return start, end, bool(m.group(1)), m.group(2).lower(), page[begin:stop]
            pos = start + 1
        return None

    def _end(self, pos: int) -> int:
        """Past the tag's ">"; or where another "<" or the page's end interrupts it. Quoted values may hold either sign."""
        page, size = self.page, len(self.page)
        while True:
            pos = _PLAIN.match(page, pos).end()
            if pos >= size or page[pos] == "<":
                return pos
            if page[pos] == ">":
                return pos + 1
            quote = page[pos]
            pos = page.find(quote, pos + 1) + 1 if pos < self.last[quote] else pos + 1  # a quote that is never closed is skipped


class _Open:
    """The open elements, innermost last, with the places of each name among them."""

    def __init__(self, root: _Node):
        self.stack, self.of, self.scopes, self.content = [root], {}, [], []

    def push(self, node: _Node) -> None:
        at = len(self.stack)
        self.stack.append(node)
        self.of.setdefault(node.tag, []).append(at)
        if node.tag in SCOPE:
            self.scopes.append(at)
        if node.tag in ("article", "main", "body"):
            self.content.append(at)

    def cut(self, at: int) -> None:
        """Closes the element at this place and all inside it."""
        while len(self.stack) > at:
            tag = self.stack.pop().tag
            self.of[tag].pop()
            for kind in (self.scopes, self.content):
                if kind and kind[-1] == len(self.stack):
                    kind.pop()

    def close(self, tag: str) -> None:
        """An end tag: a stray one doesn't close the content around it."""
        places = self.of.get(tag)
        if places and (tag in ("body", "html", "main", "article", "section", "div") or not self.content or places[-1] >= self.content[-1]):
            self.cut(places[-1])

    def make_room(self, tag: str) -> None:
        """A start tag closes the innermost element whose end tag may be left out before it, within the innermost scope."""
        scope = self.scopes[-1] if self.scopes else 0
        places = [self.of[x][-1] for x in _CLOSES.get(tag, ()) if self.of.get(x)]
        at = max(places, default=0)
        if at and at >= scope:
            self.cut(at)


_CLOSES: dict[str, list[str]] = {}
for _open, _by in CLOSED_BY.items():
    for _tag in _by:
        _CLOSES.setdefault(_tag, []).append(_open)


def parse(page: str) -> _Node:
    """The page's DOM: a root with everything below it."""
    root = _Node("#root", None, False)
    tags, elements = _Tags(page), _Open(root)
    pos, end = 0, len(page)
    while pos < end:
        found = tags.next(pos)
        start = found[0] if found else end
        if start > pos:
            elements.stack[-1].items.append(page[pos:start])
        if not found:
            break
        _, pos, closing, tag, attrs = found
        if tag is None:
            continue
        if closing:
            elements.close(tag)
            continue
        elements.make_room(tag)
        node = _Node(tag, elements.stack[-1], _is_clutter(tag, attrs))
        elements.stack[-1].items.append(node)
        if tag in VOID or attrs.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*(?:>|\\Z)", re.IGNORECASE).search(page, pos)
            node.items.append(page[pos : close.start() if close else end])
            pos = close.end() if close else end
        else:
            elements.push(node)
    return root


def _measure(root: _Node) -> list[_Node]:
    """Fills in the counts from the leaves up; returns the nodes in page order."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(x for x in reversed(node.items) if isinstance(x, _Node) and not x.dropped)
    for node in reversed(order):
        own = sum(len(_SPACE.sub(" ", html.unescape(x)).strip()) for x in node.items if isinstance(x, str) and not x.isspace())
        kids = [x for x in node.items if isinstance(x, _Node) and not x.dropped]
        node.chars = own + sum(k.chars for k in kids)
        node.tags = len(kids) + sum(k.tags for k in kids)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        else:
            node.link_chars, node.link_tags = sum(k.link_chars for k in kids), sum(k.link_tags for k in kids)
    body_links, body_chars = root.link_chars, root.chars
    for node in reversed(order):
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, node.link_tags
        if not c:
            continue
        plain = max(c - lc, 1)
        # link-adjusted: the base of the logarithm grows with the node's and the page's share of link text
        base = math.log(c / plain * lc + (body_links / body_chars) * c + math.e)
        weight = (c / max(lc, 1)) * (t / max(lt, 1))
        node.density = c / t * math.log(max(weight, 1.0) + 1e-9) / max(math.log(base + 1e-9), 1e-9) if base > 1.0001 else c / t * math.log(max(weight, 1.0) + 1e-9)
        node.total = sum(k.density for k in node.items if isinstance(k, _Node) and not k.dropped)
        if any(isinstance(x, str) and not x.isspace() for x in node.items):
            node.total += node.density
    return order


def main_node(root: _Node) -> _Node:
    order = _measure(root)
    body = next((x for x in order if x.tag == "body"), root)
    inside, todo = [], [body]
    while todo:  # in page order
        x = todo.pop()
        inside.append(x)
        todo.extend(k for k in reversed(x.items) if isinstance(k, _Node) and not k.dropped)
    densest = max(inside, key=lambda x: x.total)
    threshold, p = densest.density, densest
    while p is not None:  # the least density on the path from the body
        if p.chars:
            threshold = min(threshold, p.density)
        if p is body:
            break
        p = p.parent
    best = max((x for x in inside if x.density >= threshold), key=lambda x: x.total, default=densest)
    # the content's container: while the parent adds text of its own kind, it holds more of the same article
    while best is not body and best.parent is not None and best.tag not in ("article", "main", "body"):
        p = best.parent
        if p.dropped or p.chars and p.link_chars * 3 > p.chars or p.density < threshold:
            break
        best = p
    return best


def text_of(node: _Node) -> str:
    """The node's blocks, without clutter, joined by one space."""
    parts: list[str] = []
    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(html.unescape(x))
        elif x is None:
            parts.append(" ")
        elif not x.dropped or x is node:
            if x.tag in RAW:
                continue
            if x.tag in BLOCK:
                parts.append(" ")
                todo.append(None)
            todo.extend(reversed(x.items))
    return _SPACE.sub(" ", "".join(parts)).strip()


def extract(page: str | None) -> str:
    """The main text of one page."""
    return text_of(main_node(parse(page))) if page else ""


def _texts(pages: pa.Array) -> pa.Array:
    return pa.array([extract(x) for x in pages.to_pylist()], pa.string())


def extract_pages(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """pages without html_col, with out_col and n_chars; one row for each page. Only the page's source goes through Python; all
    other columns pass as they are, whatever their names and types."""
    others = [c for c in pages.columns if c not in (html_col, out_col, "n_chars")]
    p = packed(pages, html=F.col(html_col)).withColumn("extracted", F.arrow_udf(_texts, "string")("html"))
    return unpacked(p, others, **{out_col: F.col("extracted"), "n_chars": F.length("extracted").cast("long")})
