"""Main text of web pages by tag-path ratios.

Every text node has a path, the names (with classes) of the elements around it.  Text length and punctuation are
summed per path and divided by the path's nodes; both ratios are smoothed over the page in node order and multiplied.
Paths whose mean fused ratio reaches the threshold, ``spread`` standard deviations of the node scores, hold content, if
their ratios before smoothing reach half of it (where no path does, that is waived).

All nodes have ratios, those of menus and adverts too.  An element whose tag, class, id or role says that it is no
article (a side) only weighs less, by ``PRIOR``, and its nodes are left out at the end.  A side that holds the page
is none: where less than a tenth of the content stands outside of all sides, the outermost one with at least half of it
is taken for a wrapper, and so is any that holds the ``article`` with half of the content.

The article is what the ``article`` (or ``main``) elements hold, if that is half of the content; else the smallest
container around all content nodes.  Headings and short paragraphs of it belong to it; where no tag marks it, the
containers before and after all content, and lists made of links, do not.  One long paragraph is never the article.

Rows: a null or empty page has an empty text.  Broken markup is read on: an unknown end tag is ignored, an end tag
closes what is open inside it, a new paragraph or list item closes the one before.  A page without markup is its text.
Repeated rows are rows of their own; work is linear in the page's length, however deep its elements are nested.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template textarea title iframe svg math"
NEVER = frozenset((RAW + " head button select option label input object audio video canvas menu").split())
SIDES = frozenset("nav header footer aside form fieldset dialog".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("html body main article section div center td".split())
LISTS = frozenset("ul ol dl table".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote article main".split())
SIDE_NAMES = re.compile(
    r"(?:^|\s|(?<!no)(?<!has)(?<!with)(?<!without)[_-])(?:ads?|advert\w*|adbox|banner|sponsor\w*|promo\w*|cookie\w*|"
    r"consent|notice|popup|modal|newsletter|subscri\w*|nav\w*|menu\w*|breadcrumbs?|sidebar|side|aside|footer|header|"
    r"masthead|related|recommend\w*|share|social|comments?|discuss\w*|respond|reply|replies|disqus|widget|toolbar|"
    r"pagination|pager|login|signup|search|copyright|hidden)(?:$|[\s_-])",
    re.I)
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

#: Weight of a node's ratios inside a side.
PRIOR = 0.25

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW.split()) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、]")
#: A start tag of the key closes an open element of the value.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_BLOCKS_IN = frozenset("div section article main body ul ol dl table blockquote td th li".split())


class Element(NamedTuple):
    """An element; its number is its place in the page's list, so parents come before children."""

    parent: int
    name: str
    side: bool


class Node(NamedTuple):
    """A text node: its block, the number of its path, the number of the element around it, and whether it is a link."""

    block: int
    path: int
    element: int
    linked: bool
    text: str


def _role(name: str, attrs: str, in_article: bool) -> tuple[bool, bool, str]:
    """Whether an element is never read, whether its names make it a side, and its class names for the path."""
    if name in NEVER:
        return True, False, ""
    side = name in SIDES and not (name == "header" and in_article)
    classes = ""
    for key, a, b, c, hidden in _ATTRIBUTE.findall(attrs) if attrs.strip() else ():
        value, key = a or b or c, key.lower()
        if hidden or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            return True, False, ""
        side |= key == "role" and value.lower() in SIDE_ROLES
        side |= key in ("class", "id") and name not in ("body", "html", "main") and SIDE_NAMES.search(value) is not None
        if key == "class":
            classes = "." + ".".join(value.split())
    return False, side, classes


def read_page(page: str) -> tuple[list[Element], list[Node]]:
    """The page's elements, of which 0 is the page itself, and its text nodes, both in page order."""
    elements, nodes = [Element(0, "", False)], []
    paths: dict[tuple[int, str], int] = {}
    stack: list[tuple[str, int, int, bool, bool, bool]] = [("", 0, 0, False, False, False)]  # name, path, number, unread, link, in article
    opened: Counter[str] = Counter()
    block = at = 0

    def add(text: str) -> None:
        _, path, number, unread, linked, _ = stack[-1]
        plain = "" if unread else html.unescape(text)
        if plain:
            nodes.append(Node(block, path, number, linked, plain))

    def close(closes: set[str], within: frozenset[str]) -> None:
        if not any(opened[c] for c in closes):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in closes:
                opened.subtract(s[0] for s in stack[k:])
                del stack[k:]
                return
            if stack[k][0] in within:
                return

    for token in _TOKEN.finditer(page):
        if token.start() > at:
            add(page[at:token.start()])
        at = token.end()
        name = token["name"]
        if not name:
            continue
        name = name.lower()
        if name == "br":
            add(" ")
            continue
        if name not in INLINE:
            block += 1
        if token["end"]:
            close({name}, frozenset())
            continue
        if name in VOID or token["attrs"].rstrip().endswith("/"):
            continue
        if name in _CLOSES:
            close(_CLOSES[name], _BLOCKS_IN)
        _, path, parent, unread, linked, in_article = stack[-1]
        never, side, classes = _role(name, token["attrs"], in_article)
        # Inline elements break no path: their text belongs to the block around them.
        if name not in INLINE:
            path = paths.setdefault((path, name + classes), len(paths) + 1)
        stack.append((name, path, len(elements), unread or never, linked or name == "a", in_article or name in ("article", "main")))
        opened[name] += 1
        elements.append(Element(parent, name, side))
    add(page[at:])
    return elements, nodes


def _smooth(values: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[reach:-reach]
    return np.convolve(values, kernel)[reach:-reach] / weight


def content_nodes(nodes: list[Node], weight: np.ndarray, sigma: float, spread: float) -> np.ndarray:
    """Whether each node stands on a content path; ratios are multiplied by the nodes' weights."""
    names = {p: k for k, p in enumerate(dict.fromkeys(n.path for n in nodes))}
    path = np.array([names[n.path] for n in nodes])
    length = np.array([len(n.text.strip()) for n in nodes], float)
    marks = np.array([len(_PUNCTUATION.findall(n.text)) for n in nodes], float)
    count = np.bincount(path)
    text_ratio = (np.bincount(path, length) / count)[path]
    mark_ratio = (np.bincount(path, marks) / count)[path]
    fused = _smooth(text_ratio, sigma) * (1.0 + _smooth(mark_ratio, sigma)) * weight
    of_path = np.bincount(path, fused * np.maximum(length, 1)) / np.bincount(path, np.maximum(length, 1))
    limit = min(spread * fused.std(), of_path.max())
    good = of_path >= limit
    # A short text beside a long one has its neighbour's smoothed ratios: its own must be half of the limit.
    own = good & ((np.bincount(path, length) / count) * (1.0 + np.bincount(path, marks) / count) >= limit / 2)
    return (own if own.any() else good)[path] & (length > 0)


def _inside(elements: list[Element], marked: set[int]) -> list[int]:
    """The outermost marked element around (or at) every element, -1 where there is none."""
    out: list[int] = []
    for k, e in enumerate(elements):
        above = out[e.parent] if k else -1
        out.append(above if above >= 0 else k if k in marked else -1)
    return out


def _sums(elements: list[Element], nodes: list[Node], amount: list[float]) -> list[float]:
    """What the nodes in every element amount to."""
    total = [0.0] * len(elements)
    for node, x in zip(nodes, amount):
        total[node.element] += x
    for k in range(len(elements) - 1, 0, -1):
        total[elements[k].parent] += total[k]
    return total


def _sides(elements: list[Element], nodes: list[Node], mass: list[float]) -> set[int]:
    """The elements that are sides by name and do not hold the page; ``mass`` is each node's content."""
    sides = {k for k, e in enumerate(elements) if e.side}
    if not sides:
        return sides
    held, everything = _sums(elements, nodes, mass), sum(mass)
    prose = [float(e.name in PROSE) for e in elements]
    articles = [held[k] if e.name == "article" and 2 * held[k] >= everything else 0.0 for k, e in enumerate(elements)]
    for k in range(len(elements) - 1, 0, -1):
        prose[elements[k].parent] += prose[k]
        articles[elements[k].parent] = max(articles[elements[k].parent], articles[k])
    wrappers = {k for k in sides if prose[k] and elements[k].name not in ("nav", "footer", "aside")}
    sides -= {k for k in wrappers if articles[k] and elements[k].name != "article"}
    # Outermost first, so every round gives up an element around or beside the next one.
    for k in sorted(k for k in wrappers & sides if 2 * held[k] >= everything):
        around = _inside(elements, sides)
        if 10 * sum(m for n, m in zip(nodes, mass) if around[n.element] < 0) >= everything:
            break
        sides.discard(k)
    return sides


def article_nodes(elements: list[Element], nodes: list[Node], sigma: float, spread: float) -> list[bool]:
    """Whether each node belongs to the article."""
    length = [float(len(n.text.strip())) for n in nodes]
    plain = content_nodes(nodes, np.ones(len(nodes)), sigma, spread)
    sides = _sides(elements, nodes, [x * c for x, c in zip(length, plain.tolist())])
    around = _inside(elements, sides)
    free = [around[n.element] < 0 for n in nodes]
    if not any(x for x, f in zip(length, free) if f):
        return [False] * len(nodes)
    weight = np.where(free, 1.0, PRIOR)
    chosen = (content_nodes(nodes, weight, sigma, spread) & np.array(free)).tolist()
    if not any(chosen):  # sides outweigh the rest: the paths outside of them are judged on their own
        some = [n for n, f in zip(nodes, free) if f]
        judged = iter(content_nodes(some, np.ones(len(some)), sigma, spread).tolist())
        chosen = [f and next(judged) for f in free]
    mass = [x * c for x, c in zip(length, chosen)]
    held, everything = _sums(elements, nodes, mass), sum(mass)
    for name in ("article", "main"):
        roots = {k for k, e in enumerate(elements) if e.name == name and held[k]}
        inside = _inside(elements, roots)
        if 2 * sum(m for n, m in zip(nodes, mass) if inside[n.element] >= 0) >= everything:
            return [f and inside[n.element] >= 0 for n, f in zip(nodes, free)]
    # Later numbers are deeper; the page itself, 0, holds everything.
    number = _sums(elements, nodes, [float(c) for c in chosen])
    root = max(k for k, e in enumerate(elements) if number[k] == number[0] and (k == 0 or e.name in CONTAINERS))
    inside = _inside(elements, {root})
    links = _sums(elements, nodes, [x * n.linked for x, n in zip(length, nodes)])
    texts = _sums(elements, nodes, length)
    lists = _inside(elements, {k for k, e in enumerate(elements) if k > root and not number[k] and 5 * links[k] > 3 * texts[k]
                               and e.name in CONTAINERS | LISTS})
    foreign = _inside(elements, {k for k, e in enumerate(elements) if k > root and not number[k] and e.name in CONTAINERS})
    places = [k for k, c in enumerate(chosen) if c]
    return [f and inside[n.element] >= 0 and lists[n.element] < 0 and (places[0] < k < places[-1] or foreign[n.element] < 0)
            for k, (n, f) in enumerate(zip(nodes, free))]


def main_text(page: str | None, sigma: float = 1.0, spread: float = 0.8) -> str:
    """The article of a page: its blocks in order, joined by one space."""
    elements, nodes = read_page(page or "")
    if not any(n.text.strip() for n in nodes):
        return ""
    blocks: dict[int, list[str]] = {}
    for node, good in zip(nodes, article_nodes(elements, nodes, sigma, spread)):
        if good:
            blocks.setdefault(node.block, []).append(node.text)
    parts = (" ".join("".join(texts).split()) for texts in blocks.values())
    return " ".join(p for p in parts if p)


def extract(pages: DataFrame, sigma: float = 1.0, spread: float = 0.8) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages(page_id, url, html)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, sigma, spread) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    columns = pages.select("page_id", "url", "html")
    schema = columns.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return columns.mapInArrow(run, schema)
