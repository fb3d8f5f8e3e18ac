"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into text blocks with the open elements around each. A linear classifier gives every block a cost: the
shape of its text (links, length, punctuation) and three features of the markup around it (a layout part, a heading outside
the content, a notice, form, comment or the like), all with weights fitted on a bounded sample of pages that mark their
article, and what the page itself marks as content. The cost becomes two terminal capacities: what it costs to call the
block content or boilerplate. Edges join blocks that follow each other, weaker the further apart they are in the tree, and
blocks with the same parent element. The maximum flow gives the cheapest labelling; what stays connected to the source is
content. Shape is bounded so that it weighs about as much as the edges of a block: on a page without marks the
neighbours decide about a short line among paragraphs, or a long one among links.

An element that holds the content is never boilerplate, whatever it is called: the content is the marked element with the
most text, or, without any mark, what holds ``WRAPPER`` of the text of the page. Words in class and id that tell a state
(``comments-open``, ``has-cookie-notice``) don't name a part.

Output: character references decoded, white space inside a block as one space, blocks trimmed and joined in page
order by a line feed. Script, style, comments, title and form controls have no text, and skipped ones last to their end tag
or the end of the page; svg and math that end in /> are empty. A head needs no end tag: only its elements are skipped.

Each page is one row of an Arrow batch; nothing is shuffled. The graph has an edge or two per block, so memory and
time grow with the page.

Cases: null or empty html, or a page without text: empty text, 0 characters; unclosed or stray tags: an open paragraph
ends at the next block, a stray end tag is ignored, whatever is open ends with the page; repeated rows give
equal rows; an empty table gives no rows; a null url stays null; further columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import sample_by_hash, ship

SAMPLE_PAGES = 300
ADJACENT = 1.0  # capacity between blocks that follow each other under one parent
SIBLING = 0.5   # capacity between blocks of one parent that don't follow each other
SHAPE_LIMIT = 2.5           # what the shape of a text may weigh
INSIDE, OUTSIDE = 3.0, -4.5  # what the page's own mark of its content weighs, in it and elsewhere
PART_RANGE = (-6.0, -3.0)   # what the fitted weight of a part of the markup may be
WRAPPER = 0.8               # part of a page's text from which on an element of a page without marks holds the content

# Elements that start a block, elements without text of the page, and hints in the markup.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre section select "
    "summary table tbody td textarea tfoot th thead tr ul".split())
SILENT_TAGS = "script style noscript template svg math iframe object canvas audio video title select textarea".split()
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
CONTENT_TAGS = frozenset("article main".split())
LAYOUT_TAGS = frozenset("nav footer aside menu".split())
STRONG_TAGS = frozenset("form button dialog label fieldset legend option".split())
CONTENT_ROLES = frozenset("main article".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
CONTENT_WORDS = frozenset("article articlebody content main post entry story".split())
LAYOUT_WORDS = frozenset(
    "aside banner bottombar breadcrumb breadcrumbs foot footer masthead menu nav navbar navigation pager "
    "pagination rail search side sidebar toolbar topbar widget widgets".split())
HEADING_WORDS = frozenset("head header heading".split())
STRONG_WORDS = frozenset(
    "ad ads adsbygoogle adsense adslot adunit advert advertisement adverts alert comment comments commentlist consent cookie cookies copyright disclaimer "
    "discussion disqus gdpr login modal newsletter notice notification overlay popup promo promotion recommended related "
    "replies reply respond share sharing signup skip social sponsor sponsored subscribe subscription tagcloud toast "
    "trending warning".split())

STATE_WORDS = frozenset("closed disabled enabled has have is no none not off on open with without".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<empty>svg|math)(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<=/)>"
    r"|<(?P<silent>" + "|".join(SILENT_TAGS) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=silent)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[!?/][^>]*>", re.DOTALL | re.IGNORECASE)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|style|aria-hidden|itemprop)(?=[\s=>]|$)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Element:
    __slots__ = ("tag", "parent", "depth", "content", "layout", "strong", "heading", "size", "holds_content")

    def __init__(self, tag: str, attrs: str, parent: Element | None):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.content = tag in CONTENT_TAGS
        self.layout = tag in LAYOUT_TAGS
        self.strong = tag in STRONG_TAGS
        self.heading = tag == "header"
        self.size, self.holds_content = 0, False
        if attrs.strip() and tag not in ("html", "body"):
            for name, value in _ATTR.findall(attrs):
                name, value = name.lower(), value.strip("\"'")
                if name in ("class", "id"):
                    words: set[str] = set()
                    for token in value.split():
                        parts = set(_WORD.findall(_CAMEL.sub(" ", token).lower()))
                        if not parts & STATE_WORDS:
                            words |= parts
                    self.layout |= bool(words & LAYOUT_WORDS)
                    self.strong |= bool(words & STRONG_WORDS)
                    self.heading |= bool(words & HEADING_WORDS)
                    self.content |= bool(words & CONTENT_WORDS) and not (self.layout or self.strong or self.heading)
                elif name == "role":
                    self.content |= value.lower() in CONTENT_ROLES
                    self.layout |= value.lower() in BOILERPLATE_ROLES
                elif name == "itemprop":
                    self.content |= value.lower() == "articlebody"
                elif name == "style":
                    self.strong |= bool(_HIDDEN.search(value))
                else:
                    self.strong |= name == "hidden" or value.lower() == "true"
        self.content &= not self.strong

    def path(self) -> Iterator[Element]:
        e: Element | None = self
        while e is not None:
            yield e
            e = e.parent


class Block:
    __slots__ = ("text", "linked", "element")

    def __init__(self, text: str, linked: int, element: Element):
        self.text, self.linked, self.element = text, linked, element


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    root = Element("", "", None)
    open_, links = root, 0
    pieces: list[str] = []
    linked_chars = 0
    out: list[Block] = []

    def flush() -> None:
        nonlocal linked_chars
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, linked_chars, open_))
            pieces.clear()
        linked_chars = 0

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at:m.start()]
            pieces.append(piece)
            if links:
                linked_chars += len(piece.strip())
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            if m["silent"] or m["empty"]:
                pieces.append(" ")
            continue
        closing = m["close"] or m["close2"]
        if tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            pieces.append(" ")
        elif tag in BLOCK_TAGS:
            flush()
            if closing:
                match = next((e for e in open_.path() if e.tag == tag), None)
                if match is not None and match.parent is not None:
                    open_ = match.parent
                continue
            if open_.tag == "p" or open_.tag in CLOSES.get(tag, ()):
                open_ = open_.parent or root
                while open_.tag in CLOSES.get(tag, ()):
                    open_ = open_.parent or root
            if tag not in VOID_TAGS:
                open_ = Element(tag, m["attrs"] or m["attrs2"] or "", open_)
    if at < len(page):
        pieces.append(page[at:])
    flush()
    _find_content(out)
    return out


def _find_content(blocks: list[Block]) -> None:
    """Note in the elements which of them hold the content of the page."""
    total, marked = 0, None
    for b in blocks:
        own = max(0, len(b.text) - b.linked)
        total += own
        for e in b.element.path():
            e.size += own
    for b in blocks:
        for e in b.element.path():  # from the inside out: of equal sizes the outermost
            if e.content and (marked is None or e.size >= marked.size):
                marked = e
    if marked is not None:
        for e in marked.path():
            e.holds_content = True
    elif total:
        for b in blocks:
            for e in b.element.path():
                e.holds_content = e.size >= WRAPPER * total


def parts(block: Block) -> list[float]:
    """Features of the markup around a block: in a layout part, in a heading outside the content, in a notice, form, comment or
    the like. What holds the content is none of them."""
    layout = heading = strong = False
    for e in block.element.path():
        if not e.holds_content:
            layout |= e.layout
            heading |= e.heading and not _in_content(e)
            strong |= e.strong
        elif e.content:
            strong |= e.strong
    return [float(layout), float(heading), float(strong)]


def _is_marked(blocks: list[Block]) -> bool:
    return any(e.content for b in blocks for e in b.element.path() if e.parent is not None)


def _in_content(e: Element) -> bool:
    return any(p.content for p in e.path())


def shape(block: Block) -> list[float]:
    """Features of a block's text."""
    t = block.text
    words = t.split(" ")
    n = len(t)
    return [
        1.0,
        math.log1p(n) / 5,
        min(1.0, block.linked / n),
        sum(w[-1] in ".!?;:" for w in words) / len(words),
        math.log1p(len(words)) / 4,
        1.0 if "©" in t or "·" in t or "|" in t else 0.0,
        sum(map(str.isdigit, t)) / n,
        1.0 if block.element.tag in ("li", "td", "th", "dt", "dd") else 0.0,
    ]


# Weights of the shape and part features where no sample can be learned from.
PRIOR = np.array([-0.6, 0.8, -4.0, 1.0, 0.8, -1.5, -1.0, -0.5, -4.0, -4.0, -5.0])
_SHAPES = 8


def learn(pages: list[str], rounds: int = 12, ridge: float = 2.0) -> np.ndarray:
    """Weights of the features by ridge logistic regression (towards ``PRIOR``) on pages that mark their content; a block is
    content if it is inside and in no other part."""
    xs, ys = [], []
    for page in pages:
        blocks = blocks_of(page)
        if _is_marked(blocks):
            for b in blocks:
                part = parts(b)
                xs.append(shape(b) + part)
                ys.append(_in_content(b.element) and not any(part))
    if not xs or all(ys) or not any(ys):
        return PRIOR
    x, y, w = np.array(xs), np.array(ys, float), PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * (w - PRIOR)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), g)
    w[_SHAPES:] = np.clip(w[_SHAPES:], *PART_RANGE)
    return w


def costs(blocks: list[Block], weights: np.ndarray) -> np.ndarray:
    """What it costs to call each block boilerplate (or, negative, content)."""
    marked = _is_marked(blocks)
    looks = np.clip(np.array([shape(b) for b in blocks]) @ weights[:_SHAPES], -SHAPE_LIMIT, SHAPE_LIMIT)
    part = np.array([parts(b) for b in blocks])
    around = (part * weights[_SHAPES:]).min(axis=1)
    mark = np.array([0.0 if not marked or p.any() else INSIDE if _in_content(b.element) else OUTSIDE for b, p in zip(blocks, part)])
    return looks + around + mark


def graph(blocks: list[Block], weights: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
    """(cost per block, edges with capacities)."""
    score = costs(blocks, weights)
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        home = b.element.parent or b.element
        if i:
            edges.append((i - 1, i, ADJACENT * 0.5 ** max(0, _distance(blocks[i - 1].element, b.element) - 2)))
        j = last.get(id(home))
        if j is not None and j < i - 1:
            edges.append((j, i, SIBLING))
        last[id(home)] = i
    return score, edges


def _distance(a: Element, b: Element) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def minimum_cut(score: np.ndarray, edges: list[tuple[int, int, float]]) -> list[bool]:
    """Source side of a minimum cut: a positive score is a capacity from the source (lost if the node is cut off), a
    negative one to the sink; edges are undirected. Blocking flows on level graphs."""
    n = len(score)
    gain = [float(s) for s in score]
    if all(g > 0 for g in gain) or not any(g > 0 for g in gain):
        return [g > 0 for g in gain]
    to: list[int] = []
    cap: list[float] = []
    at: list[list[int]] = [[] for _ in range(n)]
    for u, v, c in edges:
        at[u].append(len(to))
        at[v].append(len(to) + 1)
        to += [v, u]
        cap += [c, c]
    eps = 1e-9
    while True:
        level = [0 if g > eps else -1 for g in gain]
        queue = deque(i for i in range(n) if level[i] == 0)
        reached = False
        while queue:
            u = queue.popleft()
            reached |= gain[u] < -eps
            for e in at[u]:
                if cap[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if not reached:
            return [k >= 0 for k in level]
        arc = [0] * n
        for s in range(n):
            while gain[s] > eps and level[s] == 0:
                path: list[int] = []
                u = s
                while gain[u] >= -eps:
                    while arc[u] < len(at[u]):
                        e = at[u][arc[u]]
                        if cap[e] > eps and level[to[e]] == level[u] + 1:
                            break
                        arc[u] += 1
                    if arc[u] < len(at[u]):
                        path.append(at[u][arc[u]])
                        u = to[path[-1]]
                    elif path:
                        u = to[path.pop() ^ 1]
                        arc[u] += 1
                    else:
                        break
                if gain[u] >= -eps:
                    break
                flow = min(gain[s], -gain[u], min((cap[e] for e in path), default=gain[s]))
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                gain[s] -= flow
                gain[u] += flow


def extract(page: str | None, weights: np.ndarray = PRIOR) -> str:
    """Main text of a page."""
    blocks = blocks_of(page) if page else []
    if not blocks:
        return ""
    score, edges = graph(blocks, weights)
    return "\n".join(b.text for b, keep in zip(blocks, minimum_cut(score, edges)) if keep)


def learned_weights(pages: DataFrame, column: str = "html") -> np.ndarray:
    """Weights from at most ``SAMPLE_PAGES`` whole pages, chosen by a hash."""
    picked = pages.where(F.col(column).isNotNull()).select(F.col(column).alias("h"), F.xxhash64(column).alias("k"))
    return learn([r.h for r in sample_by_hash(picked, "k", SAMPLE_PAGES)])


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    ship(pages.sparkSession)
    weights = learned_weights(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                texts = [extract(h.as_py(), weights) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.col("html").cast("string").alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")


# The same text from pages of one known layout (an <article> with <h1> and <p>), in DuckDB SQL.
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1),
                                               '\s+', ' ', 'g') AS body FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(body, '</?(p|h1)>', chr(10), 'g'),
                                          '<br>', ' ', 'g'), '<[^>]*>', '', 'g') AS body FROM a),
c AS (SELECT page_id, url, regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(body,
             '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#x27;', ''''), '&#39;', ''''), '&amp;?', '&', 'g')
             AS body FROM b),
d AS (SELECT page_id, url, array_to_string(list_filter(list_transform(string_split(body, chr(10)),
             lambda t: trim(regexp_replace(t, '\s+', ' ', 'g'))), lambda t: t <> ''), chr(10)) AS text FROM c)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM d
"""
