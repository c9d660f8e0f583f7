"""Main text of web pages by a minimum cut.

A page becomes a row of text blocks. A linear classifier over each block's words, links,
punctuation and the names of its enclosing elements gives the cost of calling it content
or boilerplate; these costs are the capacities to the two terminals. Neighbouring blocks,
and blocks close together in the element tree, are tied by smoothness edges. A name that marks
boilerplate is bounded evidence, and none where its element holds most of the page's text and
title (or, for names of wrappers, most of a long text). The minimum cut, found by max-flow, labels all blocks of the page at once.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerlake.llm.common import steps

# Element and attribute names of HTML and common page templates.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select"
    " summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
HIDDEN_TAGS = frozenset("head script style template noscript iframe object svg math canvas audio video textarea select button title datalist noembed noframes".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog search fieldset".split())
MAIN_TAGS = frozenset("article main".split())
BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox adslot banner billboard breadcrumb breadcrumbs byline comment comments"
    " commentlist consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu menubar modal nav navbar navigation"
    " newsletter notice notification outbrain overlay pager pagination paywall popup privacy promo promotion recommended related reply"
    " replies respond sharing share sidebar sidebars signup skyscraper social sponsor sponsored subscribe subscription taboola tags toolbar"
    " topbar widget widgets alert warning toast".split()
)
#: Marks that also name wrappers of whole pages; READER_NAMES never do.
WRAPPER_TAGS = frozenset("form fieldset header".split())
WRAPPER_NAMES = frozenset("banner billboard form header masthead modal overlay toolbar topbar widget widgets".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
READER_NAMES = frozenset("ad advert advertisement comment comments promo related reply replies sponsored".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
MAIN_NAMES = frozenset("article articlebody content entry main maincontent post postbody story text body".split())
CLOSES_P = BLOCK_TAGS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup"}
SAME_CLOSES = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}

_TOKEN = re.compile(r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(class|id|role|itemprop|hidden|style|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_ABOUT = re.compile(r"(?:has|have|no|not|with|without|is|hide|show)[-_]", re.I)  # tells about the page, not the element
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")

#: Weights of the classifier, in log-odds of content.
WEIGHTS = {
    "bias": -0.4,
    "words": 0.10,  # for each word, up to 30
    "stops": 0.8,  # a sentence's end
    "links": -4.0,  # share of the characters inside links
    "heading": 0.6,
    "paragraph": 0.6,
    "item": -0.4,
    "main": 3.0,  # inside an article or main element
    "main_name": 1.0,
    "boiler": -7.0,  # inside an element or a name that marks boilerplate; half as much more for each further level
    "copyright": -3.0,
}
#: Words that a wrapper must hold to count as the page's text when it holds no title.
ENOUGH_WORDS = 50
SMOOTH_NEXT, SMOOTH_SIBLING = 0.9, 0.5
_SCALE = 1000


class _Node:
    """An element: what it says itself while parsing, what it inherits after ``_resolve``."""

    __slots__ = ("tag", "parent", "mark", "main", "hidden", "named", "number", "levels", "words", "title")

    def __init__(self, tag: str, parent: _Node | None, attributes: str, number: int):
        self.tag, self.parent, self.number = tag, parent, number
        self.levels, self.words, self.title = 0, 0, False
        self.hidden = bool(parent and parent.hidden) or tag in HIDDEN_TAGS
        self.main, self.named = tag in MAIN_TAGS, False
        self.mark = ""  # none, wrapper, strong or reader
        if tag in WRAPPER_TAGS:
            self.mark = "wrapper"
        elif tag in BOILER_TAGS:
            self.mark = "strong"
        if not attributes or tag in ("html", "body"):
            return
        for name, a, b, c in _NAMES.findall(attributes):
            name, value = name.lower(), html.unescape(a or b or c)
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                self.hidden = True
            elif name == "role":
                if value.lower() in BOILER_ROLES:
                    self._add(frozenset([value.lower()]))
                self.main |= value.lower() in ("main", "article")
            elif name in ("class", "id", "itemprop"):
                own = [x for x in value.split() if not _ABOUT.match(x)]
                parts = {x.lower() for x in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", " ".join(own))}
                marks = parts & (READER_NAMES if tag in MAIN_TAGS else BOILER_NAMES)
                if not any(x.lower().startswith("widget") for x in own):
                    marks -= {"widget", "widgets"}  # a page builder calls every part a widget
                self._add(marks)
                self.named |= bool(parts & MAIN_NAMES) or value.lower() in MAIN_NAMES

    def _add(self, marks: frozenset[str] | set[str]) -> None:
        if marks & READER_NAMES:
            self.mark = "reader"
        elif marks - WRAPPER_NAMES and self.mark != "reader":
            self.mark = "strong"
        elif marks and not self.mark:
            self.mark = "wrapper"

    @property
    def boiler(self) -> bool:
        return self.levels > 0


def _holds_the_page(node: _Node, words: int) -> bool:
    """A marked element around most of the page's text: its name says nothing about that text."""
    if node.mark == "reader" or 2 * node.words <= words:
        return False
    return node.title or (node.mark == "wrapper" and node.words >= ENOUGH_WORDS)


def _resolve(nodes: list[_Node], blocks: list[tuple[str, _Block]]) -> None:
    """Levels of marks around each element, and whether it lies in the main part.

    Words outside links and the page's first title of the highest rank are counted for every
    element, children before parents; then marks go down from parents to children.
    """
    titles = [b.node for _, b in blocks if b.node.tag in HEADINGS]
    for text, block in blocks:
        if 2 * block.linked < len(text):
            block.node.words += len(_WORD.findall(text))
    if titles:
        min(titles, key=lambda n: n.tag).title = True
    for node in reversed(nodes[1:]):
        node.parent.words += node.words
        node.parent.title |= node.title
    total = nodes[0].words
    for node in nodes[1:]:
        up = node.parent
        titled = node.mark == "wrapper" and (up.main or up.named) and node.title
        marked = bool(node.mark) and not titled and not _holds_the_page(node, total)
        node.levels = up.levels + marked
        node.main = (node.main or up.main) and not node.levels
        node.named |= up.named


class _Block:
    __slots__ = ("parts", "linked", "node", "parent", "inline")

    def __init__(self, node: _Node, parent: int):
        self.parts: list[str] = []
        self.linked, self.node, self.parent = 0, node, parent
        self.inline: _Node | None = None  # a marked inline element around all of the text so far


def _inside(stack: list[_Node]) -> Iterator[_Node]:
    """The inline elements around the current place, outermost first, inside its block."""
    first = len(stack)
    while first and stack[first - 1].tag not in BLOCK_TAGS:
        first -= 1
    return iter(stack[first:])


def _blocks(page: str) -> list[tuple[str, _Block]]:
    """Visible text blocks in page order, white space made single."""
    root = _Node("html", None, "", 0)
    nodes, stack, blocks, current, links, at = [root], [root], [], None, 0, 0

    def text(raw: str) -> None:
        nonlocal current
        if not raw or stack[-1].hidden:
            return
        if current is None:
            holder = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag in BLOCK_TAGS), 0)
            current = _Block(stack[holder], stack[max(0, holder - 1)].number)
            blocks.append(current)
        value = html.unescape(raw)
        if value.strip():
            inline = next((x for x in _inside(stack) if x.mark), None)
            if not any(x.strip() for x in current.parts):
                current.inline = inline
            elif current.inline is not inline:
                current.inline = None
        current.parts.append(value)
        if links:
            current.linked += len(value.strip())

    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            text(" ")
            continue
        if found[1]:  # an end tag
            if tag == "a":
                links = max(0, links - 1)
            if tag in BLOCK_TAGS:
                current = None
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if place and (tag in BLOCK_TAGS or not any(x.tag in BLOCK_TAGS for x in stack[place + 1 :])):
                del stack[place:]
            continue
        if tag in BLOCK_TAGS:
            current = None
        if tag in CLOSES_P:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
            if place:
                del stack[place:]
        if tag in SAME_CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SAME_CLOSES[tag]:
                    break
                if stack[i].tag == tag or {stack[i].tag, tag} in ({"dt", "dd"}, {"td", "th"}):
                    del stack[i:]
                    break
        if tag in VOID_TAGS or found[3].endswith("/") and tag not in BLOCK_TAGS | RAW_TAGS:
            continue
        if tag in RAW_TAGS:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "a":
            links += 1
        nodes.append(_Node(tag, stack[-1], found[3], len(nodes)))
        stack.append(nodes[-1])
    out = []
    for block in blocks:
        value = _SPACE.sub(" ", "".join(block.parts)).strip()
        if value:
            block.node = block.inline or block.node
            out.append((value, block))
    _resolve(nodes, out)
    return out


def _score(text: str, block: _Block, any_main: bool) -> float:
    """Log-odds that a block is content."""
    node, w = block.node, WEIGHTS
    words = len(_WORD.findall(text))
    score = w["bias"] + w["words"] * min(words, 30) + w["links"] * min(1.0, block.linked / len(text))
    score += w["stops"] * (text[-1] in ".!?…:\"'»”。！？" and words > 2)
    score += w["heading"] * (node.tag in (*HEADINGS, "hgroup"))
    score += w["paragraph"] * (node.tag in ("p", "blockquote", "pre")) + w["item"] * (node.tag in ("li", "option"))
    score += (w["main"] if node.main else -w["main"]) * any_main
    score += w["main_name"] * node.named + w["boiler"] * (2 - 2 ** (1 - min(node.levels, 30)))
    return score + w["copyright"] * ("©" in text)


def _content_side(gains: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Minimum cut: ``gains`` above 0 tie a block to the source, below 0 to the sink."""
    n = len(gains)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, gain in enumerate(gains):
        link(source, i, gain, 0) if gain > 0 else link(i, sink, -gain, 0)
    for a, b, capacity in edges:
        link(a, b, capacity, capacity)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                full = next(i for i, e in enumerate(path) if not room[e])
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while tried[a] < len(out[a]):
                e = out[a][tried[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                tried[a] += 1
            else:
                if a == source:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]
                continue
            path.append(e)
            a = to[e]


def labelled(page: str) -> list[tuple[str, bool]]:
    """Every visible block of a page with its label: True for content."""
    found = _blocks(page)
    if not found:
        return []
    any_main = any(b.node.main for _, b in found)
    gains = [round(_score(t, b, any_main) * _SCALE) for t, b in found]
    edges = []
    last_of: dict[int, int] = {}
    for i, (_, block) in enumerate(found):
        alike = i and found[i - 1][1].node.boiler == block.node.boiler and found[i - 1][1].node.main == block.node.main
        if i:
            edges.append((i - 1, i, round(SMOOTH_NEXT * _SCALE) if alike else round(SMOOTH_NEXT * _SCALE) // 4))
        near = last_of.get(block.parent)
        if near is not None:
            edges.append((near, i, round(SMOOTH_SIBLING * _SCALE)))
        last_of[block.parent] = i
    return [(t, keep) for (t, _), keep in zip(found, _content_side(gains, edges))]


def main_text(page: str | None) -> str:
    """Content blocks of a page joined by line ends; empty for null or no content."""
    return "\n".join(t for t, keep in labelled(page or "") if keep)


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` without ``page``, with ``text`` and its length ``n_chars`` in code points.

    A null, empty or text-free page gives an empty text; unclosed or stray markup is read
    to its end; the longest page is read whole. Repeated rows stay; columns named text or
    n_chars are replaced, others pass through. An empty table gives no row.
    """
    kept = [c for c in pages.columns if c not in (page, "text", "n_chars")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, page):
            texts = [main_text(x) for x in batch.column(page).to_pylist()]
            columns = [batch.column(c) for c in kept] + [pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "text", "n_chars"])

    fields = [*pages.select(*kept).schema.fields, StructField("text", StringType()), StructField("n_chars", LongType())]
    return pages.select(*kept, F.col(page)).mapInArrow(work, StructType(fields))


def op1_html_mincut(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html"))
