"""Main text of web pages by a minimum cut between content and boilerplate."""

from __future__ import annotations

import html
import math
import re
from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.base import arrow_type, by_batch, kind

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_STOP = re.compile(r"[.!?…。]['\"”’)\]]*(?:\s|$)")
#: elements whose text is no text of the page
RAW = frozenset("script style noscript template title textarea svg annotation annotation-xml iframe object canvas head select datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label map mark q ruby rp rt s samp small span strike strong sub "
    "sup time tt u var wbr br button math semantics mrow mi mo mn ms mtext mspace msup msub msubsup mfrac msqrt mroot mover munder munderover "
    "mmultiscripts mpadded mphantom mstyle menclose mtable mtr mtd".split()
)
#: an element of the key is ended by the start of one of these, up to an element of the scope
ENDED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"})} | {
    t: ({"td", "th"}, {"tr", "table"}) for t in ("td", "th")
}
#: what an element says about the text inside, in log odds of content
TAGS = {
    "nav": -12.0, "footer": -12.0, "aside": -10.0, "form": -12.0, "menu": -12.0, "dialog": -12.0, "button": -12.0, "label": -6.0, "fieldset": -12.0,
    "header": -8.0, "article": 4.0, "main": 3.0, "address": -3.0, "figcaption": -0.5,
}
ROLES = {
    "navigation": -12.0, "banner": -8.0, "contentinfo": -12.0, "complementary": -10.0, "search": -12.0, "alert": -10.0, "dialog": -12.0,
    "alertdialog": -12.0, "menu": -12.0, "menubar": -12.0, "main": 3.0, "article": 2.0,
}
BAD = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar sidebar side "
    "aside widget widgets related recommended recommendations trending popular share sharing social follow cookie cookies consent gdpr notice notices "
    "alert alerts warning announcement popup modal overlay newsletter subscribe subscription signup login signin register breadcrumb breadcrumbs "
    "pagination pager footer foot header masthead topbar toolbar copyright legal disclaimer comment comments reply replies respond discussion disqus "
    "responses feedback form search tags tagcloud toc skip hidden".split()
)
#: so are longer names that begin like this
BAD_STEMS = ("comment", "advert", "sponsor", "cookie", "newsletter", "breadcrumb", "footer", "sidebar", "disqus", "navbar", "subscri", "recommend")
#: words for a part of a page, behind what the part is for
PARTS = frozenset(
    "area bar bars block blocks body bottom box boxes btn button buttons card cards cell center col column columns container content count cta desc "
    "details div element entry field fields frame grid group head heading icon icons image img inner input item items label layer layout left line "
    "link links list main menu meta module name node outer overlay page pane panel part placeholder post primary region right row rows secondary "
    "section sections slot slots space strip tab tabs text title toggle top unit units view wrap wrapper zone the and our by us you more site".split()
)
GOOD = frozenset("article content post entry story body text main prose blog".split())
#: an article may be called anything but these
NEVER = frozenset("comment comments reply replies ad ads advert advertisement sponsored promo".split())
BAD_NAME, GOOD_NAME = -10.0, 2.0
#: smoothness of neighbours on the page, over their distance in the tree, and of the next block below the same element
NEXT_TO, SAME_PARENT = 1.5, 0.8


def _is_bad(name: list[str]) -> bool:
    """Whether a class or id names boilerplate: its last word does, or an earlier one does and only words for parts of
    a page follow.  So ``site-footer`` and ``footer-links`` do, ``legal-guide`` and ``alert-free-travel`` don't."""
    for i, w in enumerate(name):
        if (w in BAD or w.startswith(BAD_STEMS)) and all(x in PARTS or x in BAD or x.isdigit() or len(x) == 1 for x in name[i + 1 :]):
            return True
    return False


@dataclass
class Block:
    text: str
    words: int
    linked: float
    element: int
    heading: str


class Page:
    """The blocks of a page in order and the elements they stand in."""

    def __init__(self, source: str):
        self.parent, self.tag, self.belief, self.inside = [-1], ["#"], [0.0], [False]
        self.blocks: list[Block] = []
        self.stack = [0]
        self.text: list[str] = []
        self.link_chars = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at = 0
        for m in _MARKUP.finditer(source):
            if m.start() < at:
                continue
            self._add(source[at : m.start()])
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if not tag:
                if m[0].startswith("<![CDATA["):
                    self._add(m[0][9:].removesuffix("]]>"))
                continue
            tag = tag.lower()
            if m["end"] or m["end2"]:
                self._end(tag)
                continue
            attrs = m["attrs"] or ""
            if tag in RAW:
                if tag == "head":  # the others may stand inside a block
                    self._flush()
                if tag == "head" or attrs.endswith("/"):
                    if tag == "head":
                        stop = re.compile(r"</head\s*>|<body\b", re.I).search(source, at)
                        at = (stop.end() if stop and stop[0][1] == "/" else stop.start()) if stop else at
                    continue
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = stop.end() if stop else len(source)
                continue
            self._start(tag, attrs)
        self._add(source[at:])
        self._flush()

    def _add(self, text: str) -> None:
        if text:
            self.text.append(text)
            if not text.isspace() and any(self.tag[e] == "a" for e in self.stack[-4:]):
                self.link_chars += len(text)

    def _flush(self) -> None:
        if not self.text:
            return
        words = html.unescape("".join(self.text)).split()
        if words:
            text = " ".join(words)
            element = next(e for e in reversed(self.stack) if self.tag[e] not in INLINE)
            heading = next((self.tag[e] for e in reversed(self.stack) if self.tag[e] in ("h1", "h2", "h3", "h4", "h5", "h6")), "")
            # a block that one inline element covers belongs to that element
            held = self.stack[-1] if self.stack[-1] != element and self.belief[self.stack[-1]] < self.belief[element] else element
            self.blocks.append(Block(text, len(words), min(1.0, self.link_chars / len(text)), held, heading))
        self.text, self.link_chars = [], 0

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "br" or tag in VOID:
            if tag not in INLINE:
                self._flush()
            elif tag == "br":
                self.text.append(" ")
            return
        if tag not in INLINE:
            self._flush()
            if tag in ENDED:
                ended, scope = ENDED[tag]
                self._close(ended, scope)
            else:
                self._close({"p"}, {"table", "td", "th", "button", "article", "section", "div", "li"})
        up = self.stack[-1]
        inside = self.inside[up] or tag in ("article", "main")
        belief = self.belief[up] + self._opinion(tag, attrs, self.inside[up])
        self.parent.append(up)
        self.tag.append(tag)
        self.belief.append(belief)
        self.inside.append(inside)
        if not attrs.endswith("/"):
            self.stack.append(len(self.tag) - 1)

    def _close(self, ended: set[str], scope: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            name = self.tag[self.stack[i]]
            if name in ended:
                del self.stack[i:]
                if len(ended) == 1:
                    return
                continue
            if name in scope:
                return

    def _end(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        for i in range(len(self.stack) - 1, 0, -1):
            name = self.tag[self.stack[i]]
            if name == tag:
                del self.stack[i:]
                return
            if tag in INLINE and name not in INLINE:
                return

    def _opinion(self, tag: str, attrs: str, inside: bool) -> float:
        out = TAGS.get(tag, 0.0)
        if tag == "header" and inside:
            out = 0.0
        if "=" not in attrs and "hidden" not in attrs or tag in ("html", "body"):
            return out
        names: set[str] = set()
        bad = False
        for key, *values in _ATTR.findall(attrs):
            key, value = key.lower(), "".join(values)
            if key in ("class", "id", "itemprop"):
                for name in value.split():
                    words = [x.lower() for x in _TOKEN.findall(name)]
                    names.update(words)
                    bad = bad or _is_bad(words)
            elif key == "role":
                out += ROLES.get(value.lower(), 0.0)
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                out -= 12.0
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                out -= 12.0
        if tag in ("article", "main"):
            return out + (BAD_NAME if names & NEVER else 0.0)
        if bad and not names & {"with", "has", "no"}:
            if not (inside and names & {"header"} and not names & (BAD - {"header"})):
                out += BAD_NAME
        elif names & GOOD:
            out += GOOD_NAME
        return out

    def distance(self, a: int, b: int) -> int:
        """Steps in the tree between two elements."""
        seen, n = {}, 0
        while a >= 0:
            seen[a], a, n = n, self.parent[a], n + 1
        n = 0
        while b not in seen:
            b, n = self.parent[b], n + 1
        return n + seen[b]


def content_odds(page: Page, block: Block) -> float:
    """The classifier: log odds that a block is content, from the elements around it and its own text."""
    odds = page.belief[block.element] - 0.6
    odds += min(2.5, 0.6 * math.log1p(block.words)) + (0.5 if _STOP.search(block.text) else 0.0)
    odds -= 4.0 * block.linked * (block.linked > 0.3)
    return odds + {"": 0.0, "h1": 1.0}.get(block.heading, 0.3)


def minimum_cut(terminals: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node stays with the source.

    ``terminals`` are capacities from the source (positive) or to the sink (negative), ``edges`` capacities both ways.
    Flow is sent along shortest paths in phases; the source side is what residual capacity still reaches.
    """
    n = len(terminals)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(forth)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for v, c in enumerate(terminals):
        if c > 0:
            join(s, v, c, 0.0)
        elif c < 0:
            join(v, t, -c, 0.0)
    for a, b, c in edges:
        join(a, b, c, c)
    while True:
        level, queue = {s: 0}, deque([s])
        while queue:
            v = queue.popleft()
            for e in out[v]:
                if cap[e] > 1e-9 and to[e] not in level:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if t not in level:
            return [v in level for v in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        v = s
        while True:
            if v == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                first = next(i for i, e in enumerate(path) if cap[e] <= 1e-9)
                v = to[path[first] ^ 1]
                del path[first:]
                continue
            while turn[v] < len(out[v]):
                e = out[v][turn[v]]
                if cap[e] > 1e-9 and level.get(to[e], -1) == level[v] + 1:
                    break
                turn[v] += 1
            if turn[v] < len(out[v]):
                path.append(out[v][turn[v]])
                v = to[path[-1]]
            elif v == s:
                break
            else:
                v = to[path.pop() ^ 1]
                turn[v] += 1


def graph_of(page: Page) -> tuple[list[float], list[tuple[int, int, float]]]:
    blocks = page.blocks
    edges = []
    latest: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEXT_TO / max(1, page.distance(blocks[i - 1].element, b.element))))
        up = page.parent[b.element]
        if up in latest and latest[up] < i - 1:
            edges.append((latest[up], i, SAME_PARENT))
        latest[up] = i
    return [content_odds(page, b) for b in blocks], edges


def main_text(source: str | None) -> str:
    page = Page(source or "")
    keep = minimum_cut(*graph_of(page))
    return "\n".join(b.text for b, k in zip(page.blocks, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A page is read into blocks, the text between the starts and ends of block elements with character references
    decoded and white space made one space.  What the elements around a block are and are called, its length, sentences and
    links give log odds of content, which are its capacity to the source or the sink.  Blocks that follow each other,
    the more the nearer in the tree, and blocks under one element are joined by smoothness edges.  The minimum cut parts content
    from boilerplate; content blocks are joined by line feeds in page order.

    A line break inside a block counts as white space.  Null and empty pages, and pages without content, give an empty text.
    Repeated rows each give their row; other columns are not read.  A page is worked on alone, so nothing is shuffled.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    columns = {"page_id": arrow_type(rows.schema["page_id"].dataType), "url": arrow_type(rows.schema["url"].dataType), "text": pa.string(), "n_chars": pa.int64()}

    def read(batch: pa.RecordBatch) -> dict:
        texts = [main_text(x) for x in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": list(map(len, texts))}

    found = rows.mapInArrow(by_batch(columns, read), f"page_id {kind(rows, 'page_id')}, url {kind(rows, 'url')}, text string, n_chars bigint")
    return found.withColumnsRenamed({"page_id": id_col, "url": url_col})
