"""Main text of web pages by minimum-cut labelling.

A page becomes a sequence of blocks: text between tags that break lines, with the
elements around it. A fixed linear classifier over a block's surroundings, length,
punctuation and share of link text gives its evidence, positive for content. Evidence
becomes the capacity of an edge to one of two terminals; neighbours in the
page and neighbours within one containing element get smoothness edges, weaker the
more levels of the element tree lie between them. The minimum cut separates content
from boilerplate; it is found by maximum flow (Dinic), after labelling all blocks
whose evidence outweighs all their edges, whom no cut can move.

White space inside a block, ``<br>`` included, is one space; blocks are joined by a
line feed. A null or empty page has an empty text; null page_id and url pass through.
Unclosed comments, scripts and tags run to the end of the page. Each page is worked
on alone, in time and memory in proportion to its length also where elements are nested deeply;
repeated rows give repeated results. Empty tables give no rows. Of the input only the three
columns are read: others cannot clash.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quayside.llm.common import pick, steps, table

#: Elements whose content is no text of the page.
_RAW = "script|style|noscript|template|svg|math|canvas|iframe|object|select|textarea|title"
_TOKENS = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|<[!?/a-zA-Z][^>]*+(?:>|\Z)|[^<]++|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([\w-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

#: Elements that begin and end blocks; others stand within a line.
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a start tag of the same group closes.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("article aside body div footer form header main nav ol section table td th ul dl blockquote figure menu".split())

_BOILER_TAGS = frozenset("nav footer aside form button dialog menu fieldset label legend search summary".split())
_CONTENT_TAGS = frozenset("article main".split())
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus donate footer gdpr hidden login masthead menu modal nav navbar navigation newsletter notice notices notification overlay "
    "pager pagination paywall popup promo promoted promotion rail recommend recommended related replies reply respond share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toolbar topbar widget widgets".split()
)
_CONTENT_WORDS = frozenset("article articlebody content entry main post story".split())
_NAME = re.compile(r"[a-z]+")

#: Smoothness of blocks that follow each other, and of neighbours in one containing element.
ADJACENT, SIBLINGS = 1.0, 1.2


@dataclass(eq=False)
class _Element:
    tag: str
    boiler: bool  # it or an element around it
    content: bool
    block: _Element | None  # the innermost element around its text that makes blocks, itself included
    above: _Element | None  # of such an element, the next one around it
    depth: int


@dataclass(eq=False)
class Block:
    text: str
    evidence: float
    home: _Element | None
    links: list[tuple[int, float]] = field(default_factory=list)


class _Stack:
    """The open elements. Each scope counts the elements inside it by tag, so that no look for one passes over others
    that stay open: the work is in proportion to the elements, however deep they are nested."""

    def __init__(self):
        self.items: list[_Element] = []
        self.scopes: list[int] = []  # where scopes stand
        self.inside: list[dict[str, int]] = [{}]  # tags of the elements above each, and above none
        self.open: dict[str, int] = {}  # scopes by tag
        self.links = 0

    @property
    def top(self) -> _Element | None:
        return self.items[-1] if self.items else None

    def push(self, tag: str, boiler: bool, content: bool) -> None:
        top = self.top
        above = top.block if top else None
        new = _Element(tag, boiler or bool(top and top.boiler), content or bool(top and top.content), above, above, top.depth if top else 0)
        if tag in _BLOCK:
            new.block, new.depth = new, (above.depth if above else 0) + 1
        if tag in _SCOPES:
            self.scopes.append(len(self.items))
            self.inside.append({})
            self.open[tag] = self.open.get(tag, 0) + 1
        else:
            self.inside[-1][tag] = self.inside[-1].get(tag, 0) + 1
        self.links += tag == "a"
        self.items.append(new)

    def pop(self) -> _Element:
        e = self.items.pop()
        if e.tag in _SCOPES:
            self.scopes.pop()
            self.inside.pop()
            self.open[e.tag] -= 1
        else:
            self.inside[-1][e.tag] -= 1
        self.links -= e.tag == "a"
        return e

    def end(self, tag: str) -> None:
        """An end tag closes the innermost such element, and what is open inside it; no scope, unless it names one."""
        if self.open.get(tag) if tag in _SCOPES else self.inside[-1].get(tag):
            while self.pop().tag != tag:
                pass

    def shut(self, tags: set[str]) -> None:
        """Close all these elements up to the first scope that is none of them."""
        while self.items:
            if any(self.inside[-1].get(t) for t in tags):
                while self.pop().tag not in tags:
                    pass
            elif self.scopes and self.items[self.scopes[-1]].tag in tags:
                at = self.scopes[-1]
                while len(self.items) > at:
                    self.pop()
            else:
                return


@lru_cache(maxsize=4096)
def _surroundings(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool]:
    """Whether an element marks boilerplate, and whether it marks content."""
    boiler = tag in _BOILER_TAGS or (tag == "header" and not inside_article)
    content = tag in _CONTENT_TAGS
    if "=" in attributes:
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
        names = set(_NAME.findall(f"{found.get('class', '')} {found.get('id', '')}"))
        if tag not in ("body", "html"):
            style = found.get("style", "").replace(" ", "")
            page_head = "header" in names and not inside_article and not names & _CONTENT_WORDS
            boiler |= (bool(names & _BOILER_WORDS) or page_head) and tag not in _CONTENT_TAGS and tag not in ("h1", "h2")
            boiler |= found.get("role") in _BOILER_ROLES or found.get("aria-hidden") == "true"
            boiler |= "display:none" in style or "visibility:hidden" in style
        content |= bool(names & _CONTENT_WORDS) or found.get("role") in ("main", "article") or found.get("itemprop") == "articlebody"
    if "hidden" in attributes and re.search(r"\bhidden\b(?!\s*=\s*[\"']?false)", re.sub(r"""=\s*(?:"[^"]*"|'[^']*')""", "", attributes), re.I):
        boiler = True
    return boiler, content and not boiler


def evidence(text: str, link_chars: int, tag: str, boiler: bool, content: bool) -> float:
    """Positive for content. The weights were set by hand on the elements' meaning, not fitted."""
    n = len(text)
    score = -8.0 if boiler else 3.0 if content else 0.0
    score += {"p": 1.0, "pre": 1.0, "blockquote": 1.0, "h1": 1.0, "h2": 0.5, "h3": 0.5}.get(tag, 0.0)
    score += 0.5 if n >= 80 else -0.5 if n < 25 else 0.0
    score += 0.5 if re.search(r"[.!?:;…。！？]\W*$", text) else -0.3
    score -= 4.0 * link_chars / n
    if not content and re.match(r"(?:©|\(c\)|copyright\b)", text, re.I):
        score -= 3.0
    return score


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack = _Stack()
    parts: list[str] = []
    linked, head = 0, False  # characters inside links, of the block at hand

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                e = stack.top
                boiler, content, home = (e.boiler, e.content, e.block) if e else (False, False, None)
                out.append(Block(text, evidence(text, min(linked, len(text)), home.tag if home else "", boiler, content and not boiler), home))
            parts.clear()
        linked = 0

    for m in _TOKENS.finditer(page):
        tag = m[3]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                if not head:
                    parts.append(piece)
                    if stack.links:
                        linked += len(piece.strip())
            continue
        tag = tag.lower()
        if tag == "head":
            head = not m[2]
            continue
        if tag == "body":
            head = False
        if m[2]:
            if tag in _BLOCK:
                close()
            stack.end(tag)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK:
            close()
            head = False
            stack.shut(_CLOSES.get(tag, {"p"} if tag not in ("body", "html") else set()))
        if tag in _VOID:
            continue
        stack.push(tag, *_surroundings(tag, m[4], bool(stack.top and stack.top.content)))
    close()
    return out


def _apart(a: _Element | None, b: _Element | None) -> int:
    """Steps between two elements of the tree. Those of blocks that follow each other are as many as were closed and opened between."""
    steps = 0
    while a is not b:
        if b is None or (a is not None and a.depth >= b.depth):
            a = a.above
        else:
            b = b.above
        steps += 1
    return steps


def edges(of: list[Block]) -> None:
    """Smoothness edges: neighbours in the page, and the nearest earlier block with the same container."""
    last: dict[_Element | None, int] = {}
    for k, b in enumerate(of):
        pairs, container = {}, b.home.above if b.home else None
        if k:
            pairs[k - 1] = ADJACENT / max(1, _apart(of[k - 1].home, b.home))
        at = last.get(container)
        if at is not None:
            pairs[at] = pairs.get(at, 0.0) + SIBLINGS / max(1, _apart(of[at].home, b.home))
        for j, w in pairs.items():
            b.links.append((j, w))
            of[j].links.append((k, w))
        last[container] = k


def min_cut(gain: list[float], links: list[list[tuple[int, float]]]) -> list[bool]:
    """Which nodes lie on the content side of a minimum cut: ``gain`` is a node's capacity from the
    source (positive) or to the sink (negative), ``links`` are undirected edges."""
    gain, label = list(gain), [None] * len(gain)
    todo = deque(range(len(gain)))
    while todo:  # nodes that outweigh their edges; a labelled neighbour's edge joins the terminal
        k = todo.popleft()
        if label[k] is not None:
            continue
        open_ = sum(w for j, w in links[k] if label[j] is None)
        if abs(gain[k]) >= open_:
            label[k] = gain[k] > 0
            for j, w in links[k]:
                if label[j] is None:
                    gain[j] += w if label[k] else -w
                    todo.append(j)
    rest = [k for k in range(len(gain)) if label[k] is None]
    if rest:
        for k, side in zip(rest, _flow([gain[k] for k in rest], {k: i for i, k in enumerate(rest)}, [links[k] for k in rest])):
            label[k] = side
    return label


def _flow(gain: list[float], index: dict[int, int], links: list[list[tuple[int, float]]]) -> list[bool]:
    """Dinic's maximum flow; the nodes that the source still reaches."""
    n = len(gain)
    source, sink, eps = n, n + 1, 1e-9
    to, cap, out = [], [], [[] for _ in range(n + 2)]

    def add(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(there)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for k, g in enumerate(gain):
        if g > 0:
            add(source, k, g, 0.0)
        elif g < 0:
            add(k, sink, -g, 0.0)
        for j, w in links[k]:
            if index.get(j, -1) > k:
                add(k, index[j], w, w)
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if cap[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(n)]
        at, path, a = [0] * (n + 2), [], source
        while True:
            if a == sink:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                cut = next(i for i, e in enumerate(path) if cap[e] <= eps)
                a = to[path[cut] ^ 1]
                del path[cut:]
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if cap[e] > eps and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(out[a]):
                path.append(out[a][at[a]])
                a = to[path[-1]]
            elif a == source:
                break
            else:
                e = path.pop()
                a = to[e ^ 1]
                at[a] += 1


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    edges(found)
    keep = min_cut([b.evidence for b in found], [b.links for b in found])
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in steps(batches, "html"):
        texts = [main_text(p) for p in rb.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [rb.column("page_id"), rb.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = pick(pages, page_id="long", url="string", html="string")
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def q_op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
