"""HTML extraction: minimum-cut labelling of the text blocks of a page.

A page is read as markup once, giving its text blocks in page order, each with its place in the element tree.

* Classifier. Fixed log-odds from the enclosing elements (article or main against menus, headers, footers,
  sidebars, notices, adverts, forms, reader comments), link density, length and sentence marks. Positive
  odds are the cost of calling a block boilerplate (capacity from the source), negative ones that of
  calling it content (capacity to the sink).
* Smoothness. Blocks next to each other, and each block and the one before it in the same parent element,
  are tied by an edge that weakens with their distance in the tree: the cost of labelling them differently.
* Max-flow. The blocks on the source side of the minimum cut are the content.

Character references are decoded, white space inside a block becomes one space, and content blocks are joined by a
line break. Scripts, styles and comments in the markup are no text. Null html gives an empty text; markup that
is cut off or not closed is read as far as it goes. Pages are independent, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from adlens.llm import common

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:\b(?:class|id|role|aria-label)\s*=\s*)(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$|/)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_RAW = {"script", "style", "template", "title", "textarea", "iframe", "svg", "head"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol optgroup option
    p pre search section select summary table tbody td tfoot th thead tr ul""".split())
#: An opening tag that ends an open element of these names.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}, "thead": {"tr"}, "tbody": {"thead", "tr"}}
_SCOPE = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "aside", "nav", "select", "footer"}

_CONTENT_TAGS = {"article", "main"}
_CONTENT_NAMES = {"article", "content", "main", "post", "entry", "story", "text", "articlebody"}
_PLAIN_TAGS = {"nav", "aside", "footer", "form", "button", "select", "menu", "dialog", "fieldset", "search"}
_PLAIN_NAMES = set("""ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs consent cookie
    cookies disclaimer dialog footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice
    notices notification overlay pagination pager popup promo promotion related search share sharing sidebar signup social
    sponsor sponsored subscribe subscription toolbar widget widgets complementary contentinfo""".split())
#: Names of a page's own header; inside an article they mark its title.
_TOP_NAMES = {"banner", "header", "masthead"}
#: Beside these a name tells what the element holds or allows, not what it is ("has-sidebar", "comments-open").
_LAYOUT_NAMES = {"closed", "container", "enabled", "grid", "has", "layout", "no", "open", "page", "with", "without", "wrap", "wrapper"}
_TALK_NAMES = {"comment", "comments", "commentlist", "discussion", "disqus", "replies", "reply", "respond", "responses"}

ZONE = {1: 4.0, 0: -0.5, -1: -6.0, -2: -6.0}
LINK, LENGTH, SENTENCE = -3.0, 3.0, 0.5
SMOOTH = 0.6


def _zone(parent: int, tag: str, attributes: str) -> int:
    """1 inside an article, 0 unknown, -1 inside boilerplate by name, -2 by element (final)."""
    if parent == -2:
        return -2
    names: set[str] = set()
    if attributes and "=" in attributes:
        for found in _NAMES.findall(attributes):
            names.update(re.split(r"[^a-z0-9]+", "".join(found).lower()))
    if attributes and _HIDDEN.search(attributes):
        return -2
    if tag in ("body", "html"):
        names = set()
    named = not names & _LAYOUT_NAMES
    if names & _TALK_NAMES and named or tag in _PLAIN_TAGS or (tag == "header" and parent != 1):
        return -2
    plain = names & _PLAIN_NAMES - (_TOP_NAMES if parent == 1 else set())
    if tag == "main" or tag in _CONTENT_TAGS and parent >= 0 and not plain or "articlebody" in names:
        return 1
    if plain and named:
        return -1
    if parent == 0 and names & _CONTENT_NAMES:
        return 1
    return parent


class Block:
    __slots__ = ("text", "zone", "path", "links")

    def __init__(self, text: str, zone: int, path: tuple[int, ...], links: int):
        self.text, self.zone, self.path, self.links = text, zone, path, links


def blocks(html: str, forms: bool = True) -> list[Block]:
    """Text blocks of a page in page order. ``path`` numbers the enclosing block elements. Without ``forms``
    the form element itself is a plain container."""
    out: list[Block] = []
    stack: list[tuple[str, int, tuple[int, ...]]] = [("", 0, ())]
    held: list[str] = []
    links = count = inside = 0

    def flush():
        nonlocal links
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(Block(text, stack[-1][1], stack[-1][2], links))
            held.clear()
        links = 0

    def say(raw: str):
        nonlocal links
        text = unescape(raw) if "&" in raw else raw
        held.append(text)
        if inside:
            links += len("".join(text.split()))

    def drop(depth: int):
        nonlocal inside
        inside -= sum(1 for e in stack[depth:] if e[0] == "a")
        del stack[depth:]

    at = 0
    while m := _TAG.search(html, at):
        if m.start() > at:
            say(html[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # closing
            if tag in _BLOCK:
                flush()
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if k and (tag in _BLOCK or not any(e[0] in _BLOCK for e in stack[k:])):
                drop(k)
            continue
        attributes = m[3] if m[2] else m[6]
        if tag in _RAW and not attributes.endswith("/"):
            end = re.compile(f"</{tag}\\b[^>]*>" if tag != "head" else r"</head\b[^>]*>|(?=<body\b)", re.I).search(html, at)
            at = end.end() if end else (at if tag == "head" else len(html))
            continue
        if tag == "br":
            held.append(" ")
        elif tag in _BLOCK:
            flush()
            if tag != "hr":
                if any(e[0] == "p" for e in stack):  # a block element ends an open paragraph
                    drop(next(k for k, e in enumerate(stack) if e[0] == "p"))
                ends = _ENDS.get(tag, ())
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in ends:
                        drop(k)
                        break
                    if stack[k][0] in _SCOPE:
                        break
                count += 1
                kind = "div" if tag == "form" and not forms else tag
                stack.append((tag, _zone(stack[-1][1], kind, attributes), (*stack[-1][2], count)))
        elif tag not in _VOID and not attributes.endswith("/"):
            zone = _zone(stack[-1][1], tag, attributes) if attributes else stack[-1][1]
            if zone != stack[-1][1]:  # an inline element with a zone of its own is a block
                flush()
                count += 1
                stack.append((tag, zone, (*stack[-1][2], count)))
            else:
                stack.append((tag, zone, stack[-1][2]))
            inside += tag == "a"
    if at < len(html):
        say(html[at:])
    flush()
    return out


def odds(block: Block) -> float:
    """Log-odds that a block is content."""
    words = block.text.count(" ") + 1
    density = min(1.0, block.links / max(1, len(block.text) - words + 1))
    marks = block.text.endswith((".", "!", "?", "…", ":", "\"", "”")) and words > 3
    return ZONE[block.zone] + LINK * density + LENGTH * min(words, 40) / 40 + SENTENCE * marks


def edges(page: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in page order, and each block with the last one of the same parent."""
    def weight(a: tuple, b: tuple) -> float:
        common_part = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        return SMOOTH / (1 + max(len(a), len(b)) - common_part)

    out, last = [], {}
    for k, block in enumerate(page):
        if k:
            out.append((k - 1, k, weight(page[k - 1].path, block.path)))
        parent = block.path[:-1]
        if last.get(parent, k - 1) < k - 1:
            out.append((last[parent], k, weight(page[last[parent]].path, block.path)))
        last[parent] = k
    return out


def source_side(gains: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes the minimum cut leaves with the source: gains > 0 is the capacity from the source,
    < 0 to the sink, ties hold in both directions. Dinic's algorithm; ties of cost go to the sink."""
    n = len(gains)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: float, back: float):
        at[a].append(len(to))
        to.append(b)
        room.append(forth)
        at[b].append(len(to))
        to.append(a)
        room.append(back)

    for k, gain in enumerate(gains):
        if gain > 0:
            join(source, k, gain, 0.0)
        elif gain < 0:
            join(k, sink, -gain, 0.0)
    for a, b, w in ties:
        join(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in at[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if room[e] <= tiny)
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            while turn[a] < len(at[a]):
                e = at[a][turn[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            else:
                if a == source:
                    break
                e = path.pop()
                a = to[e ^ 1]
                turn[a] += 1
                continue
            path.append(e)
            a = to[e]


def _content(page: list[Block]) -> str:
    gains = [odds(b) for b in page]
    if all(g > 0 for g in gains):
        return "\n".join(b.text for b in page)
    return "\n".join(b.text for b, on in zip(page, source_side(gains, edges(page)), strict=True) if on)


def main_text(html: str | None) -> str:
    """The content of a page. If there is none and a form holds text, the form may be a frame around the
    whole page: then it is read as a plain container."""
    html = html or ""
    text = _content(blocks(html))
    if not text and "<form" in html.lower():
        text = _content(blocks(html, forms=False))
    return text


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            texts = [main_text(html.as_py()) for html in part.column("html")]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row of pages(page_id, url, html)."""
    return common.arrow(pages.select("page_id", "url", "html"), _extract, "page_id long, url string, text string, n_chars long")


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.read(spark, sf_dir, "pages"))
