"""Main text of web pages by minimum cut.

A page becomes a list of text blocks.  A classifier over a block's place in
the document (landmark elements, telling names), its links, length and
punctuation gives it a cost on either side, which becomes its capacity to one
of two terminals: content or boilerplate.  Neighbouring blocks, and blocks
close in the element tree, are tied by smoothness edges.  The minimum cut
between the terminals labels all blocks at once.

Blocks whose own cost outweighs all their edges are settled before the flow
starts - that cannot change the cut - so it runs on the doubtful ones only.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe.llm.common import lean, slices

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                   r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
                   r"|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
HIDDEN = set("head noscript template object svg math canvas audio video select datalist".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
             "span strike strong sub sup time tt u var".split())
FRAME = set("nav footer aside menu dialog button".split())
SOFT_FRAME = set("form fieldset".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
               "menu nav ol p pre section table ul".split())
#: Words in class, id and role that tell boilerplate, those that tell it but may
#: as well name a wrapper of the whole page, and those that tell content.
FRAME_NAMES = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent "
                  "gdpr notice alert popup newsletter subscribe aside menu navbar nav "
                  "navigation breadcrumb breadcrumbs footer toolbar comment comments commentlist disqus reply replies respond "
                  "share sharing social related recommended recommendations widget pagination pager login signup search copyright "
                  "skip contentinfo complementary outbrain taboola teaser tags modal".split())
SOFT_NAMES = set("sidebar legal disclaimer overlay banner masthead paywall subscription header".split())
BODY_NAMES = set("article articlebody story entry post main content body text".split())
STATES = set("has no with without is not js can".split())
NAMED = {"class", "id", "role", "itemprop", "aria-label", "data-component"}


HARD, SOFT = 2, 1


class Element:
    """``frame``: how surely the element is boilerplate, its own or inherited.
    ``body``: 2 inside what is named the article, 1 if that lies in a wrapper
    with a doubtful name, which it clears."""

    __slots__ = ("tag", "parent", "depth", "frame", "body", "hidden", "link")

    def __init__(self, tag: str, parent: Element | None, attributes: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.frame = parent.frame if parent else 0
        self.body = parent.body if parent else 0
        self.hidden = tag in HIDDEN or bool(parent and parent.hidden)
        self.link = tag == "a" or bool(parent and parent.link)
        names: set[str] = set()
        landmark = tag in ("article", "main")
        if attributes and tag not in ("html", "body"):
            for name, *values in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(values)
                if name in NAMED:
                    for token in value.split():
                        words = [p.lower() for p in PARTS.findall(token)]
                        words = words[:next((k for k, w in enumerate(words) if w in STATES), None)]   # "page-with-sidebar" is no sidebar
                        names.update(words)
                        landmark |= bool(words) and BODY_NAMES.issuperset(words)
                elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "").lower()):
                    self.hidden = True
        if tag in FRAME or names & FRAME_NAMES:
            self.frame = HARD
        elif tag in SOFT_FRAME or (names & SOFT_NAMES and not names & BODY_NAMES) or (tag == "header" and not self.body):
            self.frame = max(self.frame, SOFT) if not self.body or "header" not in names else self.frame
        elif (landmark or names & BODY_NAMES) and self.frame != HARD:
            if self.frame == SOFT and landmark:
                self.frame, self.body = 0, 1
            elif not self.frame and not self.body:
                self.body = 2


class Block:
    __slots__ = ("text", "element", "linked")

    def __init__(self, text: str, element: Element, linked: int):
        self.text, self.element, self.linked = text, element, linked


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order: character references decoded, runs of white
    space made one space."""
    at, root = 0, Element("", None, "")
    stack, opened, out = [root], {"": 1}, []
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            own = stack[-1]
            while own.tag in INLINE and own.parent is not None:
                own = own.parent
            out.append(Block(text, own, linked))
        parts.clear()
        linked = 0

    def pop() -> None:
        opened[stack.pop().tag] -= 1

    def say(raw: str) -> None:
        nonlocal linked
        own = stack[-1]
        if raw and not own.hidden:
            raw = entities.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            if own.link:
                linked += len(raw)

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            flush()
            return out
        say(page[at:m.start()])
        at = m.end()
        end, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if tag in INLINE:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        while len(stack) > i:
                            pop()
                    if i >= len(stack) or stack[i].tag not in INLINE:
                        break
            else:
                flush()
                if opened.get(tag):
                    while stack[-1].tag != tag:
                        pop()
                    pop()
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                parts.append("\n")
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSES_P and opened.get("p"):
                i = len(stack) - 1
                while stack[i].tag in INLINE:
                    i -= 1
                if stack[i].tag == "p":
                    while len(stack) > i:
                        pop()
            elif tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1].tag == tag:
                pop()
        stack.append(Element(tag, stack[-1], attributes))
        opened[tag] = opened.get(tag, 0) + 1


# --------------------------------------------------------------- the graph

def leaning(block: Block, best: int) -> float:
    """Log-odds that a block is content: the classifier.  ``best``: the surest
    body on the page.  Every feature is bounded, so none decides alone but the
    elements and names that say boilerplate outright."""
    e, text = block.element, block.text
    words = text.count(" ") + 1
    share = min(block.linked / max(len(text), 1), 1.0)
    value = 0.4 * min(words, 30) / 10 - 2.5 * share
    if text[-1] in ".!?…:;”\"'»)" or text[-1] in "。！？":
        value += 0.4
    if e.tag in ("p", "blockquote", "pre", "h1", "h2", "h3", "h4"):
        value += 0.6
    if e.frame:
        return value - (4.5 if e.frame == HARD else 2.5) - (1.0 if best else 0.0)
    if best:
        return value + (2.0 if e.body == best else -2.5)
    return value - 0.2


def closeness(a: Element, b: Element, reach: int = 6) -> float:
    """Tie between blocks of two elements: 1 in one element, less with every
    step between them in the tree, none beyond ``reach``, and a quarter of it
    across the border of a frame or of the body."""
    border = 0.25 if a.frame != b.frame or a.body != b.body else 1.0
    steps = 0
    while a is not b:
        if steps >= reach:
            return 0.0
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return border / (1 + steps)


def edges_of(blocks: list[Block], adjacent: float = 2.0, near: float = 1.0) -> list[tuple[int, int, float]]:
    """Smoothness edges: each block with the next one, and with the next one
    below the same parent element."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            w = adjacent * closeness(blocks[i - 1].element, b.element)
            if w:
                out.append((i - 1, i, w))
        j = last.get(b.element.parent)
        if j is not None and j < i - 1:
            w = near * closeness(blocks[j].element, b.element)
            if w:
                out.append((j, i, w))
        last[b.element.parent] = i
    return out


def minimum_cut(unary: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (true: content) of least total cost: a node against its sign pays
    its size, an edge between unlike labels pays its weight."""
    n = len(unary)
    value = list(unary)
    ties: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        ties[a][b] = ties[a].get(b, 0.0) + w
        ties[b][a] = ties[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:                                   # settle what its edges cannot turn
        i = todo.popleft()
        if label[i] is None and abs(value[i]) >= sum(ties[i].values()):
            label[i] = value[i] > 0
            for j, w in ties[i].items():
                value[j] += w if label[i] else -w
                del ties[j][i]
                todo.append(j)
            ties[i] = {}
    left = [i for i in range(n) if label[i] is None]
    if left:
        for i, side in zip(left, max_flow_side(left, value, ties)):
            label[i] = side
    return [bool(x) for x in label]


def max_flow_side(nodes: list[int], value: list[float], ties: list[dict[int, float]]) -> list[bool]:
    """Maximum flow by shortest augmenting levels (Dinic); true for nodes on the
    source's side of the cut."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {source: {}, sink: {}} | {i: dict(ties[i]) for i in nodes}
    for i in nodes:
        if value[i] > 0:
            room[source][i], room[i][source] = value[i], 0.0
        else:
            room[i][sink], room[sink][i] = -value[i], 0.0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            u = queue.popleft()
            for v, c in room[u].items():
                if c > 1e-12 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return [i in level for i in nodes]
        arcs = {u: iter(list(room[u])) for u in level}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                flow = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= flow
                    room[b][a] = room[b].get(a, 0.0) + flow
                full = next(k for k in range(len(path) - 1) if room[path[k]][path[k + 1]] <= 1e-12)
                path = path[:full + 1]
                continue
            for v in arcs[u]:
                if room[u][v] > 1e-12 and level.get(v) == level[u] + 1:
                    path.append(v)
                    break
            else:
                path.pop()


def labelled(page: str) -> tuple[list[Block], list[float], list[bool]]:
    """A page's blocks, their own leanings and the cut's labels."""
    blocks = blocks_of(page)
    best = max((b.element.body for b in blocks if not b.element.frame), default=0)
    values = [leaning(b, best) for b in blocks]
    return blocks, values, minimum_cut(values, edges_of(blocks))


def main_text(page: str) -> tuple[str, int, int, int]:
    """A page's main text, its number of blocks, of blocks kept, and of blocks
    whose label the cut turned against their own leaning."""
    blocks, values, labels = labelled(page)
    kept = [b.text for b, keep in zip(blocks, labels) if keep]
    return " ".join(kept), len(blocks), len(kept), sum((v > 0) != x for v, x in zip(values, labels))


def extract(df: DataFrame, html: str = "html") -> DataFrame:
    """``df`` without ``html``, plus ``text`` (empty if there is none),
    ``n_blocks``, ``n_kept`` and ``n_turned`` (long; see ``main_text``).

    One row out per row in; null and empty pages have an empty text; whole
    pages, however long; columns of the result's names are replaced.
    """
    keep = [c for c in df.columns if c not in (html, "text", "n_blocks", "n_kept", "n_turned")]
    source = df.select(F.col(f"`{html}`").alias("html"), *[F.col(f"`{c}`").alias(f"keep{i}") for i, c in enumerate(keep)])
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[1:]), "text string, n_blocks long, n_kept long, n_turned long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [main_text(x or "") for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array([f[0] for f in found], pa.string()), *[pa.array([f[k] for f in found], pa.int64()) for k in (1, 2, 3)]],
                names=[*b.schema.names[1:], "text", "n_blocks", "n_kept", "n_turned"])

    out = lean(source).mapInArrow(run, schema)
    return out.select(*[F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)], "text", "n_blocks", "n_kept", "n_turned")
