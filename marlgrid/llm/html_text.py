"""Main text of a page by a minimum cut over its blocks.

A page is cut into blocks, the text between tags that start or end a block. A linear
classifier scores each block; its cost of being called content or boilerplate is the
capacity of the block's edge to one of two terminals. Edges between neighbouring
blocks, and between blocks that follow each other under one parent element, hold
blocks together, the more so the nearer they are in the document tree. The minimum
cut, found by maximum flow, is the labelling of least total cost.

What tags and names say is evidence of bounded weight, on the scale of the edges. The
weights below are fixed values; ``learn`` moves them towards labelled pages.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlgrid.llm.linear import sigmoid
from marlgrid.llm.texts import map_texts

# Elements whose content is no text of the page. Those of raw text end at
# their closing tag or with the page, the others with their parent at the latest, and
# where a block starts if they have no closing tag.
RAW = "script|style|title|textarea|iframe"
SKIPPED = frozenset("template select button svg object math canvas audio video".split())
# Elements of another markup language, and elements in them that hold HTML.
FOREIGN = frozenset(["svg", "math"])
FOREIGN_HTML = frozenset(["foreignobject", "desc", "annotation-xml"])
# Elements that start and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup "
    "html legend li main menu nav noscript ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
# Open elements that an element ends when it starts, innermost first.
CLOSES = {
    "p": ("p",),
    "li": ("li", "p"),
    "dt": ("dt", "dd", "p"),
    "dd": ("dt", "dd", "p"),
    "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"),
    "th": ("td", "th", "p"),
}
BOILERPLATE_TAGS = frozenset("nav footer aside menu dialog search".split())
# A form may be a frame around the whole page, and these may be part of an article.
FORM_TAGS = frozenset(["form", "fieldset"])
DOUBTFUL_TAGS = frozenset(["address", "noscript"])
CONTENT_TAGS = frozenset(["article", "main"])
# Words of names that say what an element is, and words that say so only beside an article.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar menu nav navbar navigation topnav footer header masthead topbar cookie cookies "
    "consent gdpr newsletter subscribe subscription signup login related recommended "
    "recommendations comment comments commentlist disqus respond reply replies breadcrumb "
    "breadcrumbs pagination pager widget widgets popup modal overlay tags toolbar teaser "
    "outbrain taboola paywall".split()
)
DOUBTFUL_WORDS = frozenset(
    "notice alert register social share sharing discussion reader readers feedback copyright "
    "legal disclaimer search form skip hidden".split()
)
CONTENT_WORDS = frozenset("content article post entry story main text body articlebody".split())
# Names of frames around a whole page; if one holds the article, what else it is called
# says nothing.
FRAME_WORDS = frozenset("with has wrapper wrap container page layout outer site app root".split())
# The words after these in a name tell what a frame has or lacks.
HAVING_WORDS = frozenset("with has no without".split())
# Names of the article itself, beside which a frame word leaves other names open.
ARTICLE_NAMES = frozenset("article post entry story main articlebody hentry".split())

# The classifier: what each sign of a block weighs for content. ``long`` is the logarithm
# of its words over ``WORDS_NEUTRAL``, within bounds; ``links`` the share of its text in links.
WEIGHTS = {
    "in article": 3.0,
    "called content": 2.0,
    "boilerplate": -14.0,
    "doubtful": -7.0,
    "doubtful in article": -2.5,
    "header": -5.0,
    "links": -4.0,
    "sentence": 0.5,
    "long": 0.7,
    "heading": 1.0,
    "p": 1.0,
    "blockquote": 0.5,
    "pre": 0.5,
    "li": -0.3,
    "td": -0.3,
    "th": -0.3,
}
WORDS_NEUTRAL, SHORTEST, LONGEST = 6, -1.0 / 0.7, 3.0 / 0.7
OWN_TAGS = frozenset(["p", "blockquote", "pre", "li", "td", "th"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

# Capacities of the edges between blocks.
ADJACENT, SIBLINGS = 2.0, 1.0

# Labelled pages that weights are learned from in the mean, blocks of one of them, and what
# holds them to ``WEIGHTS``.
PAGES = 1_000
PAGE_BLOCKS = 200
RIDGE = 1e-2
HASH_RANGE = 1 << 30

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})(?![\w-])({_ATTRIBUTES})>.*?(?:</\1(?![\w-])[^>]*>|\Z)"
    rf"|<(/?)([a-z][^\s/>]*)({_ATTRIBUTES})>"
    rf"|<(/?)([a-z][^\s/>]*)([^>]*)>"
    rf"|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*\Z",
    re.S | re.I,
)
SKIPPED_TAG = re.compile(rf"<(/?)({'|'.join(sorted(SKIPPED))})(?![\w-])({_ATTRIBUTES})>", re.I)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Element(NamedTuple):
    """An element: its parent's number (-1: none), its depth, its tag and what it says of itself.

    ``boilerplate`` is what it is in any case, ``framed`` unless it holds the article.
    """

    parent: int
    depth: int
    tag: str
    boilerplate: bool
    framed: bool
    doubtful: bool
    header: bool
    content: bool


class State(NamedTuple):
    """What an element and those around it say of its blocks."""

    article: bool
    called: bool
    boilerplate: bool
    doubtful: bool
    doubtful_inside: bool
    header: bool


NOTHING = State(False, False, False, False, False, False)


class Block(NamedTuple):
    """Text of one block, how much of it is in links, its element (-1: none), and its signs."""

    text: str
    linked: int
    element: int
    signs: Mapping[str, float]

    def score(self, weights: Mapping[str, float]) -> float:
        return sum([weights[sign] * value for sign, value in self.signs.items()])


def _words(value: str) -> tuple[set[str], set[str]]:
    """The names in an attribute, and their words without those that a frame has or lacks."""
    words: set[str] = set()
    for name in value.split():
        for word in WORD.findall(CAMEL.sub(" ", name).lower()):
            words.add(word)
            if word in HAVING_WORDS:
                break
    return set(value.lower().split()), words


def _element(parent: int, depth: int, tag: str, attributes: str) -> Element:
    boilerplate = tag in BOILERPLATE_TAGS
    framed = tag in FORM_TAGS
    doubtful = tag in DOUBTFUL_TAGS
    header = content = False
    if attributes and tag not in ("html", "body"):
        for match in NAMES.finditer(attributes):
            names, words = _words(match[1] or match[2] or match[3] or "")
            strong, weak = words & BOILERPLATE_WORDS, words & DOUBTFUL_WORDS
            content |= bool(words & CONTENT_WORDS) and not strong and not weak
            doubtful |= bool(weak)
            if strong == {"header"}:
                # A header of the article itself holds its title.
                header = True
            elif strong and not words & FRAME_WORDS:
                boilerplate = True
            elif strong and not names & ARTICLE_NAMES:
                framed = True
        boilerplate |= bool(HIDDEN.search(attributes))
    return Element(parent, depth, tag, boilerplate, framed, doubtful, header, content)


def _state(around: State, element: Element, frame: bool) -> State:
    """``frame``: the element only holds the article."""
    article, called, boilerplate, doubtful, inside, header = around
    if element.tag in CONTENT_TAGS:
        article = True
    content = article or called
    called |= element.content and not content
    boilerplate |= element.boilerplate or element.framed and not frame
    boilerplate |= element.header and not content
    if element.doubtful and not frame:
        doubtful, inside = doubtful or not content, inside or content
    header |= element.tag == "header" and not content
    return State(article, called, boilerplate, doubtful, inside, header)


def _states(elements: Sequence[Element], frames: set[int]) -> list[State]:
    found: list[State] = []
    for number, element in enumerate(elements):
        around = found[element.parent] if element.parent >= 0 else NOTHING
        found.append(_state(around, element, number in frames))
    return found


def _frames(elements: Sequence[Element], raw: Sequence[tuple[str, int, int]]) -> set[int]:
    """The elements that are, or may be, boilerplate by themselves, but only hold the article.

    Those are elements around the article or main element, and forms that hold most of the
    text outside of boilerplate. The article is the first one that is no boilerplate itself,
    unless content came before it.
    """
    if not any(element.framed or element.doubtful for element in elements):
        return set()
    frames: set[int] = set()
    article = main = False
    states = _states(elements, set())
    # What an element says for sure, whatever frames there are.
    outright: list[bool] = []
    for number, (element, state) in enumerate(zip(elements, states, strict=True)):
        above = element.parent >= 0 and outright[element.parent]
        content = element.parent >= 0 and (states[element.parent].article or states[element.parent].called)
        outright.append(above or element.boilerplate or element.header and not content)
        if outright[number]:
            continue
        if element.tag == "main" and not main or element.tag == "article" and not article and not element.framed:
            around = element.parent
            while around >= 0:
                if elements[around].framed or elements[around].doubtful:
                    frames.add(around)
                around = elements[around].parent
            main |= element.tag == "main"
            article = True
        elif (state.article or state.called) and not state.boilerplate:
            article = True
    held = [0] * (len(elements) + 1)
    for text, _, number in raw:
        if number < 0 or not outright[number]:
            held[number] += len(text)
    total = sum(held)
    for number in range(len(elements) - 1, -1, -1):
        element = elements[number]
        if element.tag in FORM_TAGS and not outright[number] and 2 * held[number] > total:
            frames.add(number)
        held[element.parent] += held[number]
    return frames


def _signs(text: str, linked: int, tag: str, state: State) -> dict[str, float]:
    words = text.count(" ") + 1
    found = {"long": max(SHORTEST, min(LONGEST, math.log2(words / WORDS_NEUTRAL)))}
    if linked:
        found["links"] = min(1.0, linked / len(text))
    if text[-1] in ".!?…。":
        found["sentence"] = 1.0
    if tag in OWN_TAGS:
        found[tag] = 1.0
    elif tag in HEADINGS:
        found["heading"] = 1.0
    if state.article:
        found["in article"] = 1.0
    if state.called:
        found["called content"] = 1.0
    if state.boilerplate:
        found["boilerplate"] = 1.0
    if state.doubtful:
        found["doubtful"] = 1.0
    elif state.doubtful_inside:
        found["doubtful in article"] = 1.0
    if state.header:
        found["header"] = 1.0
    return found


def _closed(page: str) -> set[int]:
    """Where the skipped elements start that have a closing tag."""
    closed: set[int] = set()
    opened: dict[str, list[int]] = {}
    for match in SKIPPED_TAG.finditer(page):
        tag = match[2].lower()
        starts = opened.setdefault(tag, [])
        if not match[1]:
            if tag not in FOREIGN or not match[3].endswith("/"):
                starts.append(match.start())
        elif starts:
            closed.add(starts.pop())
    return closed


def blocks(page: str) -> tuple[list[Block], list[Element]]:
    """The non-empty blocks of a page in order, with character references decoded, and its elements."""
    elements, raw = _parsed(page)
    states = _states(elements, _frames(elements, raw))
    found = []
    for text, linked, number in raw:
        state = states[number] if number >= 0 else NOTHING
        tag = elements[number].tag if number >= 0 else ""
        found.append(Block(text, linked, number, _signs(text, linked, tag, state)))
    return found, elements


def _parsed(page: str) -> tuple[list[Element], list[tuple[str, int, int]]]:
    """The elements that make blocks, and each block's text, link characters and element."""
    elements: list[Element] = []
    raw: list[tuple[str, int, int]] = []
    # The numbers of the open elements, and how many of each tag.
    open_: list[int] = []
    tags: Counter[str] = Counter()
    parts: list[str] = []
    # The skipped element that is open, and the elements in it.
    inside: list[str] = []
    inner: Counter[str] = Counter()
    closed = _closed(page)
    ends_itself = False
    linked = 0
    in_link = False
    at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            raw.append((text, linked, open_[-1] if open_ else -1))
        parts.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if inside:
            return
        text = html.unescape(piece) if "&" in piece else piece
        parts.append(text)
        if in_link:
            linked += len(text)

    def end() -> str:
        tag = elements[open_.pop()].tag
        tags[tag] -= 1
        return tag

    def leave() -> None:
        inside.clear()
        inner.clear()

    def enter(tag: str) -> None:
        inside.append(tag)
        inner[tag] += 1

    def skips(tag: str, closing: bool, empty: bool) -> bool:
        """Whether a tag belongs to the skipped element; ends that if its parent ends."""
        if closing:
            if inner[tag]:
                while True:
                    last = inside.pop()
                    inner[last] -= 1
                    if last == tag:
                        return True
            if tags[tag] or tag == "a" and in_link and not ends_itself:
                leave()
                return False
            return True
        if tag in BLOCKS:
            foreign = inside[0] in FOREIGN and not any(inner[x] for x in FOREIGN_HTML)
            if foreign or len(inside) == 1 and not ends_itself:
                leave()
                return False
        if not empty and (tag in BLOCKS or tag in SKIPPED or tag in FOREIGN_HTML):
            enter(tag)
        return True

    while token := TOKEN.search(page, at):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        if token[1] and inside and inside[0] in FOREIGN and token[2].endswith("/"):
            # In another markup language it may be empty.
            at = token.end(2) + 1
        tag = token[4] or token[7]
        if not tag:
            continue
        tag = tag.lower()
        closing = bool(token[3] or token[6])
        attributes = token[5] or token[8] or ""
        empty = attributes.endswith("/") and (tag in FOREIGN or token.start() not in closed)
        if inside and skips(tag, closing, empty):
            continue
        if tag in BLOCKS:
            flush()
            in_link = False
            if closing:
                if tags[tag]:
                    while end() != tag:
                        pass
            else:
                for ended in CLOSES.get(tag, ("p",) if tag != "body" else ()):
                    if open_ and elements[open_[-1]].tag == ended:
                        end()
                parent = open_[-1] if open_ else -1
                depth = elements[parent].depth + 1 if open_ else 1
                open_.append(len(elements))
                tags[tag] += 1
                elements.append(_element(parent, depth, tag, attributes))
        elif tag in SKIPPED:
            if not closing and not empty:
                enter(tag)
                ends_itself = token.start() in closed
        elif tag == "hr":
            flush()
        elif tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not closing
    add(page[at:])
    flush()
    return elements, raw


def _edges(page: Sequence[Block], elements: Sequence[Element]) -> Iterator[tuple[int, int, float]]:
    """Smoothness edges: neighbours, and blocks that follow each other under one parent."""
    last: dict[int, int] = {}
    for i, block in enumerate(page):
        if i:
            one, other, steps = page[i - 1].element, block.element, 0
            while one != other:
                # Up from the deeper one.
                if one < 0 or other >= 0 and elements[other].depth > elements[one].depth:
                    other = elements[other].parent
                else:
                    one = elements[one].parent
                steps += 1
            yield i - 1, i, ADJACENT / (1 + steps)
        parent = elements[block.element].parent if block.element >= 0 else -1
        if last.get(parent, i - 1) != i - 1:
            yield last[parent], i, SIBLINGS
        last[parent] = i


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source, by Dinic's maximum flow.

    A positive score is the capacity of the edge from the source, a negative one that
    of the edge to the sink. Edges run both ways. Nodes that could be on either side
    go with the sink.
    """
    n = len(scores)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def connect(a: int, b: int, there: float, back: float) -> None:
        heads[a].append(len(to))
        heads[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for i, score in enumerate(scores):
        if score > 0:
            connect(source, i, score, 0.0)
        elif score < 0:
            connect(i, sink, -score, 0.0)
    for a, b, capacity in edges:
        connect(a, b, capacity, capacity)

    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = [source]
        for node in queue:
            for edge in heads[node]:
                if room[edge] > 1e-9 and level[to[edge]] < 0:
                    level[to[edge]] = level[node] + 1
                    queue.append(to[edge])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        next_edge = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(room[edge] for edge in path)
                for edge in path:
                    room[edge] -= flow
                    room[edge ^ 1] += flow
                keep = next(i for i, edge in enumerate(path) if room[edge] <= 1e-9)
                node = to[path[keep] ^ 1]
                del path[keep:]
                continue
            while next_edge[node] < len(heads[node]):
                edge = heads[node][next_edge[node]]
                if room[edge] > 1e-9 and level[to[edge]] == level[node] + 1:
                    path.append(edge)
                    node = to[edge]
                    break
                next_edge[node] += 1
            else:
                if node == source:
                    break
                level[node] = -1
                node = to[path.pop() ^ 1]


def main_text(page: str, weights: Mapping[str, float] = WEIGHTS) -> str:
    """The blocks of a page that the cut leaves with the content, one per line."""
    found, elements = blocks(page)
    kept = minimum_cut([block.score(weights) for block in found], list(_edges(found, elements)))
    return "\n".join(block.text for block, keep in zip(found, kept, strict=True) if keep)


def extract(
    pages: DataFrame,
    page: str = "html",
    text: str = "text",
    weights: Mapping[str, float] = WEIGHTS,
) -> DataFrame:
    """Adds ``text``, the main text of the whole of ``page``, and ``n_chars``, its code points.

    A page that is null, empty or without content gives an empty text. Repeated rows
    are each taken; columns called like the added ones are replaced, ``page`` is
    dropped. No row moves between tasks. An empty table stays empty.
    """
    weights = dict(weights)

    def run(found: list[str]) -> list[list]:
        texts = [main_text(x, weights) for x in found]
        return [texts, [len(x) for x in texts]]

    keep = [name for name in pages.columns if name != page]
    return map_texts(pages, keep, page, run, {text: "string", "n_chars": "bigint"})


ARTICLE_TAG = re.compile(r"(</?)(?:article|main)(?![\w-])", re.I)


def labelled(page: str) -> list[tuple[list[float], bool]]:
    """The signs of each block of a page that has an article element, and whether it is in it.

    The signs are those of the page with plain elements in place of the article's, so that they
    tell what a page without one looks like.
    """
    elements, raw = _parsed(page)
    states = _states(elements, _frames(elements, raw))
    if not any(state.article for state in states):
        return []
    plain, _ = blocks(ARTICLE_TAG.sub(r"\1div", page))
    content = [
        number >= 0 and states[number].article and not states[number].boilerplate
        for _, _, number in raw
    ]
    if len(plain) != len(content):
        return []
    row = lambda block: [block.signs.get(sign, 0.0) for sign in WEIGHTS]
    return [(row(block), label) for block, label in zip(plain, content, strict=True)]


def learn(pages: DataFrame, key: str, page: str = "html") -> dict[str, float]:
    """``WEIGHTS`` moved towards what tells the blocks of article elements from others.

    About ``PAGES`` pages, drawn by a hash of ``key``, are looked at in tasks; signs and
    labels of their blocks go to the driver, those of ``PAGE_BLOCKS`` of a page at most. Signs that these pages do not have keep their
    weights; without any labelled page all do. Every page counts alike.
    """
    number = F.pmod(F.xxhash64(F.col(key), F.lit(5)), F.lit(HASH_RANGE))
    n = pages.count()
    drawn = pages.filter(number < (HASH_RANGE if n <= PAGES else int(HASH_RANGE * PAGES / n)))
    # One page for a key, so that a key of many rows does not fill the driver.
    drawn = drawn.groupBy(F.col(key).alias("_id")).agg(F.min_by(page, F.md5(page)).alias("_page"))

    def run(found: list[str]) -> list[list]:
        # Of a long page every second or third block, and so on.
        both = [(b := labelled(x))[:: 1 + len(b) // PAGE_BLOCKS] for x in found]
        signs = [[value for row, _ in blocks_ for value in row] for blocks_ in both]
        return [signs, [[float(label) for _, label in blocks_] for blocks_ in both]]

    added = {"signs": "array<double>", "labels": "array<double>"}
    rows = map_texts(drawn, ["_id"], "_page", run, added)
    rows = rows.filter(F.size("labels") > 0).orderBy("_id").toArrow()
    if not rows.num_rows:
        return dict(WEIGHTS)
    x = rows.column("signs").combine_chunks().flatten().to_numpy().reshape(-1, len(WEIGHTS))
    y = rows.column("labels").combine_chunks().flatten().to_numpy()
    counts = rows.column("labels").combine_chunks().value_lengths().to_numpy()
    share = np.repeat(1 / counts, counts) / len(counts)
    start = np.array(list(WEIGHTS.values()))
    weights = start.copy()
    for _ in range(30):
        p = sigmoid(x @ weights)
        slope = x.T @ (share * (p - y)) + RIDGE * (weights - start)
        bend = x.T @ (x * (share * p * (1 - p))[:, None]) + RIDGE * np.eye(len(start))
        weights = weights - np.linalg.solve(bend, slope)
    return dict(zip(WEIGHTS, weights.tolist(), strict=True))
