"""Main text of web pages by minimum-cut labelling of their blocks.

A logistic classifier gives each block the cost of either label: the capacities of
its edges to the two terminals.  Smoothness edges join blocks that follow each
other and blocks that are near in the DOM.  The minimum cut is the labelling of
least total cost.
"""

from __future__ import annotations

import math
import pickle
import re
from bisect import bisect_left
from collections import deque
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import sample_texts

TRAIN_PAGES = 400            # most pages that the classifier is trained on
ADJACENT, NEAR = 0.6, 0.4    # capacity between neighbours, and between neighbours of one parent

# Names whose meaning HTML fixes, by role.
DROPPED = "script style noscript template svg math head title iframe object select option datalist textarea canvas audio video".split()
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr nobr picture source input meta link".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT_TAGS = frozenset(("article", "main"))
CHROME_TAGS = frozenset("nav header footer aside form menu dialog button fieldset".split())
CLOSES_P = frozenset("p div ul ol li table h1 h2 h3 h4 h5 h6 section article aside nav header footer main form pre blockquote dl figure hr address fieldset".split())
# Words in class and id names.
CONTENT_WORDS = frozenset("article content main post entry story body text".split())
CHROME_WORDS = frozenset("ad ads advert advertisement adverts banner sponsor sponsored promo promotion menu nav navbar navigation sidebar side "
                         "footer header masthead breadcrumb breadcrumbs cookie cookies consent notice popup modal newsletter subscribe signup "
                         "share sharing social related recommended comment comments respond reply replies disqus widget toolbar pagination "
                         "pager login search form".split())
# Words that only say where in a layout a named part is.
LAYOUT_WORDS = frozenset("area bar block bottom box btn button buttons col column container content global group head icons inner item items left link links list "
                         "main outer page panel part primary right row secondary section site slot sub top unit wrap wrapper".split())
_RAW = "|".join(t for t in DROPPED if t != "head")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({_RAW})(?=[\s/>])[^>]*+>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*+)>"
    r"|<[!?/][^>]*+>",
    re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[a-z]+")


def _tokens(html: str):
    """(start, end, match) of comments, tags and dropped elements, these with all they
    hold.  A dropped element that closes itself, or is never closed, is its tag alone;
    only an unclosed script or style goes on to the end, as it does in HTML."""
    closings: dict[str, tuple[list[int], list[int]]] = {}
    at = 0
    while m := _TOKEN.search(html, at):
        at = m.end()
        if m[1] and not m[0].endswith("/>"):
            name = m[1].lower()
            if name not in closings:
                ends = [(c.start(), c.end()) for c in re.finditer(rf"</{name}\s*+>", html, re.I)]
                closings[name] = [a for a, _ in ends], [b for _, b in ends]
            starts, ends = closings[name]
            i = bisect_left(starts, at)
            if i < len(starts):
                at = ends[i]
            elif name in ("script", "style"):
                at = len(html)
        yield m.start(), at, m


def _said(names: str) -> int:
    """What class or id names say: -1 furniture, 1 content, 0 nothing.  A name says so if
    all its words do, those of the layout aside: ``social-share`` and ``sidebar-left`` are
    furniture, ``side-note`` and ``share-of-market`` are not."""
    said = 0
    for name in names.lower().split():
        words = set(_WORD.findall(name))
        told = words - LAYOUT_WORDS
        if words & CHROME_WORDS and told <= CHROME_WORDS:
            return -1
        if words & CONTENT_WORDS and told <= CONTENT_WORDS:
            said = 1
    return said


class Block:
    """A block's text and what its place says: ``place`` is +1 in content, -1 in
    page furniture by tag name, ``names`` the same by class and id words."""

    __slots__ = ("text", "tag", "linked", "place", "names", "parent", "depth")

    def __init__(self, text, tag, linked, place, names, parent, depth):
        self.text, self.tag, self.linked, self.place, self.names, self.parent, self.depth = text, tag, linked, place, names, parent, depth


def _role(tag: str, attrs: str, place: int, names: int) -> tuple[int, int]:
    """Role of a container inside one of role (place, names): the nearest one decides."""
    said = 0
    if attrs:
        if _HIDDEN.search(attrs):
            return -1, -1
        for m in _NAMES.finditer(attrs):
            said = min(said, 0) or _said(m[1] or m[2] or m[3] or "")
    if tag in CONTENT_TAGS and place >= 0:
        place, names = 1, max(said, 0) if said >= 0 else -1
        return place, names
    if tag in CHROME_TAGS:
        # The header of an article holds its heading.
        return (place, said or names) if tag == "header" and place > 0 else (-1, said or names)
    if said:
        return place, said if names >= 0 or said < 0 else names
    return place, names


def blocks(html: str) -> list[Block]:
    """Blocks of text in page order.  Unclosed and stray tags are tolerated; time
    is in proportion to the length."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]     # tag, place, names, node number
    open_tags: dict[str, int] = {}
    text: list[str] = []
    linked, in_link, node, at = 0, 0, 0, 0

    def flush():
        nonlocal linked
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                tag, place, names, number = stack[-1]
                parent = stack[-2][3] if len(stack) > 1 else 0
                out.append(Block(joined, tag, min(1.0, linked / len(joined)), place, names, parent, len(stack)))
            text.clear()
        linked = 0

    def pop(tag):
        while True:
            top = stack.pop()
            open_tags[top[0]] -= 1
            if top[0] == tag:
                return

    head = False
    for start, end, m in _tokens(html):
        if start > at and not head:
            piece = html[at:start]
            text.append(piece)
            if in_link:
                linked += len(piece)
        at = end
        tag = m[3]
        if tag is None:
            if not head:
                text.append(" " if m[1] else "")
            continue
        tag = tag.lower()
        closing = bool(m[2])
        if tag == "head":
            head = not closing
            continue
        if tag == "body":
            head = False
        if head and tag not in CLOSES_P:
            continue
        head = False
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        if closing:
            in_link = 0
            if open_tags.get(tag, 0):
                pop(tag)
            continue
        if tag in CLOSES_P and open_tags.get("p", 0):
            pop("p")
        if tag == "li" and stack[-1][0] == "li":
            pop("li")
        if tag in VOID or (m[4] or "").endswith("/"):
            continue
        node += 1
        place, names = _role(tag, m[4], stack[-1][1], stack[-1][2])
        stack.append((tag, place, names, node))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    if at < len(html) and not head:
        text.append(html[at:])
    flush()
    return out


FEATURES = 14


def features(found: list[Block]) -> np.ndarray:
    """One row for each block; columns 1 to 4 are those of its place in the page."""
    x = np.zeros((len(found), FEATURES))
    for i, b in enumerate(found):
        words = b.text.count(" ") + 1
        x[i] = (1.0, b.place > 0, b.place < 0, b.names > 0, b.names < 0, b.linked, math.log1p(words), b.text[-1] in ".!?…:\"'”»",
                b.tag[:1] == "h" and b.tag[1:].isdigit(), b.tag == "li", b.tag == "p", min(1.0, 4 * b.text.count(",") / words),
                "©" in b.text or "copyright" in b.text.lower(), words < 5)
    return x


# Used where no page of the sample has a block whose place tells its label.
PRIOR = np.array([-1.0, 4.0, -4.0, 2.0, -6.0, -3.0, 0.6, 0.5, 0.5, -0.5, 1.0, 0.3, -2.0, -0.5])


def train_weights(pages: list[str], rounds: int = 300, rate: float = 0.3, penalty: float = 0.01) -> np.ndarray:
    """Logistic regression.  Blocks in content containers are positive, blocks in
    page furniture negative; each is seen with its place and, as a second row,
    without, so that text features count where a page names no containers."""
    x, y = [], []
    for html in pages:
        found = blocks(html)
        for b, row in zip(found, features(found)):
            if b.place < 0 or b.names < 0:
                x.append(row), y.append(0.0)
            elif b.place > 0:
                x.append(row), y.append(1.0)
    if not y or min(y) == max(y):
        return PRIOR.copy()
    x, y = np.array(x), np.array(y)
    bare = x.copy()
    bare[:, 1:5] = 0
    x, y = np.concatenate([x, bare]), np.concatenate([y, y])
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w, m, s = PRIOR.copy(), np.zeros(FEATURES), np.zeros(FEATURES)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ ((p - y) * weight) / len(y) + penalty * (w - PRIOR)
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w = w - rate * (1 - t / rounds) * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
    return w


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """(i, j, capacity): adjacency edges, weaker the further apart in the DOM, and
    edges between blocks that follow each other under one parent."""
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            a = found[i - 1]
            apart = 0 if a.parent == b.parent else 1 + abs(a.depth - b.depth)
            edges.append((i - 1, i, ADJACENT / (1 + apart)))
        j = last.get(b.parent)
        if j is not None:
            edges.append((j, i, NEAR))
        last[b.parent] = i
    return edges


def min_cut(gain: np.ndarray, edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (content or not) of least cost: ``max(gain, 0)`` for a block labelled
    out, ``max(-gain, 0)`` for one labelled in, an edge's capacity where its ends
    differ.  A block whose own capacity is no less than that of all its open edges
    keeps its label in a minimum cut; what remains goes through augmenting paths."""
    n = len(gain)
    u = [float(g) for g in gain]
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, c in edges:
        if i != j:
            near[i][j] = near[i].get(j, 0.0) + c
            near[j][i] = near[j].get(i, 0.0) + c
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(u[i]) >= sum(near[i].values()):
            label[i] = u[i] > 0
            for j, c in near[i].items():
                u[j] += c if label[i] else -c
                del near[j][i]
                queue.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        inside = _source_side(rest, u, near)
        for i in rest:
            label[i] = i in inside
    return [bool(x) for x in label]


def _source_side(nodes: list[int], u: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes on the source side of the minimum cut (shortest augmenting paths)."""
    left = {i: dict(near[i]) for i in nodes}
    source = {i: u[i] for i in nodes if u[i] > 0}
    sink = {i: -u[i] for i in nodes if u[i] < 0}
    while True:
        came = {i: None for i, c in source.items() if c > 1e-12}
        queue, end = deque(came), None
        while queue:
            i = queue.popleft()
            if sink.get(i, 0.0) > 1e-12:
                end = i
                break
            for j, c in left[i].items():
                if c > 1e-12 and j not in came:
                    came[j] = i
                    queue.append(j)
        if end is None:
            return set(came)
        path, i = [], end
        while came[i] is not None:
            path.append((came[i], i))
            i = came[i]
        flow = min([source[i], sink[end]] + [left[a][b] for a, b in path])
        source[i] -= flow
        sink[end] -= flow
        for a, b in path:
            left[a][b] -= flow
            left[b][a] += flow


def main_text(html: str | None, weights: np.ndarray) -> str:
    found = blocks(html or "")
    if not found:
        return ""
    labels = min_cut(np.clip(features(found) @ weights, -20, 20), smoothness(found))
    return "\n".join(b.text for b, keep in zip(found, labels) if keep)


def train(spark: SparkSession, pages: DataFrame, html_col: str = "html", id_col: str = "page_id", most: int = TRAIN_PAGES) -> np.ndarray:
    """Weights from at most ``most`` pages, those of least id hash, in one task."""
    sample = sample_texts(pages.filter(F.col(html_col).isNotNull()), id_col, html_col, most, 29)

    def run(batches):
        texts = [t for batch in batches for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train_weights(texts))])], ["w"])

    rows = sample.repartition(1).mapInArrow(run, "w binary").collect()
    return pickle.loads(rows[0]["w"]) if rows else PRIOR


def extract(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",),
            weights: np.ndarray | None = None) -> DataFrame:
    """``id_col, *keep, text, n_chars`` for every row: the blocks labelled content, in
    page order, joined by line ends.  White space within a block is one space, and
    character references are decoded.

    Null or empty html: an empty text.  Repeated rows each give a row, an empty
    table none; other columns are ignored.  The classifier is trained on a bounded
    sample of the table unless weights are given.
    """
    w = train(spark, pages, html_col, id_col) if weights is None else weights
    base = pages.select(F.col(html_col).cast("string").alias("__html"), id_col, *keep)
    schema = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in (id_col, *keep))

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py(), w) for h in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             [*batch.schema.names[1:], "text", "n_chars"])

    return base.mapInArrow(run, schema + ", text string, n_chars long")
