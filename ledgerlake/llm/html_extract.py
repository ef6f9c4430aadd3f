"""Main text of web pages by a minimum cut between content and boilerplate.

A page becomes a row of text blocks. A linear classifier of what a block's text looks
like and of what the elements around it say gives its log-odds, which are its capacity
to the content terminal or to the boilerplate terminal; edges between adjacent blocks,
the stronger the more often blocks so near in the DOM are alike, make labels smooth. The
minimum cut, found by maximum flow, is the labelling of least cost.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_arrow, table

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|iframe|object|svg|canvas|select|xmp)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_FORM = re.compile("<form", re.I)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
# fixed values: the elements of HTML that start a block, that have no end tag, and that are headings
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold boilerplate, and words in class, id and role names that speak for it.
#: Names made of such words only are taken seriously, the more so with a word of the
#: second list; of a name that merely has one in it (has-sidebar) less is believed.
BOILERPLATE_TAGS = frozenset("nav footer aside header form fieldset menu button select option label dialog head search".split())
LAYOUT_WORDS = frozenset(
    "alert author bio byline contentinfo disclaimer dropdown feedback footer footnotes header hidden legal login masthead menu meta nav navbar "
    "navigation notice notices recommended related search sidebar skip tags toolbar topbar tracking trending widget widgets".split()
)
STRONG_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright "
    "discussion disqus gdpr modal newsletter overlay pager pagination popup promo promoted promotion reply replies respond share sharing signup social "
    "sponsor sponsored subscribe".split()
)
BOILERPLATE_WORDS = LAYOUT_WORDS | STRONG_WORDS
CONTENT_TAGS = frozenset("article main".split())
CONTENT_WORDS = frozenset("article body content entry main post story text".split())
#: What the elements around a block say: by tag, by name, or by hiding it.
CONTENT, HINT, BOILER, STRONG, LAYOUT, PART, HIDDEN, HEADER = (1 << i for i in range(8))
SAYINGS = (CONTENT, HINT, BOILER, STRONG, LAYOUT, PART, HIDDEN)
#: A form with so many paragraphs of so many characters is around the page, not part of it.
PARAGRAPHS, LONG = 3, 80
#: Capacities are integers: a log-odds of 1 is so many units.
UNITS = 1000
#: The classifier learns from about so many pages, taken by a hash of the row, and from so
#: many blocks of each at most, evenly spaced.
TRAIN_PAGES, TRAIN_BLOCKS = 2_000, 200
#: Weights before anything is learnt: 1, log length, link share, sentence marks, ends as a
#: sentence, p, heading, list or table, digits; and then SAYINGS.
PRIOR = np.array([-3.0, 0.9, -4.0, 0.5, 1.0, 1.0, 0.5, -1.0, -1.0, 6.0, 2.0, -9.0, -8.0, -4.0, -1.0, -12.0])
TEXT_FEATURES = len(PRIOR) - len(SAYINGS)
#: How many blocks the pages count as against the prior, whose weights have a standard
#: deviation of 1.
STRENGTH = 200.0
#: Edges before anything is learnt, by steps in the DOM; how many pairs that counts as; and
#: the most that an edge can weigh.
DISTANCES = 12
SMOOTH = 1.2 * 0.75 ** np.arange(DISTANCES + 1)
PAIRS, MOST_SMOOTH = 50.0, 1.5


@dataclass
class Block:
    """A text with its features, the SAYINGS that hold in it, its depth, the least depth
    between the block before and it, and the number of its element's parent."""

    text: str
    features: tuple[float, ...]
    says: int
    depth: int
    low: int
    parent: int

    def row(self, says: bool = True) -> list[float]:
        return [*self.features, *(float(says and bool(self.says & bit)) for bit in SAYINGS)]


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: PRIOR)
    smooth: np.ndarray = field(default_factory=lambda: SMOOTH)


UNTAUGHT = Model()


def _says(tag: str, attributes: str) -> int:
    """What an element says about the text in it."""
    bits = (CONTENT if tag in CONTENT_TAGS else 0) | (BOILER if tag in BOILERPLATE_TAGS else 0)
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return bits
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            bits |= HIDDEN
        elif name in ("class", "id", "role"):
            for token in value.split():
                words = {w.lower() for w in _WORD.findall(token)}
                if words & BOILERPLATE_WORDS and tag not in ("body", "html", "main"):
                    if words <= BOILERPLATE_WORDS:
                        bits |= STRONG if words & STRONG_WORDS else LAYOUT
                    else:
                        bits |= PART
                if words & CONTENT_WORDS:
                    bits |= HINT
    return bits


def _inside(tag: str, said: int, around: int) -> int:
    """What holds in an element that says ``said`` where ``around`` holds.

    A main is the page's, wherever it is. An article is, unless it stands in boilerplate
    (a comment, a teaser), and no layout name in or around it counts. Boilerplate in an
    article isn't of it; of its header, only headings are.
    """
    if tag == "main":
        around &= HIDDEN
    elif tag == "article":
        if around & (BOILER | STRONG | HIDDEN):
            said &= ~CONTENT
        else:
            said &= ~(LAYOUT | PART)
            around &= ~(LAYOUT | PART)
    elif tag == "header" and around & CONTENT and not around & (BOILER | STRONG):
        said = said & ~BOILER | HEADER
    if said & (BOILER | STRONG):
        around &= ~(CONTENT | HINT)
    return said | around


def _around(page: str) -> set[int]:
    """Which forms, by their order, are around a main, an article or many paragraphs."""
    out: set[int] = set()
    form, forms, paragraphs, at = -1, 0, 0, 0
    length = -1  # of the text in the open paragraph

    def ended() -> None:
        nonlocal paragraphs, length
        paragraphs += length >= LONG
        length = -1
        if form >= 0 and paragraphs >= PARAGRAPHS:
            out.add(form)

    for m in _TOKEN.finditer(page):
        if length >= 0:
            length += m.start() - at
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        closing = (m[2] if m[3] else m[5]) == "/"
        if tag not in BLOCKS:
            continue
        ended()
        if tag == "form":
            form, paragraphs = (-1 if closing else forms), 0
            forms += not closing
        elif not closing and tag in CONTENT_TAGS and form >= 0:
            out.add(form)
        elif not closing and tag == "p":
            length = 0
    ended()
    return out


class _Text:
    """Text that is read now: its parts, and how many characters of it are links."""

    __slots__ = ("parts", "linked", "level")

    def __init__(self, level: int):
        self.parts, self.linked, self.level = [], 0, level


class _Page:
    """Reads a page into blocks; every element is pushed and popped once."""

    def __init__(self, page: str):
        self.page = page
        # open elements: (tag, what holds inside, number)
        self.stack: list[tuple[str, int, int]] = [("", 0, 0)]
        self.open: Counter[str] = Counter()
        self.blocks: list[Block] = []
        self.texts = [_Text(0)]
        self.low = 1
        self.made = self.links = 0

    def read(self) -> list[Block]:
        page, forms, at = self.page, 0, 0
        around_page = _around(page) if _FORM.search(page) else set()
        for m in _TOKEN.finditer(page):
            self.add(page[at : m.start()])
            at = m.end()
            if m[1]:
                if m[1].lower() in ("title", "textarea", "select", "object"):
                    self.flush()
                continue
            tag = (m[3] or m[6] or "").lower()
            if not tag:
                continue
            closing = (m[2] if m[3] else m[5]) == "/"
            if tag == "a":
                self.links = 0 if closing else 1
            elif tag == "br":
                self.texts[-1].parts.append(" ")
            if closing:
                if tag in BLOCKS:
                    self.flush()
                if self.open[tag]:
                    self.close(tag)
                continue
            if tag in BLOCKS:
                self.flush()
                self.imply(tag)
            if tag in VOID:
                continue
            said = _says(tag, m[4] if m[3] else m[7])
            if tag == "form":
                if forms in around_page:
                    said &= ~BOILER
                forms += 1
            if tag in BLOCKS:
                self.push(tag, said)
            elif said & (BOILER | STRONG | LAYOUT | HIDDEN):
                # boilerplate in a line: a block of its own, which doesn't end the one around it
                self.push(tag, said)
                self.texts.append(_Text(len(self.stack)))
        self.add(page[at:])
        self.flush()
        return self.blocks

    def push(self, tag: str, said: int) -> None:
        self.made += 1
        self.open[tag] += 1
        self.stack.append((tag, _inside(tag, said, self.stack[-1][1]), self.made))

    def pop(self) -> None:
        if self.texts[-1].level == len(self.stack):
            self.emit(self.texts.pop())
        self.open[self.stack.pop()[0]] -= 1
        self.low = min(self.low, len(self.stack))

    def close(self, tag: str) -> None:
        """An end tag closes the innermost element of its name; an inline one not over a block."""
        if tag not in BLOCKS:
            for t, _, _ in reversed(self.stack):
                if t == tag:
                    break
                if t in BLOCKS:
                    return
        while self.stack[-1][0] != tag:
            self.pop()
        self.pop()

    def imply(self, tag: str) -> None:
        """A start tag closes what can't hold it: a p any block, an item the item before."""
        same = _CLOSES.get(tag, ())
        while len(self.stack) > 1:
            top = self.stack[-1][0]
            if top == "p" or top in same or top not in BLOCKS and any(t == "p" for t, _, _ in self.stack[-3:]):
                self.pop()
            else:
                break

    def add(self, raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            self.texts[-1].parts.append(text)
            if self.links:
                self.texts[-1].linked += len(text.strip())

    def flush(self) -> None:
        while len(self.texts) > 1:
            self.emit(self.texts.pop())
        self.emit(self.texts[0])
        self.texts[0] = _Text(0)

    def emit(self, held: _Text) -> None:
        text = " ".join("".join(held.parts).split())
        if not text:
            return
        level = held.level or len(self.stack)
        tags = {t for t, _, _ in self.stack[max(0, level - 4) : level]}
        n = len(text)
        heading = bool(tags & HEADINGS)
        features = (
            1.0,
            float(np.log1p(n)),
            min(1.0, held.linked / n),
            min(1.0, 40 * sum(text.count(c) for c in ".!?;:…") / n),
            float(text[-1] in ".!?…»\"”"),
            float("p" in tags),
            float(heading),
            float(bool(tags & {"li", "dt", "dd", "td", "th", "option"})),
            sum(map(str.isdigit, text)) / n,
        )
        says = self.stack[level - 1][1]
        if says & HEADER:
            says = says & ~HEADER if heading else says & ~(HEADER | CONTENT | HINT) | BOILER
        parent = self.stack[max(0, level - 2)][2]
        self.blocks.append(Block(text, features, says, level, min(self.low, level), parent))
        self.low = level


_CLOSES = {
    "body": ("head",),
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in order: references decoded, white space as one space."""
    return _Page(page or "").read()


def scores(blocks: list[Block], weights: np.ndarray) -> np.ndarray:
    """The log-odds of content."""
    return np.array([b.row() for b in blocks]).reshape(len(blocks), len(weights)) @ weights


def pairs_of(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """(block, later block, steps between them in the DOM): neighbours in the page, and the
    next block whose element has the same parent."""
    out = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            out.append((i - 1, i, min(DISTANCES, blocks[i - 1].depth + b.depth - 2 * b.low)))
        if (j := last.get(b.parent, -1)) >= 0 and j != i - 1:
            out.append((j, i, 2))
        last[b.parent] = i
    return out


def edges_of(blocks: list[Block], smooth: np.ndarray = SMOOTH) -> list[tuple[int, int, float]]:
    """Smoothness edges (block, block, capacity)."""
    return [(a, b, float(smooth[d])) for a, b, d in pairs_of(blocks)]


def minimum_cut(score: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Which nodes are on the content side of a minimum cut.

    A node with a positive score is linked with the source by it, one with a negative
    score with the sink. A node whose terminal outweighs all of its edges is on that
    side of a minimum cut, so it is settled first and its edges go to the neighbours'
    terminals; what is left goes to the maximum flow.
    """
    n = len(score)
    terminal = [round(UNITS * float(s)) for s in score]
    around: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, c in edges:
        w = round(UNITS * c)
        if w and a != b:
            around[a][b] = around[b][a] = around[a].get(b, 0) + w
    side: list[bool | None] = [None] * n
    work = deque(range(n))
    while work:
        i = work.popleft()
        if side[i] is None and abs(terminal[i]) >= sum(around[i].values()) and (terminal[i] or not around[i]):
            side[i] = terminal[i] > 0
            for j, w in around[i].items():
                terminal[j] += w if side[i] else -w
                del around[j][i]
                work.append(j)
            around[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        inside = _source_side({i: terminal[i] for i in rest}, {i: around[i] for i in rest})
        for i in rest:
            side[i] = i in inside
    return np.array(side, bool)


def _source_side(terminal: dict[int, int], around: dict[int, dict[int, int]]) -> set[int]:
    """Nodes that the source reaches in the residual graph of a maximum flow (shortest augmenting paths)."""
    residual = {i: dict(ws) for i, ws in around.items()}
    left = dict(terminal)
    while True:
        come: dict[int, int | None] = {i: None for i, t in left.items() if t > 0}
        queue = deque(come)
        end = None
        while queue:
            i = queue.popleft()
            if left[i] < 0:
                end = i
                break
            for j, w in residual[i].items():
                if w > 0 and j not in come:
                    come[j] = i
                    queue.append(j)
        if end is None:
            return set(come)
        path = [end]
        while come[path[-1]] is not None:
            path.append(come[path[-1]])
        flow = min(-left[end], left[path[-1]], *(residual[a][b] for b, a in zip(path, path[1:], strict=False)))
        left[end] += flow
        left[path[-1]] -= flow
        for b, a in zip(path, path[1:], strict=False):
            residual[a][b] -= flow
            residual[b][a] += flow


def main_text(page: str | None, model: Model = UNTAUGHT) -> str:
    """The content blocks, joined by two line feeds; empty if there are none."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    content = minimum_cut(scores(blocks, model.weights), edges_of(blocks, model.smooth))
    return "\n\n".join(b.text for b, c in zip(blocks, content, strict=True) if c)


def _label(block: Block) -> float | None:
    """1 for a block in an element of content, 0 for one in boilerplate, None where nothing
    or both is said."""
    if block.says & (BOILER | STRONG):
        return 0.0
    return 1.0 if block.says & CONTENT and not block.says & (HIDDEN | LAYOUT) else None


def taught(x: np.ndarray, y: np.ndarray, prior: np.ndarray = PRIOR, strength: float = STRENGTH) -> np.ndarray:
    """The most probable weights of a logistic model, both classes counting the same."""
    if len(np.unique(y)) < 2:
        return prior
    weigh = strength * np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w = prior.copy()
    for _ in range(25):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weigh * (p - y)) + (w - prior)
        hessian = (x * (weigh * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    return w


def smoothness(alike: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The edges' weights by distance: half the log-odds that blocks so far apart are alike."""
    prior = 1 / (1 + np.exp(-2 * SMOOTH))
    p = (alike + PAIRS * prior) / (pairs + PAIRS)
    return np.clip(0.5 * np.log(p / (1 - p)), 0, MOST_SMOOTH)


def fit(pages: DataFrame, page: str = "html", train_pages: int = TRAIN_PAGES, train_blocks: int = TRAIN_BLOCKS) -> Model:
    """The classifier and the edges, learnt from blocks whose elements say what they are.

    Each such block teaches twice: with what its elements say, and with that hidden, so
    that text speaks where nothing else does. If there are more than ``train_pages`` pages,
    about that many are taken by a hash of the row's number, and ``train_blocks`` blocks of
    a page at most; the driver gets their features. Without blocks of both kinds the
    weights are ``PRIOR``.
    """
    rows = pages.filter(F.col(page).isNotNull()).select(F.col(page).alias("page"))
    n = rows.count()
    if n > train_pages:
        rows = rows.filter(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1_000_000)) < round(1_000_000 * train_pages / n))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, x = [], []
            alike, pairs = np.zeros(DISTANCES + 1), np.zeros(DISTANCES + 1)
            for t in batch.column(0):
                blocks = blocks_of(t.as_py())
                labels = [_label(b) for b in blocks]
                known = [i for i, label in enumerate(labels) if label is not None]
                for i in known[:: -(-len(known) // train_blocks) or 1]:
                    for says in (True, False):
                        x.append(blocks[i].row(says))
                        y.append(labels[i])
                for a, b, d in pairs_of(blocks):
                    if labels[a] is not None and labels[b] is not None:
                        pairs[d] += 1
                        alike[d] += labels[a] == labels[b]
            x += [alike.tolist(), pairs.tolist()]
            y += [2.0, 3.0]
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.float64()), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    found = map_arrow(rows, featured, "y double, x array<double>").toArrow()
    y = found["y"].to_numpy()
    of = lambda kind, width: np.array(found["x"].filter(pa.array(np.isin(y, kind))).to_pylist()).reshape(-1, width)
    weights = taught(of((0, 1), len(PRIOR)), y[y < 2])
    return Model(weights, smoothness(of((2,), DISTANCES + 1).sum(axis=0), of((3,), DISTANCES + 1).sum(axis=0)))


def extract(pages: DataFrame, model: Model, page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, text and n_chars per row of ``pages``.

    A null or empty page has the empty text. Repeated rows stay; an empty table gives
    an empty result; columns other than ``keep`` and ``page`` are not read, and one named
    text or n_chars gives way to the result's.
    """
    keep = tuple(c for c in keep if c not in ("text", "n_chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t.as_py(), model) for t in batch.column(0)]
            n = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()), n], [*keep, "text", "n_chars"])

    kinds = "".join(f"{c} {pages.schema[c].dataType.simpleString()}, " for c in keep)
    return map_arrow(pages.select(F.col(page).alias("__page"), *keep), run, f"{kinds}text string, n_chars long")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, the main text and its code points, of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
