"""Main-text extraction from web pages by minimum-cut labelling.

A page is cut into blocks of text, each with the elements it stands in.  A classifier gives every block a cost
for being called content and one for being called boilerplate; these are its capacities to the two terminals.
Neighbouring blocks, and blocks that follow each other under one parent element, are joined by one smoothness
edge, the stronger the closer they stand in the DOM.  The minimum cut, found by blocking flows, separates
content from boilerplate, and content blocks are joined in page order.

The classifier adds what the section says to what the block itself looks like.  The nearest element that says
something about its section decides (an ``article`` inside a wrapper named for a side bar is an article); the
weights of a block's own shape (words, links, end, kind of element) are fitted on the pages themselves: blocks
in sections told by tag or name are the labelled rows, of at least ``SAMPLE_PAGES`` pages (all, if fewer) drawn
by hash, and stay near ``PRIOR`` where these say little or nothing.

Character references are decoded, white space in a block becomes one space, blocks are joined by an empty
line; nothing else is dropped or capped.  Defined cases: a null or empty page, and one with no content, have an
empty text; unclosed and stray tags are put up with; repeated rows are extracted each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaskit.llm.common import importable_in_workers, text_slices

# --- fixed values: elements of HTML, and words that name parts of a page ------------------------------------
NO_TEXT = "script|style|title|textarea"  # what they hold is no markup, up to their end tag
BESIDE = set("noscript template svg iframe select button".split())  # never part of the text they stand in
FOREIGN = set("svg math".split())  # their elements are no HTML; a block of HTML ends them
BLOCKS = set("p div h1 h2 h3 h4 h5 h6 ul ol li dl table blockquote pre hr article section main header footer nav body".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
             "span strike strong sub sup time tt u var math object".split())
ASIDE_TAGS = set("nav footer aside menu dialog head".split())
MAIN_TAGS = set("article main".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = set("p blockquote pre".split())
ITEMS = set("li dt dd td th".split())
#: Parts that hold no article of the page, even where an ``article`` element stands in them.
APART_WORDS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
                  "breadcrumb breadcrumbs share sharing related recommended recommendations newsletter subscribe subscription "
                  "signup login comment comments reply replies respond discussion disqus teaser".split())
ASIDE_WORDS = APART_WORDS | set(
    "banner notice notices alert popup modal overlay nav navbar navigation menu sidebar side widget footer masthead topbar "
    "toolbar social search copyright pagination pager tags hidden complementary contentinfo form".split())
MAIN_WORDS = set("article content main post entry story body text maintext articlebody".split())
#: Words that make a name tell of a part elsewhere (``has-sidebar``, ``comments-open``).
BEFORE_WORDS, AFTER_WORDS = set("has with no without".split()), set("enabled disabled open closed on off".split())
# ------------------------------------------------------------------------------------------------------------
#: What a section says of its blocks, on a logarithmic scale (positive: content).  A block's shape says at most
#: ``MOST_SHAPE`` either way, so it decides where the section says little.
MAIN, MAIN_NAME, HEADER, FORM, ASIDE_NAME, ASIDE_TAG, NEVER = 4.0, 1.5, -3.5, -5.0, -5.0, -6.0, -9.0
MOST_SHAPE = 3.0
#: A form with more words in it than this is wrapped around the page.
FORM_WORDS = 100
#: Weight of a smoothness edge by DOM distance, and between blocks that follow each other under one parent.
EDGE, SIBLING_EDGE, MOST_STEPS = 1.2, 0.8, 64

#: A block's shape: a step of its words, quarters of linked text, whether it ends as a sentence, its kind.
WORD_STEPS = [1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 40]
SHAPES = len(WORD_STEPS) * 5 * 2 * 4
#: Weights that the fit starts from and stays near: base, per word, under four words, sentence, paragraph, heading, item, linked.
PRIOR = np.array([-0.6, 0.05, -1.0, 0.8, 1.2, 0.6, -0.4, -5.0])
SAMPLE_PAGES, CLASS_WEIGHT = 1000, 50.0

_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({NO_TEXT})(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>", re.S | re.I)
_NAMES = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Element:
    tag: str
    parent: "Element | None"
    block: "Element | None"  # the nearest element, itself included, that is not inline
    depth: int
    side: float  # what the section says
    apart: bool  # no article inside can change that
    form: "Element | None"
    item: bool
    link: bool
    beside: bool
    foreign: bool
    words: int = 0  # of a form


@dataclass(slots=True)
class Block:
    text: str
    linked: int  # characters inside links
    parent: Element


def _names(attributes: str) -> list[list[str]]:
    """The words of each class, id, role and item property."""
    found = []
    for _, value in _NAMES.findall(attributes):
        for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).split():
            words = _WORD.findall(name.lower())
            if words and words[0] not in BEFORE_WORDS and words[-1] not in AFTER_WORDS:
                found.append(words)
    return found


def _section(tag: str, attributes: str, over: Element) -> tuple[float, bool]:
    """(what the section says, whether an article inside cannot change it)."""
    if over.apart and over.side <= ASIDE_TAG:
        return over.side, True
    names, hidden = [], False
    if attributes and not attributes.isspace():
        names, hidden = _names(attributes), bool(_HIDDEN.search(attributes))
    words = {w for name in names for w in name}
    if hidden or tag in BESIDE:
        return NEVER, True
    if tag in ASIDE_TAGS:
        return ASIDE_TAG, True
    if tag == "main" or ["main"] in names and tag not in ("body", "html"):
        return MAIN, False
    if over.apart:
        return over.side, True
    if tag == "article":
        return (ASIDE_NAME, True) if any(name[0] in APART_WORDS for name in names) else (MAIN, False)
    if tag not in ("html", "body") and words & ASIDE_WORDS:
        return ASIDE_NAME, bool(words & APART_WORDS)
    if over.side in (MAIN, ASIDE_NAME):
        return over.side, False
    if tag == "header":
        return HEADER, False
    return (MAIN_NAME if over.side == 0 and words & MAIN_WORDS else over.side), False


def _open(tag: str, attributes: str, parent: Element | None) -> Element:
    over = parent or Element("", None, None, 0, 0.0, False, None, False, False, False, False)
    side, apart = _section(tag, attributes, over)
    e = Element(tag, parent, over.block, over.depth + 1, side, apart, None if side == MAIN != over.side else over.form,
                tag in ITEMS or over.item and tag not in HEADINGS, over.link or tag == "a", over.beside or tag in BESIDE,
                over.foreign or tag in FOREIGN)
    if tag == "form":
        e.form = e
    if tag not in INLINE or parent is None:
        e.block = e
    return e


def blocks(html: str) -> list[Block]:
    """The page's blocks of text, in order."""
    out: list[Block] = []
    here = _open("html", "", None)
    own: list[str] = []
    linked = 0
    block_parent = here
    opened: Counter[str] = Counter()

    def enter(name: str, attributes: str) -> None:
        nonlocal here
        here = _open(name, attributes, here)
        opened[name] += 1

    def leave(name: str) -> None:
        """Close the nearest open element of that name, which is open, and all in it."""
        nonlocal here
        while here.tag != name:
            opened[here.tag] -= 1
            here = here.parent
        opened[name] -= 1
        here = here.parent

    def add(text: str, linked: int, parent: Element) -> None:
        out.append(Block(text, linked, parent))
        if parent.form is not None:
            parent.form.words += text.count(" ") + 1

    def close() -> None:
        nonlocal linked, own
        if own:
            text = " ".join("".join(own).split())
            if text:
                add(text, linked, block_parent)
        own, linked = [], 0

    def said(raw: str) -> None:
        nonlocal linked, block_parent
        if not raw:
            return
        text = unescape(raw) if "&" in raw else raw
        if here.beside:  # a block of its own; the text around it goes on
            if text := " ".join(text.split()):
                add(text, len(text) if here.link else 0, here)
            return
        if not own:
            block = here.block
            while block.foreign and block.parent is not None:
                block = block.parent.block
            block_parent = block
        own.append(text)
        if here.link:
            linked += len(text.strip())

    ends_at: dict[str, int] = {}

    def last_end(name: str) -> int:
        if name not in ends_at:
            ends_at[name] = max((x.start() for x in re.finditer(rf"</{name}(?=[\s/>])", html, re.I)), default=-1)
        return ends_at[name]

    at = 0
    for m in _TAG.finditer(html):
        said(html[at:m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if m[2]:  # an end tag closes the nearest open element of its name
            if opened[name]:
                if name in INLINE or name in BESIDE:
                    leave(name)
                else:
                    e = here.block
                    while e.tag != name:
                        e = e.parent.block
                    if not e.foreign:
                        close()
                    leave(name)
            continue
        if here.foreign and name in BLOCKS:
            while here.foreign:
                opened[here.tag] -= 1
                here = here.parent
        if name in BESIDE or name in FOREIGN:
            # one that closes itself, or that nothing closes, holds nothing
            if name in FOREIGN and m[4].endswith("/") or last_end(name) < at:
                continue
            while name in ("button", "select") and opened[name]:  # these end one of their name
                leave(name)
            enter(name, m[4])
            continue
        if name in VOID:
            if name == "hr":
                close()
            else:
                own.append(" ") if own else None
            continue
        if name in INLINE or here.foreign:
            if not m[4].endswith("/"):
                enter(name, m[4])
            continue
        close()
        # a block ends an open paragraph, and an item the item before it
        ends = {"p"} if name not in ("li", "td", "th", "tr", "dt", "dd", "option") else {"p", name, "td", "th"} if name == "tr" else {"p", name}
        while here.block.parent is not None and here.block.tag in ends:
            leave(here.block.tag)
        enter(name, m[4])
    said(html[at:])
    close()
    return out


def shape(block: Block) -> int:
    """The number of a block's shape, below ``SHAPES``."""
    e = block.parent
    kind = 1 if e.tag in PARAGRAPHS else 2 if e.tag in HEADINGS else 3 if e.item else 0
    steps = bisect_right(WORD_STEPS, block.text.count(" ") + 1) - 1
    quarters = min(4, 4 * block.linked // len(block.text))
    return ((steps * 5 + quarters) * 2 + (block.text[-1] in ".!?:;\"”»")) * 4 + kind


def _features() -> np.ndarray:
    """The features of every shape, in the order of ``PRIOR``."""
    number = np.arange(SHAPES)
    words, kind = np.array(WORD_STEPS)[number // 40], number % 4
    return np.stack([np.ones(SHAPES), words, words < 4, number // 4 % 2, kind == 1, kind == 2, kind == 3, number // 8 % 5 / 4], 1).astype(float)


def section(block: Block) -> float:
    """What the block's section says."""
    e = block.parent
    if e.form is not None and e.form.words <= FORM_WORDS:
        return min(FORM, e.side)
    return e.side


def fit_weights(counts: dict[tuple[int, bool], float]) -> np.ndarray:
    """Weights from the number of blocks by (shape, whether its section is content): logistic regression with both
    classes of one weight, by Newton steps, with a normal prior around ``PRIOR``, which stands if a class is missing."""
    x, mass = _features(), np.zeros((SHAPES, 2))
    for (number, content), n in sorted(counts.items()):
        mass[number, int(content)] += n
    if not mass.sum(0).all():
        return PRIOR
    mass *= CLASS_WEIGHT / mass.sum(0)
    scale = np.array([1.0, 20.0, 1, 1, 1, 1, 1, 1])  # a weight per word is a twentieth of the others
    precision = np.diag(scale ** 2)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(mass[:, 1] @ np.logaddexp(0, -z) + mass[:, 0] @ np.logaddexp(0, z) + (w - PRIOR) @ precision @ (w - PRIOR) / 2)

    weights = PRIOR.copy()
    for _ in range(100):
        share = 1 / (1 + np.exp(-(x @ weights)))
        slope = x.T @ (mass.sum(1) * share - mass[:, 1]) + precision @ (weights - PRIOR)
        step = np.linalg.solve((x.T * (mass.sum(1) * share * (1 - share))) @ x + precision, slope)
        size = 1.0
        while size > 1e-6 and loss(weights - size * step) > loss(weights):
            size /= 2
        weights = weights - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return weights


def shape_scores(weights: np.ndarray) -> list[float]:
    """What every shape says, by its number."""
    return np.clip(_features() @ weights, -MOST_SHAPE, MOST_SHAPE).tolist()


PRIOR_SCORES = shape_scores(PRIOR)


def score(block: Block, scores: list[float] = PRIOR_SCORES) -> float:
    """How much likelier content than boilerplate, on a logarithmic scale."""
    return section(block) + scores[shape(block)]


def _distance(a: Element, b: Element) -> int:
    """Steps between two elements in the tree; ``MOST_STEPS`` and more are alike."""
    n = 0
    while a is not b and n < MOST_STEPS:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
        if a is None or b is None:
            break
    return n


class Cut:
    """Minimum cut between two terminals by blocking flows.

    What a node could take from both terminals is passed at once; then each node keeps one terminal, as a
    surplus (content) or a demand (boilerplate), and flow leads from surplus to demand over the edges.  Each
    round blocks all shortest paths at once, so long pages of short paths take few rounds."""

    LEAST = 1e-9

    def __init__(self, content: list[float], boilerplate: list[float]):
        self.rest = [a - b for a, b in zip(content, boilerplate)]
        self.edges: list[dict[int, float]] = [{} for _ in content]

    def join(self, a: int, b: int, capacity: float) -> None:
        for x, y in ((a, b), (b, a)):
            self.edges[x][y] = self.edges[x].get(y, 0.0) + capacity

    def _levels(self) -> tuple[dict[int, int], int | None]:
        """(steps from the nearest surplus, steps at which the first demand is met)."""
        rest, edges, least = self.rest, self.edges, self.LEAST
        level = {i: 0 for i, r in enumerate(rest) if r > least}
        front, steps = list(level), 0
        while front:
            steps += 1
            reached = []
            for a in front:
                for b, c in edges[a].items():
                    if c > least and b not in level:
                        level[b] = steps
                        reached.append(b)
            if any(rest[b] < -least for b in reached):
                return level, steps
            front = reached
        return level, None

    def _block(self, level: dict[int, int], last: int) -> None:
        """Send flow along shortest paths until each has a full edge or end."""
        rest, edges, least = self.rest, self.edges, self.LEAST
        left = {a: list(edges[a]) for a, steps in level.items() if steps < last}  # neighbours not yet given up
        for start in [i for i, steps in level.items() if steps == 0]:
            path = [start]
            while rest[start] > least:
                a = path[-1]
                if level[a] == last and rest[a] < -least:
                    flow = min(rest[start], -rest[a], *(edges[x][y] for x, y in zip(path, path[1:])))
                    rest[start] -= flow
                    rest[a] += flow
                    for x, y in zip(path, path[1:]):
                        edges[x][y] -= flow
                        edges[y][x] += flow
                    path = [start]
                    continue
                ways = left.get(a, [])
                while ways and not (edges[a][ways[-1]] > least and level.get(ways[-1]) == level[a] + 1):
                    ways.pop()
                if ways:
                    path.append(ways[-1])
                elif a == start:
                    break
                else:
                    path.pop()
                    left[path[-1]].pop()

    def content_side(self) -> list[bool]:
        while True:
            level, last = self._levels()
            if last is None:
                return [i in level for i in range(len(self.rest))]
            self._block(level, last)


def smoothness(found: list[Block]) -> dict[tuple[int, int], float]:
    """The weight of the edge between two blocks, by their places: one for each pair."""
    edges: dict[tuple[int, int], float] = {}
    last_under: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            edges[i - 1, i] = EDGE / (1 + _distance(found[i - 1].parent, b.parent))
        before = last_under.get(id(b.parent.parent))
        if before is not None:
            edges[before, i] = max(edges.get((before, i), 0.0), SIBLING_EDGE)
        last_under[id(b.parent.parent)] = i
    return edges


def main_text(html: str | None, scores: list[float] = PRIOR_SCORES) -> str:
    """The page's content, blocks joined by an empty line; ``scores`` says what every shape of a block says."""
    found = blocks(html) if html else []
    if not found:
        return ""
    costs = [score(b, scores) for b in found]
    cut = Cut([max(c, 0.0) for c in costs], [max(-c, 0.0) for c in costs])
    for (i, j), weight in smoothness(found).items():
        cut.join(i, j, weight)
    return "\n\n".join(b.text for b, keep in zip(found, cut.content_side()) if keep)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks by (shape, label) of each batch, where the section tells the label."""
    for batch in batches:
        counts: Counter[tuple[int, bool]] = Counter()
        for _, pages in text_slices(batch.column(0)):
            for html in pages:
                for b in blocks(html.as_py() or ""):
                    says = section(b)
                    if says == MAIN or NEVER < says <= ASIDE_NAME:
                        counts[shape(b), says == MAIN] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.int32()), pa.array([k[1] for k in counts], pa.bool_()),
             pa.array(list(counts.values()), pa.int64())], names=["shape", "content", "n"])


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights of a block's shape, from the pages with the least hashes of id and address (``sample_pages`` of them
    and those that tie with the last); the driver sees one row per shape and label."""
    importable_in_workers(pages.sparkSession)
    drawn = F.xxhash64(F.col("page_id").cast("long"), F.col("url").cast("string"))
    last = pages.select(drawn.alias("drawn")).orderBy("drawn").limit(sample_pages).agg(F.max("drawn")).first()[0]
    if last is None:
        return PRIOR
    counted = (pages.where(drawn <= last).select(F.col("html").cast("string").alias("html"))
               .mapInArrow(_count, "shape int, content boolean, n long").groupBy("shape", "content").agg(F.sum("n").alias("n")))
    return fit_weights({(r["shape"], r["content"]): r["n"] for r in counted.collect()})


def _extract(scores: list[float]):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, pages in text_slices(batch.column(2)):
                texts = [main_text(h, scores) for h in pages.to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(pages)), batch.column(1).slice(row, len(pages)),
                    pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return extract


def extract_pages(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; the weights of a block's shape are fitted on the pages if not given."""
    importable_in_workers(pages.sparkSession)
    scores = shape_scores(fit(pages) if weights is None else weights)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract(scores), "page_id long, url string, text string, n_chars long")
