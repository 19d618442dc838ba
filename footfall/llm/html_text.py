"""Main text of web pages from flat text blocks and a decision tree.

A page becomes a flat list of text blocks. Each block is described by its word count and link density, those of its neighbours, and
whether elements or names around it tell of the article, of other content or of neither. A decision tree, grown from a small
labelled table (`html_labels`), tells main text from the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.html_labels import training_pages

# Element names by what they do.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre search section select summary table"
    " tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN_TAGS = frozenset("script style noscript template iframe object svg math textarea select button title canvas audio video".split())
HEAD_TAGS = frozenset("html head base link meta noscript script style template title".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
CELLS = ("caption", "td", "th")
AROUND_PARAGRAPH = (*CELLS, "table", "button")
#: Starts of these end an open paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
#: Starts that end other open elements, within the last open one of some others.
IMPLIED_ENDS = {
    "a": (("a",), CELLS),
    "dd": (("dd", "dt"), ("dl",)),
    "dt": (("dd", "dt"), ("dl",)),
    "li": (("li",), ("ul", "ol", "menu")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "option": (("option",), ("select", "optgroup")),
    "tbody": (("caption", "td", "th", "tr", "tbody", "thead", "tfoot"), ("table",)),
    "td": (("caption", "td", "th"), ("table", "tr")),
    "tfoot": (("caption", "td", "th", "tr", "tbody", "thead", "tfoot"), ("table",)),
    "th": (("caption", "td", "th"), ("table", "tr")),
    "thead": (("caption", "td", "th", "tr", "tbody", "thead", "tfoot"), ("table",)),
    "tr": (("caption", "td", "th", "tr"), ("table",)),
}
TABLE_TAGS = frozenset("caption tbody td tfoot th thead tr".split())
#: Elements that hold other content than the article, by name or ARIA role.
OTHER_TAGS = frozenset("nav aside footer dialog menu search".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
#: Parts of a class or id that tell of other content, of comments, and of the article.
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promos promotion promotions banner banners"
    " cookie cookies consent gdpr notice notices alert alerts popup popups modal modals overlay overlays nav navbar navigation menu menus"
    " breadcrumb breadcrumbs sidebar sidebars side aside footer footers foot copyright masthead logo topbar toolbar header related recommend"
    " recommended recommendations readmore share sharing social newsletter subscribe signup login search widget widgets tags pagination pager".split()
)
COMMENT_NAMES = frozenset("comment comments respond replies reply disqus".split())
MAIN_NAMES = frozenset("article main content post entry story body".split())
#: What follows these in a name is what a container has, not what it is.
HAVING = frozenset("has have with without no not is show hide hides js can".split())
#: A name that ends so tells how a page is laid out.
LAYOUTS = frozenset(
    "fixed image open opened sticky layout page visible enabled on off closed template active collapsed single theme".split()
)
_CUT_TAG = re.compile(r"<[A-Za-z/!?]")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

OTHER, COMMENTS, MAIN = "other", "comments", "main"


@lru_cache(65_536)
def name_kind(value: str) -> str | None:
    """What the names of a class or id say a container is: OTHER, COMMENTS, MAIN or nothing."""
    found = None
    for name in value[:1000].split():
        parts = [part.lower() for part in _PARTS.findall(name)]
        parts = parts[: next((at for at, part in enumerate(parts) if part in HAVING), len(parts))]
        if name.lower() == "hidden":
            return OTHER
        if not parts or (len(parts) > 1 and parts[-1] in LAYOUTS):
            continue
        if not COMMENT_NAMES.isdisjoint(parts):
            return COMMENTS
        # The header of an article belongs to it.
        if any(part in OTHER_NAMES and not (part == "header" and not MAIN_NAMES.isdisjoint(parts)) for part in parts):
            found = OTHER
        elif found is None and not MAIN_NAMES.isdisjoint(parts):
            found = MAIN
    return found


@dataclass
class Block:
    """A run of text between block boundaries, white space made single; how many of its words are linked; its container."""

    text: str
    words: int
    linked: int
    container: int


@dataclass
class Container:
    """An element that says what it holds: by its own kind (`sure`) or by a name, which may be that of a whole page's wrapper."""

    parent: int
    kind: str | None
    sure: bool
    begin: int
    end: int = -1
    heading: bool = False
    article: bool = False
    main: bool = False


class _Blocks(HTMLParser):
    """Collects the blocks of one page. Unclosed and crossed elements are closed as HTML says, or by their containers.

    Every open element is pushed and popped once, whatever is never closed: where each name stands open is kept in `at`.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked_parts: list[str] = []
        self.containers = [Container(0, None, True, 0)]
        #: Open elements: name, whether unseen, link; the container. Each holds for all within.
        self.open: list[tuple[str, bool, bool, int]] = [("", False, False, 0)]
        self.at: dict[str, list[int]] = {}
        self.open_blocks: list[int] = []

    def updatepos(self, i: int, j: int) -> int:
        """Lines are not counted."""
        return j

    def parse_comment(self, i: int, report: bool = True) -> int:
        """As HTML has it: `<!-->` is a whole comment, and one that is never closed lasts to the end."""
        for whole in ("<!-->", "<!--->"):
            if self.rawdata.startswith(whole, i):
                return i + len(whole)
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 else end

    def flush(self) -> None:
        if self.parts:
            words = "".join(self.parts).split()
            if words:
                linked = len("".join(self.linked_parts).split())
                self.blocks.append(Block(" ".join(words), len(words), linked, self.open[-1][3]))
            self.parts, self.linked_parts = [], []

    def _last(self, names: Iterable[str]) -> int:
        """Where the innermost open element of these names stands, 0 if none is open."""
        last = 0
        for name in names:
            where = self.at.get(name)
            if where and where[-1] > last:
                last = where[-1]
        return last

    def _close(self, at: int) -> None:
        """Ends the element at `at` and all in it."""
        while len(self.open) > at:
            name, _, _, container = self.open.pop()
            self.at[name].pop()
            if self.open_blocks and self.open_blocks[-1] == len(self.open):
                self.open_blocks.pop()
            if container != self.open[-1][3]:
                self.containers[container].end = len(self.blocks)

    def _imply_ends(self, tag: str) -> None:
        if self.at.get("head") and tag not in HEAD_TAGS:
            self._close(self.at["head"][-1])
        if tag in ENDS_PARAGRAPH:
            paragraph = self._last(("p",))
            if paragraph and paragraph > self._last(AROUND_PARAGRAPH):
                self._close(paragraph)
        if tag in HEADINGS and self.open[-1][0] in HEADINGS:
            self._close(len(self.open) - 1)
        if tag in IMPLIED_ENDS:
            ended, within = IMPLIED_ENDS[tag]
            limit = self._last(within)
            starts = [self.at[name][-1] for name in ended if self.at.get(name) and self.at[name][-1] > limit]
            if starts:
                self._close(min(starts))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
        self._imply_ends(tag)
        if tag in VOID_TAGS:
            return
        _, unseen, link, container = self.open[-1]
        unseen = unseen or tag in UNSEEN_TAGS
        link = link or tag == "a"
        kind, sure = None, False
        if tag in OTHER_TAGS:
            kind, sure = OTHER, True
        elif tag == "article" or tag == "main":
            kind, sure = MAIN, tag == "main"
        elif tag == "form" or (tag == "header" and not self._in_article(container)):
            kind = OTHER
        elif tag == "h1":
            self.containers[container].heading = True
        if attrs and tag not in ("html", "body"):
            for name, value in attrs:
                if name == "role" and value:
                    role = value.strip().lower()
                    if role in OTHER_ROLES or role == "main":
                        kind, sure = (MAIN if role == "main" else OTHER), True
                elif name in ("class", "id") and value:
                    named = name_kind(value)
                    if named and not sure and kind not in (OTHER, COMMENTS) and not (tag in ("header", *HEADINGS) and self._in_article(container)):
                        kind = named
                elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                    unseen = True
        if kind:
            self.containers.append(
                Container(container, kind, sure, len(self.blocks), article=tag == "article" and kind == MAIN, main=sure and kind == MAIN)
            )
            container = len(self.containers) - 1
        if tag in BLOCK_TAGS:
            self.open_blocks.append(len(self.open))
        self.at.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, unseen, link, container))

    def _in_article(self, container: int) -> bool:
        return self.containers[container].kind == MAIN

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A slash at the end of a start tag means nothing in HTML, but drawings close their elements so.
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and tag not in BLOCK_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
        start = self._last((tag,))
        # The end of an inline element does not close the block around it, that of a block not the cell around it.
        if tag in TABLE_TAGS:
            limit = self._last(("table",))
        elif tag in BLOCK_TAGS:
            limit = 0 if tag == "table" else self._last(CELLS)
        else:
            limit = self.open_blocks[-1] if self.open_blocks else 0
        if start > limit:
            self._close(start)

    def handle_data(self, data: str) -> None:
        if self.at.get("head") and self.open[-1][0] == "head" and not data.isspace():
            self._close(self.at["head"][-1])
        if not self.open[-1][1]:
            self.parts.append(data)
            if self.open[-1][2]:
                self.linked_parts.append(data)


def _places(blocks: list[Block], containers: list[Container]) -> list[float]:
    """For each block 0 in a container of other content, 2 in one of the article, 1 in neither.

    A name is not believed, nor is a form or header, where it wraps the page: where a `main` element stands in it, or a
    top heading or an article, with more than half of all words that are no links. Names of comments are always believed.
    """
    totals = [0]
    for block in blocks:
        totals.append(totals[-1] + block.words - block.linked)
    for container in reversed(containers):
        if container.end < 0:
            container.end = len(blocks)
        if container is not containers[0]:
            around = containers[container.parent]
            around.heading |= container.heading
            around.article |= container.article
            around.main |= container.main
    places = [1.0]
    for container in containers[1:]:
        outer = places[container.parent]
        if container.kind == MAIN:
            places.append(2.0 if outer or container.sure else 0.0)
            continue
        words = totals[container.end] - totals[container.begin]
        wraps = container.main or ((container.heading or container.article) and 2 * words > totals[-1])
        places.append(outer if wraps and not container.sure and container.kind == OTHER else 0.0)
    return [places[block.container] for block in blocks]


def blocks_of(html: str) -> tuple[list[Block], list[float]]:
    """The text blocks of a page in order, and their places. A tag that is cut off at the end is no text."""
    cut = _CUT_TAG.search(html, html.rfind(">") + 1)
    parser = _Blocks()
    parser.feed(html[: cut.start()] if cut else html)
    parser.close()
    parser.flush()
    return parser.blocks, _places(parser.blocks, parser.containers)


def features(blocks: list[Block], places: list[float]) -> np.ndarray:
    """A row per block: word count and link density of itself and of both neighbours, and its place."""
    words = np.array([0, *(b.words for b in blocks), 0], float)
    density = np.array([0, *(b.linked for b in blocks), 0], float) / np.maximum(words, 1)
    return np.column_stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], np.array(places, float)])


@dataclass(frozen=True)
class Node:
    """A leaf has a share of main text; an inner node sends values of at most `limit` to the left."""

    share: float
    feature: int = -1
    limit: float = 0.0
    left: Node | None = None
    right: Node | None = None


def _impurity(labels: np.ndarray) -> float:
    share = labels.mean()
    return 2 * share * (1 - share) * len(labels)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 3) -> Node:
    """A decision tree by Gini impurity; of equally good splits the first feature and lowest limit."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0) or len(rows) < 2 * least:
        return Node(share)
    best = (_impurity(labels) - 1e-9, -1, 0.0)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[:-1] + values[1:]) / 2:
            below = rows[:, feature] <= limit
            if least <= below.sum() <= len(rows) - least:
                left = _impurity(labels[below]) + _impurity(labels[~below])
                if left < best[0] - 1e-9:
                    best = (left, feature, float(limit))
    _, feature, limit = best
    if feature < 0:
        return Node(share)
    below = rows[:, feature] <= limit
    return Node(
        share, feature, limit, grow(rows[below], labels[below], depth - 1, least), grow(rows[~below], labels[~below], depth - 1, least)
    )


def main_blocks(tree: Node, rows: np.ndarray) -> np.ndarray:
    """For each row whether the tree takes it as main text."""
    if tree.feature < 0:
        return np.full(len(rows), tree.share >= 0.5)
    below = rows[:, tree.feature] <= tree.limit
    out = np.empty(len(rows), bool)
    out[below] = main_blocks(tree.left, rows[below])
    out[~below] = main_blocks(tree.right, rows[~below])
    return out


def labelled_blocks(pages: Iterable[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of labelled pages, by default of the table that the tree is grown from."""
    rows, labels = [], []
    for page in training_pages() if pages is None else pages:
        lines = [line for line in page.splitlines() if line.strip()]
        html = "\n".join(line[1:] if line[0] in "+-" else line for line in lines)
        blocks, places = blocks_of(html)
        marks = [line[0] == "+" for line in lines if line[0] in "+-"]
        if len(blocks) != len(marks):
            raise ValueError(f"{len(marks)} labels for {len(blocks)} blocks")
        rows.append(features(blocks, places))
        labels += marks
    return np.concatenate(rows), np.array(labels)


@lru_cache
def trained_tree() -> Node:
    return grow(*labelled_blocks())


def extracted_texts(pages: Iterable[str], tree: Node) -> list[str]:
    """The main text of each page: its blocks joined by line ends; '' if none is main text. All blocks go through the tree together."""
    parsed = [blocks_of(html) for html in pages]
    if not any(blocks for blocks, _ in parsed):
        return [""] * len(parsed)
    chosen = iter(main_blocks(tree, np.concatenate([features(blocks, places) for blocks, places in parsed])).tolist())
    return ["\n".join([block.text for block in blocks if next(chosen)]) for blocks, _ in parsed]


def extract(html: str, tree: Node) -> str:
    return extracted_texts([html], tree)[0]


def main_texts(rows: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Per row: page_id, url, text and n_chars (code points). The whole html is read; null html has an empty text.

    Character references are decoded, white space in a block is one blank. Broken markup is read as far as it goes, in time and memory
    that grow with the length of the page. Repeated rows and null ids or urls come out
    as they came in. An empty table gives no rows.
    """
    tree = trained_tree()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = extracted_texts((html.as_py() or "" for html in part.column(2)), tree)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    chosen = rows.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.col(html_column).cast("string").alias("html"),
    )
    return chosen.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
