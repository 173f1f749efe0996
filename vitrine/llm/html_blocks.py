"""Main text of web pages from flat text blocks, classified by a small decision tree.

A page is cut into flat blocks at block-level tags. A block is described by its own word count and
link density, those of its two neighbours, and the kind of container around it; a CART tree, grown
from the labelled table below, says which blocks belong to the article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import lean, text_bytes
from vitrine.sources.tables import table

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Fixed values of HTML: elements without text of the page, elements that end a block, and elements
# that the parser closes by itself.
_SILENT = frozenset("script style noscript template head title select option button textarea iframe object svg canvas math audio video map".split())
_RAW = frozenset("script style textarea title noscript iframe template svg".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = frozenset(
    "article aside blockquote body details dialog div dl fieldset figure footer form header html main menu nav ol section table ul".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in tag, role, class or id names that tell what a container holds.
_MAIN_WORDS = frozenset("article main content post entry story".split())
_OTHER_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside side complementary contentinfo banner cookie cookies "
    "consent gdpr notice notices alert ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion share "
    "sharing social related recommended comment comments reply replies respond disqus discussion newsletter subscribe subscription "
    "popup modal overlay pagination pager login signin signup search form toolbar widget widgets skip copyright legal tags".split()
)
# Words that may stand beside one of those in a name of several parts that is still such a container's.
_WRAPPER_WORDS = frozenset(
    "area bar block body bottom box col column container content fixed footer global group header holder inner item items left link links "
    "list main page panel primary right row section secondary site sticky text title top wrap wrapper posts articles stories entries".split()
)
_TAG_ZONE = {"article": 3, "main": 3, "nav": 0, "footer": 0, "aside": 0, "form": 0, "menu": 0, "dialog": 0}
# Of the words above, those whose containers hold texts of others: an ``article`` in them is a comment or a teaser.
_FOREIGN_WORDS = frozenset(
    "comment comments reply replies respond disqus discussion related recommended promo promotion ad ads adv advert adverts "
    "advertisement advertising sponsor sponsored social sharing share".split()
)
# Kinds of containers: furniture by its name alone, other furniture, nothing known, main by its name alone, article by its tag.
LAYOUT, OTHER, PLAIN, MAIN, ARTICLE = -1, 0, 1, 2, 3

#: words, link density, words and link density of the block before, of the block after, zone
#: (0 menu, footer, advert and the like; 1 nothing known; 2 article), heading; article or not.
LABELLED = (
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0), (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0), (40, 0.0, 2, 1.0, 60, 0.0, 0, 0, 0),
    (6, 0.0, 1, 1.0, 12, 0.0, 0, 0, 0), (12, 0.1, 80, 0.0, 0, 0.0, 0, 0, 0), (90, 0.0, 70, 0.0, 80, 0.0, 0, 0, 0),
    (25, 0.2, 3, 0.0, 30, 0.0, 0, 0, 0), (3, 0.0, 90, 0.0, 4, 0.0, 0, 1, 0), (60, 0.0, 5, 0.0, 55, 0.0, 0, 0, 0),
    (90, 0.0, 70, 0.0, 30, 0.0, 0, 0, 0), (30, 0.0, 60, 0.0, 20, 0.0, 0, 0, 0), (200, 0.0, 90, 0.0, 50, 0.0, 0, 0, 0),
    (50, 0.0, 100, 0.0, 0, 0.0, 0, 0, 0), (16, 0.0, 30, 0.0, 3, 0.0, 0, 0, 0), (70, 0.0, 40, 0.0, 10, 0.0, 0, 0, 0),
    (20, 0.0, 45, 0.1, 90, 0.0, 0, 0, 0), (35, 0.1, 28, 0.0, 70, 0.0, 0, 0, 0), (9, 0.0, 50, 0.0, 70, 0.0, 0, 1, 0),
    (120, 0.0, 12, 0.0, 90, 0.0, 2, 0, 1), (12, 0.0, 6, 0.0, 120, 0.0, 2, 1, 1), (4, 0.0, 90, 0.0, 80, 0.0, 2, 0, 1),
    (1, 0.0, 60, 0.0, 2, 0.0, 2, 0, 1), (8, 0.9, 50, 0.0, 40, 0.1, 2, 0, 1), (3, 1.0, 70, 0.0, 60, 0.0, 2, 0, 1),
    (2, 0.0, 40, 0.0, 0, 0.0, 2, 0, 1), (200, 0.3, 90, 0.0, 10, 0.0, 2, 0, 1), (30, 0.0, 0, 0.0, 25, 0.0, 2, 0, 1),
    (5, 0.0, 3, 1.0, 4, 1.0, 2, 1, 1), (2, 1.0, 1, 1.0, 3, 1.0, 2, 0, 1),
    (80, 0.0, 3, 1.0, 0, 0.0, 2, 0, 1), (4, 0.0, 2, 1.0, 17, 0.0, 2, 1, 1), (3, 0.0, 4, 1.0, 1, 1.0, 2, 1, 1), (35, 0.0, 2, 1.0, 2, 1.0, 2, 0, 1),
    (3, 0.0, 5, 1.0, 2, 0.0, 2, 0, 1), (12, 0.0, 3, 0.8, 1, 0.0, 2, 0, 1), (2, 0.0, 1, 1.0, 0, 0.0, 2, 0, 1), (60, 0.6, 5, 1.0, 3, 0.0, 2, 0, 1),
    (4, 0.0, 3, 1.0, 30, 0.0, 1, 1, 1), (9, 0.0, 2, 1.0, 45, 0.0, 1, 1, 1), (5, 0.0, 60, 0.0, 40, 0.0, 1, 1, 1), (3, 0.0, 25, 0.0, 30, 0.0, 1, 1, 1),
    (3, 0.0, 60, 0.0, 2, 1.0, 1, 1, 0), (2, 0.0, 3, 1.0, 4, 1.0, 1, 1, 0), (4, 0.0, 0, 0.0, 2, 1.0, 1, 1, 0), (2, 0.0, 40, 0.0, 3, 0.9, 1, 1, 0),
    (70, 0.0, 3, 1.0, 0, 0.0, 1, 0, 1), (30, 0.0, 2, 1.0, 2, 1.0, 1, 0, 1), (45, 0.0, 40, 0.0, 0, 0.0, 0, 0, 0), (30, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0),
    (8, 0.0, 30, 0.0, 25, 0.0, 0, 1, 0), (150, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0),
    (80, 0.0, 60, 0.0, 90, 0.0, 1, 0, 1), (45, 0.05, 80, 0.0, 70, 0.1, 1, 0, 1), (20, 0.0, 60, 0.0, 45, 0.0, 1, 0, 1),
    (18, 0.1, 40, 0.0, 3, 1.0, 1, 0, 1), (8, 0.0, 4, 1.0, 90, 0.0, 1, 1, 1), (6, 0.0, 50, 0.0, 70, 0.0, 1, 1, 1),
    (7, 0.0, 70, 0.0, 65, 0.0, 1, 0, 1), (60, 0.2, 2, 1.0, 40, 0.0, 1, 0, 1), (150, 0.1, 8, 0.0, 2, 1.0, 1, 0, 1),
    (2, 1.0, 3, 1.0, 2, 1.0, 1, 0, 0), (4, 1.0, 0, 0.0, 3, 1.0, 1, 0, 0), (10, 0.8, 4, 1.0, 6, 0.9, 1, 0, 0),
    (30, 0.9, 5, 1.0, 20, 0.8, 1, 0, 0), (3, 0.0, 2, 1.0, 4, 1.0, 1, 0, 0), (5, 0.0, 3, 1.0, 0, 0.0, 1, 0, 0),
    (6, 0.5, 30, 0.0, 4, 1.0, 1, 0, 0), (9, 0.0, 4, 1.0, 3, 0.7, 1, 0, 0), (12, 0.6, 80, 0.0, 60, 0.0, 1, 0, 0),
    (4, 0.0, 6, 0.5, 3, 1.0, 1, 1, 0), (25, 0.7, 3, 0.0, 4, 1.0, 1, 0, 0), (40, 0.6, 10, 0.9, 2, 1.0, 1, 0, 0),
    (28, 0.0, 28, 0.0, 28, 0.0, 1, 0, 1), (28, 0.0, 0, 0.0, 28, 0.0, 1, 0, 1), (28, 0.0, 28, 0.0, 0, 0.0, 1, 0, 1),
    (60, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1), (25, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1), (15, 0.0, 20, 0.0, 18, 0.0, 1, 0, 1),
    (18, 0.0, 3, 1.0, 22, 0.0, 1, 0, 1), (3, 1.0, 60, 0.0, 3, 1.0, 1, 0, 0), (4, 1.0, 80, 0.0, 0, 0.0, 1, 0, 0),
    (3, 1.0, 70, 0.0, 60, 0.0, 1, 0, 0), (5, 1.0, 28, 0.0, 4, 1.0, 1, 0, 0), (2, 1.0, 60, 0.0, 2, 1.0, 1, 0, 0),
)


class DecisionTree:
    """A binary CART tree by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 6) -> None:
        self.node = self._grow(x, y, depth)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int):
        share = float(y.mean())
        if depth == 0 or share in (0.0, 1.0):
            return share >= 0.5
        best = None
        for f in range(x.shape[1] - 1, -1, -1):
            values = np.unique(x[:, f])
            for cut in (values[:-1] + values[1:]) / 2:
                left = x[:, f] <= cut
                a, b = y[left], y[~left]
                gini = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
                if best is None or gini < best[0] - 1e-12:
                    best = (gini, f, float(cut), left)
        if best is None:
            return share >= 0.5
        _, f, cut, left = best
        return f, cut, self._grow(x[left], y[left], depth - 1), self._grow(x[~left], y[~left], depth - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        waiting = [(self.node, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            if isinstance(node, bool):
                out[rows] = node
            elif len(rows):
                f, cut, low, high = node
                left = x[rows, f] <= cut
                waiting += [(low, rows[left]), (high, rows[~left])]
        return out


def trained() -> DecisionTree:
    """The tree of the labelled table."""
    data = np.array(LABELLED, dtype=float)
    return DecisionTree(data[:, :-1], data[:, -1])


def _names_furniture(parts: list[str]) -> bool:
    """Whether the words of one name say menu, footer, advert and the like: one does, and each other is
    one too or a mere wrapper. ``has-sidebar`` or ``social-science`` does not."""
    return any(p in _OTHER_WORDS for p in parts) and all(p in _OTHER_WORDS or p in _WRAPPER_WORDS for p in parts)


def _zone(tag: str, attributes: str, around: int) -> int:
    """What a container holds, from its tag and names, inside a container of kind ``around``.

    Within furniture ``main`` is article again, and ``article`` where only a layout name such as sidebar made it
    furniture (comments and teasers come as ``article`` too); a header is the article's only inside an
    article's tag."""
    if around in (LAYOUT, OTHER) and (tag == "main" or tag == "article" and around == LAYOUT):
        return ARTICLE
    if around == OTHER:
        return OTHER
    names: set[str] = set()
    other = foreign = hidden = False
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            if key.lower() in ("class", "id", "role"):
                for token in value.strip("\"'").split():
                    parts = [n.lower() for n in _NAME.findall(token)]
                    names.update(parts)
                    if _names_furniture(parts):
                        other = True
                        foreign = foreign or not _FOREIGN_WORDS.isdisjoint(parts)
            elif key.lower() == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
        hidden = hidden or bool(re.search(r"\shidden(?=\s|/|\Z|=)", attributes))
    if hidden or _TAG_ZONE.get(tag) == OTHER:
        return OTHER
    if other and tag not in ("body", "html", "article", "main"):
        return OTHER if foreign else LAYOUT
    if around == LAYOUT:
        return LAYOUT
    if tag == "header":
        return around if around == ARTICLE else OTHER
    if tag in _TAG_ZONE:
        return ARTICLE
    if around == PLAIN and names & _MAIN_WORDS and tag not in ("body", "html"):
        return MAIN
    return around


def blocks(page: str) -> tuple[list[str], np.ndarray]:
    """Texts of the flat blocks of a page, in page order, and their features."""
    texts: list[str] = []
    rows: list[tuple[int, float, int, int]] = []
    stack: list[tuple[str, int]] = []
    parts: list[tuple[str, bool]] = []
    zone, links, heading, at, size = PLAIN, 0, 0, 0, len(page)
    lower = None

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                words = len(text.split(" "))
                linked = sum(len(html.unescape(p).split()) for p, inside in parts if inside)
                texts.append(text)
                rows.append((words, min(1.0, linked / words), min(max(zone, OTHER), MAIN), heading))
            parts = []

    while at < size:
        # without another end of a tag the rest is text, up to a comment that is never closed
        found = _TAG.search(page, at) if page.find(">", at) >= 0 else None
        if not found:
            parts.append((re.split("<[!?]", page[at:], maxsplit=1)[0], links > 0))
            break
        if found.start() > at:
            parts.append((page[at : found.start()], links > 0))
        at = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        tag, closing, attributes = name.lower(), bool(found[1] or found[4]), found[3] or found[6] or ""
        if tag in _SILENT and not closing:
            if tag in _RAW or tag in ("head", "select", "button", "object", "audio", "video"):
                if tag == "head":
                    # text of the head is not the page's; its end may be left out
                    lower = lower or page.lower()
                    stop = re.compile(r"</head\s*>|<body[\s>]").search(lower, at)
                    at = (stop.start() if stop and stop[0].startswith("<b") else stop.end()) if stop else at
                elif not attributes.endswith("/"):
                    lower = lower or page.lower()
                    end = lower.find(f"</{tag}", at)
                    at = size if end < 0 else page.find(">", end) + 1 or size
            continue
        if tag == "br" or tag == "wbr" or tag == "img":
            if tag == "br":
                parts.append((" ", False))
            continue
        if tag == "a":
            links = 0 if closing else 1 + len(stack)
            continue
        if tag not in _BLOCK:
            continue
        flush()
        heading = int(tag in _HEADING and not closing)
        if tag not in _CONTAINER:
            continue
        if not closing:
            stack.append((tag, zone))
            zone = _zone(tag, attributes, zone)
        elif any(t == tag for t, _ in stack):
            while stack:
                opened, before = stack.pop()
                zone = before
                if opened == tag:
                    break
            if links > 1 + len(stack):  # a link without an end ends with its container
                links = 0
    flush()
    n = len(rows)
    own = np.array(rows, dtype=float).reshape(n, 4)
    edge = np.zeros((1, 2))
    padded = np.concatenate([edge, own[:, :2], edge])
    return texts, np.concatenate([own[:, :2], padded[:-2], padded[2:], own[:, 2:]], axis=1)


def main_text(page: str, tree: DecisionTree) -> str:
    """The article's blocks joined by an empty line."""
    texts, features = blocks(page)
    if not texts:
        return ""
    return "\n\n".join(t for t, keep in zip(texts, tree.predict(features), strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null or empty html, and pages without an article block, give an empty text of 0 characters; a
    null page_id or url stays null; repeated rows are rows of their own; other columns are ignored.
    Bytes that are no UTF-8 become U+FFFD. Pages are read whole and independently, so no page waits
    for another and nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained()
        for batch in batches:
            found = [main_text(h.decode("utf-8", "replace"), tree) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    sent = pages.select("page_id", "url", text_bytes("html").alias("html"))
    return sent.mapInArrow(lean(run), "page_id long, url string, text string, n_chars long")


def op4_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op4_html_blocks": op4_html_blocks}
