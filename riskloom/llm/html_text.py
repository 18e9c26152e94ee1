"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut where a block-level element begins or ends. Every block is
described by its words and link density, those of the blocks before and after
it, whether an element around it is one of article text or of page furniture (by
its name, class, id or role), and how much of the page's plain text stands in
article elements. A decision tree fitted on the labelled table of
``page_labels`` tells main text from the rest; the tree is a handful of arrays,
evaluated for all blocks of a batch at once.

``extract`` keeps every other column out of the way and returns one row per
page. NULL html is the empty page, which has the empty text. Comments, scripts,
styles and other elements without text are skipped, whatever stands in them; one
that is never closed hides the rest of the page. Character references are
decoded after the cut, as browsers do, so a decoded sign never opens a tag.
White space, the no-break space included, becomes one space. Pages are cut one
by one in time linear in their length: memory is that of the longest page and of
its blocks, a few times its text. An empty table gives no rows, repeated rows
give repeated rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskloom.llm import page_labels
from riskloom.llm.text import pieces, utf8

# Elements by what they do to text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr input br script style noscript template iframe object svg math canvas audio video textarea "
    "select option button datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template iframe object svg math canvas audio video textarea select option button head title datalist".split())
# Of these only their own end tag counts, nothing within them is a tag.
RAW = frozenset("script style textarea title iframe noscript".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE = frozenset("nav footer aside form dialog menu".split())
ARTICLE = frozenset("article main".split())
# Words in class, id and role that mark page furniture or article text.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner breadcrumb breadcrumbs byline comment comments commentlist "
    "consent contentinfo cookie cookies copyright dialog disqus disclaimer footer form gdpr header login masthead menu menubar modal nav "
    "navbar navbox navigation newsletter notice notification pager pagination popup popover promo promoted promotion recommended related "
    "reply replies respond search share sharing sharebar sidebar signup social sponsor sponsored subscribe subscription tags teaser "
    "toolbar topbar widget widgets alert skip".split())
ARTICLE_WORDS = frozenset("article articlebody main content entry post story text body maincontent".split())
# Such words tell of a page's layout, not of what stands in the element.
LAYOUT_WORDS = frozenset("has with no layout page wrapper wrap container site grid row col columns outer inner".split())

TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/>]*)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""[\s/]*(?:>|([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>]*)))?)""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "article", "article_share",
            "heading")
DEPTH = 8


@dataclass
class Block:
    text: str
    words: int
    linked: int
    furniture: int
    article: int
    heading: int


@dataclass
class _Open:
    name: str
    furniture: int
    article: int
    heading: int
    link: bool
    silent: bool
    header: bool


@dataclass
class _Page:
    """Blocks of one page as they are cut."""

    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def flush(self, around: _Open) -> None:
        if self.parts:
            words = "".join(self.parts).split()
            if words:
                furniture = around.furniture
                if around.header and not furniture and not (around.article and around.heading):
                    furniture = 1
                self.blocks.append(Block(" ".join(words), len(words), min(self.linked, len(words)), furniture, around.article,
                                         around.heading))
            self.parts, self.linked = [], 0


def _marks(name: str, attributes: dict[str, str]) -> tuple[int, int]:
    """(furniture, article) as the element's own name and attributes tell."""
    if name in ("html", "body"):
        return 0, 0
    furniture, article = int(name in FURNITURE), int(name in ARTICLE)
    if attributes:
        if "hidden" in attributes or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I) \
                or attributes.get("aria-hidden", "").lower() == "true":
            return 1, 0
        for key in ("class", "id", "role", "itemprop", "aria-label"):
            for value in attributes.get(key, "").split():
                words = {w.lower() for w in NAME_PARTS.findall(value)} | {value.lower()}
                if not words & LAYOUT_WORDS:
                    if words & FURNITURE_WORDS:
                        furniture = 1
                    elif words & ARTICLE_WORDS:
                        article = 1
    return furniture, article and not furniture


def _attributes(html: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes that follow a tag's name and the place behind the tag."""
    found: dict[str, str] = {}
    end = len(html)
    while at < end:
        match = ATTRIBUTE.match(html, at)
        if match is None or match.end() == at:
            at += 1  # a sign that is no part of an attribute
            continue
        at = match.end()
        if match[1] is None:
            if html[at - 1] == ">":
                return found, at
            continue
        value = match[2] if match[2] is not None else match[3] if match[3] is not None else match[4] or ""
        found.setdefault(match[1].lower(), unescape(value))
    return found, end


def blocks(html: str) -> list[Block]:
    """The text blocks of a page, in order."""
    page, size, at = _Page(), len(html), 0
    root = _Open("", 0, 0, 0, False, False, False)
    stack, names = [root], Counter()

    def text(begin: int, stop: int) -> None:
        top = stack[-1]
        if begin < stop and not top.silent:
            piece = html[begin:stop]
            if "&" in piece:
                piece = unescape(piece)
            page.parts.append(piece)
            if top.link:
                page.linked += len(piece.split())

    def close(name: str) -> None:
        """Ends the innermost open element of that name and all within it."""
        while True:
            top = stack.pop()
            names[top.name] -= 1
            if top.name == name:
                return

    while at < size:
        begin = html.find("<", at)
        if begin < 0:
            text(at, size)
            break
        match = TOKEN.match(html, begin)
        if match is None:  # a plain sign
            text(at, begin + 1)
            at = begin + 1
            continue
        text(at, begin)
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        attributes, at = _attributes(html, at)
        if name not in INLINE:
            page.flush(stack[-1])
        elif name in ("br", "wbr", "input", "img"):
            if name == "br":
                page.parts.append("\n")
            continue
        if match[1]:
            if names[name] > 0:
                close(name)
            continue
        if name in VOID:
            continue
        # A paragraph ends where a block begins, a list item where the next does, a link where the next does.
        if name not in INLINE and names["p"] > 0:
            close("p")
        if name in ("li", "td", "th", "tr", "dt", "dd", "a", "option") and stack[-1].name == name:
            close(name)
        top = stack[-1]
        furniture, article = _marks(name, attributes)
        header = name == "header" or top.header
        stack.append(_Open(name, top.furniture or furniture, top.article or article,
                           int(top.heading or name in HEADINGS), top.link or name == "a", top.silent or name in SILENT, header))
        names[name] += 1
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = end.start() if end else size
    page.flush(stack[-1])
    return page.blocks


def features(found: list[Block]) -> np.ndarray:
    """A row of ``FEATURES`` per block of one page."""
    n = len(found)
    words = np.array([b.words for b in found], float)
    density = np.array([b.linked / b.words for b in found], float)
    furniture = np.array([b.furniture for b in found], float)
    article = np.array([b.article for b in found], float)
    plain = np.array([(b.words - b.linked) * (not b.furniture) for b in found], float)
    share = float((plain * article).sum() / plain.sum()) if plain.sum() else 0.0

    def moved(column: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(n)
        if by > 0:
            out[1:] = column[:-1]
        else:
            out[:-1] = column[1:]
        return out

    return np.stack([words, density, moved(words, 1), moved(density, 1), moved(words, -1), moved(density, -1), furniture, article,
                     np.full(n, share), np.array([b.heading for b in found], float)], axis=1)


@dataclass(frozen=True)
class Tree:
    """Nodes in a row; a leaf has feature -1 and itself as both children."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def main(self, x: np.ndarray) -> np.ndarray:
        """Whether each row is main text."""
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(DEPTH):
            goes_left = x[rows, np.maximum(self.feature[node], 0)] <= self.threshold[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return self.value[node] > 0.5


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = DEPTH, least: int = 2) -> Tree:
    """A binary tree by Gini impurity; equal gains go to the earlier feature and the lower threshold."""
    feature, threshold, left, right, value = [], [], [], [], []

    def grow(rows: np.ndarray, level: int) -> int:
        node = len(feature)
        feature.append(-1), threshold.append(0.0), left.append(node), right.append(node), value.append(float(y[rows].mean()))
        best = (1e-12, None)
        if level < depth and 0 < y[rows].mean() < 1:
            whole = len(rows) * y[rows].mean() * (1 - y[rows].mean())
            for j in range(x.shape[1]):
                order = rows[np.argsort(x[rows, j], kind="stable")]
                values, yes = x[order, j], np.cumsum(y[order])
                n = np.arange(1, len(rows) + 1)
                cuts = np.flatnonzero((values[1:] > values[:-1]) & (n[:-1] >= least) & (len(rows) - n[:-1] >= least))
                for i in cuts.tolist():
                    a, b = yes[i], yes[-1] - yes[i]
                    gain = whole - a * (1 - a / n[i]) - b * (1 - b / (len(rows) - n[i]))
                    if gain > best[0] + 1e-12:
                        best = (gain, (j, (values[i] + values[i + 1]) / 2))
        if best[1] is not None:
            j, cut = best[1]
            feature[node], threshold[node] = j, cut
            left[node] = grow(rows[x[rows, j] <= cut], level + 1)
            right[node] = grow(rows[x[rows, j] > cut], level + 1)
        return node

    grow(np.arange(len(y)), 0)
    return Tree(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value))


def fit_pages(labelled: list[tuple[str, list[int]]] | None = None) -> Tree:
    """The tree of labelled pages: (HTML, label per block). Blocks and labels must be equally many."""
    xs, ys = [], []
    for html, labels in page_labels.pages() if labelled is None else labelled:
        found = blocks(html)
        if len(found) != len(labels):
            raise ValueError(f"a labelled page has {len(found)} blocks and {len(labels)} labels")
        xs.append(features(found))
        ys += labels
    return fit_tree(np.concatenate(xs), np.array(ys, float))


def main_texts(pages: list[str], tree: Tree) -> list[str]:
    """The main text of each page."""
    cut = [blocks(html) for html in pages]
    rows = [features(found) for found in cut if found]
    chosen = iter(tree.main(np.concatenate(rows)).tolist() if rows else [])
    return [" ".join([b.text for b in found if next(chosen)]) for found in cut]


def extract(pages: DataFrame, tree: Tree | None = None, id_column: str = "page_id", url_column: str = "url",
            html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    tree = tree or fit_pages()
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), utf8(F.col(html_column)).alias("html"))
    schema = StructType([StructField("page_id", rows.schema["page_id"].dataType), StructField("url", rows.schema["url"].dataType),
                         StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "html"):
            texts = main_texts([h.decode("utf-8", "replace") for h in piece.column("html").to_pylist()], tree)
            yield pa.RecordBatch.from_arrays(
                [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)


def template_sql() -> str:
    """Main texts of pages that have one plain article element, as SQL: what the tree has to find among the given pages."""
    cut = r"""regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1),
                '</?(p|h1)>|<br>', ' ', 'g'), '</?b>', '', 'g')"""
    for pattern, sign in (("&quot;?", '"'), ("&lt;?", "<"), ("&gt;?", ">"), ("&#39;|&#x27;", "''"), ("&amp;?", "&")):
        cut = f"regexp_replace({cut}, '{pattern}', '{sign}', 'g')"
    return f"""
    WITH cut AS (SELECT page_id, url, trim(regexp_replace({cut}, '\\s+', ' ', 'g')) AS text FROM pages)
    SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM cut"""
