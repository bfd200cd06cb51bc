"""Main text of web pages: flat text blocks classified by a decision tree.

A page is read once, from left to right, into blocks of text between block-level tags. A block is
described by its own word count and link density, those of the blocks before and after it, and by
where it stands: inside an article or main element, inside an element whose tag, class or id speaks
against the article (1 for menus, footers, notices, adverts and the like, ``HALF`` for names that articles use
too), in a heading, in a list. The tree is fitted on the labelled blocks below.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from tallyline.llm.common import in_chunks, ship_package, whole_text
from tallyline.llm.trees import Tree

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*(?:>|\Z))""",
    re.DOTALL,
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
ID = re.compile(r"""\bid\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
RAW = set("script style textarea title noscript iframe".split())  # run to the end of the page if nothing closes them
HIDDEN = set("script style noscript template iframe title textarea select button svg math object canvas video audio head".split())
CONTAINERS = set(
    "body div section article main nav header footer aside form menu dialog fieldset figure details table ul ol dl blockquote center".split()
)
BREAKS = CONTAINERS | set("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption figcaption pre hr address summary legend tbody thead tfoot html".split())
OUTSIDE_TAGS = set("nav footer aside form menu dialog".split())
ARTICLE_TAGS = {"article", "main"}
ARTICLE_WORDS = {"main", "article"}
OUTSIDE_WORDS = set(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice
    notices alert gdpr disclaimer menu nav navbar navigation breadcrumb breadcrumbs sidebar footer header masthead comment comments
    disqus respond replies reply share sharing social related recommended newsletter subscribe subscription signup login search
    popup modal overlay toolbar pagination pager widget widgets rail copyright legal skip contentinfo complementary""".split()
)
HALF = 0.5
#: Names that may as well be those of a part of the article.
HALF_WORDS = set("share sharing social related recommended alert legal skip search rail widget widgets".split())
#: On a paragraph, heading or list item these speak against that block alone.
ADVERT_WORDS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion".split())
#: An article element may itself be a reader's comment, a teaser or an advert.
NO_ARTICLE_WORDS = set("comment comments reply replies related teaser promo ad ads advert sponsored".split())

ARTICLE_WEIGHT = 3  # what stands in an article with nothing against it counts so many times in the fit
DEPTH = 10
FEATURES = "article outside heading listed words_before words words_after links_before links links_after".split()
# Labelled blocks in the order of FEATURES, then 1 for main text.
LABELLED = [
    # Articles: paragraphs, short ones, titles, lists, quotations with links
    (1, 0, 1, 0, 6, 9, 60, 0.9, 0, 0, 1), (1, 0, 1, 0, 0, 4, 12, 0, 0, 0, 1), (1, 0, 0, 0, 9, 80, 75, 0, 0, 0, 1),
    (1, 0, 0, 0, 60, 1, 2, 0, 0, 0, 1), (1, 0, 0, 0, 1, 1, 1, 0, 0, 0, 1), (1, 0, 0, 0, 120, 45, 0, 0.1, 0.2, 0, 1),
    (1, 0, 0, 0, 40, 6, 50, 0, 1, 0, 1), (1, 0, 0, 0, 200, 300, 8, 0, 0, 0.2, 1), (1, 0, 0, 1, 30, 5, 6, 0, 0, 0, 1),
    (1, 0, 0, 1, 6, 12, 40, 0, 0.1, 0, 1), (1, 0, 0, 1, 7, 3, 4, 0, 1, 0, 1), (1, 0, 1, 0, 70, 3, 90, 0, 1, 0, 1),
    (1, 0, 0, 0, 3, 2, 10, 1, 0, 0.9, 1), (1, 0, 0, 0, 90, 30, 3, 0, 0.3, 1, 1), (1, 0, 1, 0, 6, 1, 1, 1, 0, 0, 1),
    (1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1), (1, 0, 0, 0, 0, 5, 0, 0, 0, 0, 1), (1, 0, 0, 0, 0, 2, 30, 0, 0, 0, 1),
    (1, 0, 0, 0, 12, 25, 12, 1, 0.6, 1, 1), (1, 0, 1, 0, 4, 5, 3, 1, 1, 0.1, 1), (1, 0, 0, 0, 8, 15, 9, 0, 0, 1, 1),
    # Inside an article: its last lines before menus and footers, and its own lists of links
    (1, 0, 0, 0, 50, 2, 3, 0, 0, 1, 1), (1, 0, 0, 0, 30, 6, 2, 0, 0, 1, 1), (1, 0, 0, 1, 6, 4, 2, 0, 0, 1, 1),
    (1, 0, 1, 0, 1, 5, 1, 1, 0, 0, 1), (1, 0, 1, 0, 2, 8, 3, 1, 0, 0, 1), (1, 0, 0, 0, 1, 20, 2, 1, 0, 0, 1),
    (1, 0, 0, 0, 2, 1, 1, 1, 0, 0, 1), (1, 0, 0, 0, 3, 2, 0, 1, 0, 0, 1), (1, 0, 0, 0, 2, 3, 2, 1, 0, 1, 1),
    (1, 0, 0, 1, 3, 3, 3, 1, 1, 1, 1), (1, 0, 0, 1, 2, 4, 3, 1, 1, 1, 1), (1, 0, 0, 0, 5, 1, 2, 1, 1, 1, 1),
    # Inside menus, footers, sidebars, forms, adverts, comments, whatever they hold
    (0, 1, 0, 1, 0, 1, 1, 0, 1, 1, 0), (0, 1, 0, 1, 2, 2, 2, 1, 1, 1, 0), (0, 1, 0, 0, 1, 9, 10, 1, 0, 0, 0),
    (0, 1, 0, 0, 40, 8, 0, 0, 0, 0, 0), (0, 1, 0, 0, 90, 60, 70, 0, 0, 0, 0), (0, 1, 1, 0, 5, 3, 40, 1, 0, 0, 0),
    (1, 1, 0, 0, 80, 12, 90, 0, 0, 0, 0), (1, 1, 0, 0, 80, 70, 90, 0, 0, 0, 0), (1, 1, 0, 1, 30, 2, 2, 0, 1, 1, 0),
    (1, 1, 1, 0, 30, 2, 20, 0, 0, 0, 0), (0, 1, 0, 0, 20, 150, 30, 0, 0.05, 0, 0), (0, 1, 0, 1, 12, 25, 9, 0.2, 0.1, 0.4, 0),
    (0, 1, 0, 0, 200, 20, 200, 0, 0, 0, 0), (1, 1, 0, 0, 9, 200, 100, 0, 0, 0, 0), (0, 1, 1, 0, 0, 2, 5, 0, 0, 1, 0),
    # Under a name that articles use too: texts stay, short lines and lists of links go
    (0, 0.5, 0, 0, 3, 40, 30, 0, 0, 0, 1), (0, 0.5, 0, 0, 60, 25, 3, 0, 0.1, 0, 1), (0, 0.5, 0, 0, 0, 80, 60, 0, 0, 0, 1),
    (1, 0.5, 0, 0, 50, 30, 40, 0, 0, 0, 1), (1, 0.5, 0, 0, 5, 60, 70, 0, 0.1, 0, 1), (1, 0.5, 0, 0, 80, 22, 90, 0, 0, 0, 1),
    (0, 0.5, 0, 0, 40, 3, 2, 0, 1, 1, 0), (0, 0.5, 0, 1, 2, 2, 2, 1, 1, 1, 0), (0, 0.5, 0, 0, 60, 8, 3, 0, 0, 1, 0),
    (0, 0.5, 1, 0, 60, 2, 6, 0, 0, 1, 0), (1, 0.5, 0, 1, 60, 6, 6, 0, 1, 1, 0), (1, 0.5, 1, 0, 80, 2, 5, 0, 0, 1, 0),
    (1, 0.5, 0, 0, 80, 10, 3, 0, 0, 0.5, 0), (0, 0.5, 0, 1, 5, 24, 20, 1, 0.9, 0.9, 0), (1, 0.5, 0, 0, 30, 40, 4, 0, 0.8, 1, 0),
    # Pages without article elements: long texts, short ones among them, titles above them
    (0, 0, 0, 0, 6, 80, 75, 0.3, 0, 0, 1), (0, 0, 0, 0, 80, 40, 60, 0, 0.1, 0, 1), (0, 0, 0, 0, 60, 25, 4, 0, 0, 1, 1),
    (0, 0, 0, 0, 70, 2, 60, 0, 0, 0, 1), (0, 0, 0, 0, 40, 6, 35, 0, 0, 0, 1), (0, 0, 1, 0, 3, 6, 70, 1, 0, 0, 1),
    (0, 0, 1, 0, 50, 3, 60, 0, 0, 0, 1), (0, 0, 0, 0, 4, 30, 3, 1, 0.1, 1, 1), (0, 0, 0, 1, 30, 20, 18, 0, 0, 0, 1),
    (0, 0, 1, 0, 0, 9, 30, 0, 0, 0.1, 1), (0, 0, 0, 0, 0, 50, 0, 0, 0, 0, 1), (0, 0, 0, 0, 0, 7, 0, 0, 0, 0, 1),
    (0, 0, 0, 0, 0, 2, 0, 0, 0, 0, 1), (0, 0, 0, 1, 25, 5, 30, 0, 0, 0, 1),
    (0, 0, 0, 1, 24, 5, 2, 0, 0, 0, 1), (0, 0, 0, 1, 5, 2, 20, 0, 0, 0, 1), (0, 0, 0, 1, 3, 4, 3, 0, 0, 0, 1),
    (0, 0, 0, 0, 22, 5, 2, 0, 0, 0, 1), (0, 0, 0, 0, 30, 2, 3, 0, 0, 0, 1), (0, 0, 0, 0, 2, 3, 40, 0, 0, 0, 1),
    (0, 0, 1, 0, 1, 1, 40, 1, 0, 0, 1), (0, 0, 1, 0, 2, 4, 30, 1, 0, 0.1, 1), (0, 0, 1, 0, 3, 2, 80, 1, 0, 0, 1),
    (0, 0, 0, 0, 0, 3, 0, 0, 0, 0, 1), (0, 0, 0, 0, 0, 4, 12, 0, 0, 0, 1), (0, 0, 0, 0, 12, 5, 30, 0, 0, 0, 1),
    (0, 0, 0, 0, 55, 38, 0, 0, 0, 0, 1), (0, 0, 0, 0, 40, 90, 0, 0, 0.1, 0, 1), (0, 0, 0, 0, 4, 33, 0, 0, 0, 0, 1),
    (0, 0, 0, 0, 36, 1, 44, 0, 0, 0, 1), (0, 0, 0, 0, 60, 1, 30, 0, 0, 0, 1), (0, 0, 0, 0, 30, 3, 30, 0, 0, 0, 1),
    (0, 0, 0, 0, 70, 30, 3, 0, 0, 1, 1), (0, 0, 0, 0, 3, 60, 36, 1, 0, 0, 1), (0, 0, 0, 0, 20, 70, 1, 0, 0, 0, 1),
    # ... and what surrounds them
    (0, 0, 0, 0, 1, 1, 1, 1, 1, 0, 0), (0, 0, 0, 1, 2, 2, 4, 1, 1, 0, 0), (0, 0, 0, 0, 3, 2, 60, 1, 1, 0, 0),
    (0, 0, 0, 0, 0, 2, 5, 0, 1, 0, 0), (0, 0, 0, 0, 4, 6, 30, 0.8, 0.9, 0.1, 0), (0, 0, 0, 1, 3, 1, 9, 1, 1, 0, 0),
    (0, 0, 0, 0, 2, 3, 2, 1, 1, 1, 0), (0, 0, 0, 1, 2, 2, 3, 1, 1, 1, 0), (0, 0, 0, 0, 60, 4, 2, 0, 0.8, 1, 0),
    (0, 0, 0, 0, 60, 5, 0, 0, 0, 0, 0), (0, 0, 0, 0, 3, 12, 3, 1, 0.9, 1, 0), (0, 0, 0, 0, 0, 3, 2, 0, 0, 1, 0),
    (0, 0, 0, 0, 4, 20, 5, 0.9, 0.8, 0.9, 0), (0, 0, 1, 0, 4, 2, 3, 1, 0, 1, 0), (0, 0, 0, 1, 1, 30, 2, 1, 0.9, 1, 0),
    (0, 0, 0, 0, 3, 4, 3, 0.5, 0, 1, 0), (0, 0, 1, 0, 3, 3, 2, 1, 1, 1, 0), (0, 0, 0, 0, 2, 1, 0, 1, 0, 0, 0),
]


@cache
def fitted_tree() -> Tree:
    table = np.array(LABELLED, float)
    plain_article = (table[:, 0] == 1) & (table[:, 1] == 0)
    table = np.repeat(table, np.where(plain_article, ARTICLE_WEIGHT, 1), axis=0)
    return Tree(table[:, :-1], table[:, -1], DEPTH)


def _names(rest: str) -> set[str]:
    return {w for found in NAMED.findall(rest) for w in re.split(r"[^a-z]+", found[1].lower())} if "=" in rest else set()


def _standing(tag: str, rest: str, in_article: bool) -> tuple[bool, float]:
    """Whether an element is an article, and how much speaks against its being part of one."""
    if tag == "section" and in_article:  # its id is where links to a part of the article go
        rest = ID.sub("", rest)
    words = _names(rest)
    if tag in ARTICLE_TAGS:
        return True, float(bool(words & NO_ARTICLE_WORDS))
    if tag == "body":
        return False, 0.0
    article = bool(words & ARTICLE_WORDS)
    if tag in OUTSIDE_TAGS or (not article and words & (OUTSIDE_WORDS - HALF_WORDS)):
        return article, 1.0
    return article, HALF if not article and words & HALF_WORDS else 0.0


class Blocks:
    """Collects the blocks of one page: text, words, words in links, article, outside, heading, listed."""

    def __init__(self) -> None:
        self.found: list[tuple] = []
        self.stack: list[tuple[str, bool, float]] = []  # open containers: tag, inside an article, what speaks against it
        self.open_tags: Counter[str] = Counter()
        self.advert = False
        self.pieces: list[str] = []
        self.linked: list[str] = []
        self.in_link = self.heading = self.item = False

    def text(self, text: str) -> None:
        self.pieces.append(text)
        if self.in_link:
            self.linked.append(text)

    def close_block(self) -> None:
        text = " ".join(html.unescape("".join(self.pieces)).split()) if self.pieces else ""
        if text:
            _, article, outside = self.stack[-1] if self.stack else ("", False, 0.0)
            outside = 1.0 if self.advert else outside
            words, linked = len(text.split()), len(html.unescape(" ".join(self.linked)).split())
            self.found.append((text, words, min(1.0, linked / words), article, outside, self.heading, self.item))
        self.pieces.clear()
        self.linked.clear()

    def open(self, tag: str, rest: str) -> None:
        if tag == "a":
            self.in_link = True
        elif tag == "br":
            self.text(" ")
        elif tag in BREAKS:
            self.close_block()
            self.heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            self.item = tag == "li" or (self.item and tag not in CONTAINERS)
            self.advert = tag not in CONTAINERS and bool(_names(rest) & ADVERT_WORDS)
            if tag in CONTAINERS:
                self._enter(tag, rest)

    def _enter(self, tag: str, rest: str) -> None:
        if tag in ARTICLE_TAGS:  # a menu or footer left open ends here
            while self.stack and self.stack[-1][0] in ("nav", "footer", "ul", "ol", "menu"):
                self._leave()
        _, in_article, is_outside = self.stack[-1] if self.stack else ("", False, 0.0)
        article, outside = _standing(tag, rest, in_article)
        if tag == "header" and not in_article:  # one inside the article may hold its title
            outside = 1.0
        self.stack.append((tag, in_article or article, max(is_outside, outside)))
        self.open_tags[tag] += 1

    def _leave(self) -> str:
        tag = self.stack.pop()[0]
        self.open_tags[tag] -= 1
        return tag

    def close(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        elif tag in BREAKS:
            self.close_block()
            self.heading = self.advert = False
            if tag in CONTAINERS or tag == "li":
                self.item = False
            if self.open_tags[tag]:
                while self._leave() != tag:
                    pass


def blocks_of(page: str) -> list[tuple]:
    """The text blocks of a page in page order."""
    blocks, at = Blocks(), 0
    never_closed: set[str] = set()  # hidden elements that nothing closes from here on
    while found := TAG.search(page, at):
        if found.start() > at:
            blocks.text(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            blocks.close(tag)
        elif tag in HIDDEN and not found[3].endswith("/>"):
            if tag != "head" and tag not in never_closed:
                end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
                if end:
                    at = end.end()
                elif tag in RAW:
                    at = len(page)
                else:
                    never_closed.add(tag)
        else:
            blocks.open(tag, found[3])
    blocks.text(page[at:])
    blocks.close_block()
    return blocks.found


def described(blocks: list[tuple]) -> np.ndarray:
    """The features of a page's blocks, in the order of FEATURES."""
    _, words, links, article, outside, heading, item = (np.array(x) for x in zip(*blocks, strict=True))
    around = [np.r_[0, x[:-1]] for x in (words, links)], [np.r_[x[1:], 0] for x in (words, links)]
    columns = [article, outside, heading, item, around[0][0], words, around[1][0], around[0][1], links, around[1][1]]
    return np.column_stack([np.asarray(c, float) for c in columns])


def main_texts(pages: list[str]) -> list[str]:
    """The main text of each page: its blocks of main text in page order, one a line."""
    read = [blocks_of(page) for page in pages]
    features = [described(blocks) for blocks in read if blocks]
    kept = fitted_tree().predict(np.concatenate(features)).tolist() if features else []
    out, at = [], 0
    for blocks in read:
        out.append("\n".join(block[0] for block, keep in zip(blocks, kept[at : at + len(blocks)], strict=True) if keep))
        at += len(blocks)
    return out


def extract_text(df: DataFrame, page: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Adds the main text of the column ``page`` and its length in code points.

    Null and empty pages, and pages without main text, have the empty text. Pages are read whole and
    one by one: repeated rows and other columns stay as they are; columns named as the new ones are
    replaced.
    """

    ship_package(df.sparkSession)

    @arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((found for pages in in_chunks(batch) for found in main_texts(pages)), pa.string())

    return df.withColumn(text, extracted(whole_text(page))).withColumn(n_chars, F.length(text).cast("bigint"))
