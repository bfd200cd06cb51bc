"""Main texts of pages that names alone don't tell, broken pages, and what the tree takes from its features."""

from __future__ import annotations

import time

import numpy as np
import pytest

from tallyline.llm import pages
from tallyline.llm.trees import Tree

LONG = "the council met on monday evening to talk about the new bridge and the cost of repairs " * 3
MORE = "several residents asked why the work has taken so long and what will happen to the old road " * 2
LONG, MORE = LONG.strip(), MORE.strip()

# Pages without article elements or telling names: (html, main text). They are not among the labelled blocks.
PLAIN = [
    (f"<body><ul><li><a href=a>Home</a><li><a href=b>World</a><li><a href=c>Sport</a></ul><p>{LONG}</p><p>{MORE}</p></body>", f"{LONG}\n{MORE}"),
    (f"<div><a href=a>Front page</a></div><div><h1>Bridge to be rebuilt</h1><p>{LONG}</p><p>Why now?</p><p>{MORE}</p></div>", f"Bridge to be rebuilt\n{LONG}\nWhy now?\n{MORE}"),
    (f"<table><tr><td><a href=a>One story</a></td><td><a href=b>Another story</a></td></tr></table><div>{LONG}</div><div>{MORE}</div>", f"{LONG}\n{MORE}"),
    (f"<p>{MORE}</p><p>{LONG}</p><ol><li><a href=x>Older posts</a><li><a href=y>Newer posts</a></ol>", f"{MORE}\n{LONG}"),
]


@pytest.mark.parametrize(("html", "text"), PLAIN)
def test_pages_without_names(html, text):
    assert pages.main_texts([html]) == [text]


def test_word_counts_and_link_densities_decide_on_such_pages():
    """The same tree without these features takes menus for text or text for menus."""
    blocks = [pages.blocks_of(html) for html, _ in PLAIN]
    rows = np.concatenate([pages.described(b) for b in blocks])
    wanted = [block[0] in text.split("\n") for (_, text), page in zip(PLAIN, blocks, strict=True) for block in page]
    table = np.array(pages.LABELLED, float)
    counts = [i for i, name in enumerate(pages.FEATURES) if name.startswith(("words", "links"))]
    blind = table[:, :-1].copy()
    blind[:, counts] = 0
    rows_blind = rows.copy()
    rows_blind[:, counts] = 0
    assert pages.fitted_tree().predict(rows).tolist() == wanted
    assert Tree(blind, table[:, -1], pages.DEPTH).predict(rows_blind).tolist() != wanted
    named = (rows[:, pages.FEATURES.index("outside")] == 0).tolist()  # what the names alone would say
    assert named != wanted


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f'<article><p>{LONG}</p><p class="advert">Buy this</p><p>{MORE}</p></article>', f"{LONG}\n{MORE}"),
        (f'<article><section id="search"><h2>The search</h2><p>{LONG}</p></section></article>', f"The search\n{LONG}"),
        (f'<article><section id="related-work"><p>{LONG}</p></section></article>', LONG),
        (f'<article><p>{MORE}</p><div class="alert"><p>{LONG}</p></div></article>', f"{MORE}\n{LONG}"),
        (f'<article><p>{MORE}</p><div class="related"><a href=x>More</a></div></article>', MORE),
        (f'<article><p>{MORE}</p><div class="comments"><p>{LONG}</p></div></article>', MORE),
        (f'<article><p>{MORE}</p></article><section id="comments"><p>{LONG}</p></section>', MORE),
        (f'<body><div class="share"><p>{LONG}</p></div><p>{MORE}</p><div class="share"><a href=x>Tweet</a></div></body>', f"{LONG}\n{MORE}"),
    ],
)
def test_names_are_weighed_with_what_stands_under_them(html, text):
    assert pages.main_texts([html]) == [text]


@pytest.mark.parametrize("tag", ["button", "svg", "object", "select", "canvas"])
def test_an_element_left_open_hides_no_more_than_itself(tag):
    found = pages.main_texts([f"<article><p>{LONG}</p><{tag}><p>{MORE}</p></article>"])
    assert found == [f"{LONG}\n{MORE}"]
    closed = pages.main_texts([f"<article><p>{LONG}</p><{tag}>gone</{tag}><p>{MORE}</p></article>"])
    assert closed == found


@pytest.mark.parametrize("tag", ["script", "style", "textarea"])
def test_raw_text_left_open_runs_to_the_end(tag):
    assert pages.main_texts([f"<article><p>{LONG}</p><{tag}>var a = 1; <p>{MORE}</p>"]) == [LONG]


def test_deep_and_broken_nesting_costs_in_proportion():
    def seconds(count):
        page = "<div>" * count + f"<p>{LONG}" + "</section></b></p>" * count + "<svg><button>" * count
        start = time.perf_counter()
        assert pages.main_texts([page]) == [LONG]
        return time.perf_counter() - start

    seconds(100)
    assert seconds(16_000) < 10 * seconds(2_000) + 1
