"""Operator 5: attributes without quotes, deep and broken pages, blocks, and the decoding against all labellings."""

from __future__ import annotations

import itertools
import time

import numpy as np
import pytest

from cohortex.llm import html_extract
from cohortex.llm.html_extract import Page


def texts_under(page, tag):
    return ["".join(t for at, t, _ in page.texts if at == i) for i, name in enumerate(page.tags) if name == tag]


def test_a_slash_of_an_unquoted_value_does_not_close_the_element():
    page = Page("<p>See <a href=/home/>Home</a> and <a href='/x'/>rest</p>")
    assert texts_under(page, "a") == ["Home", ""]
    assert Page("<p><span/>x<b class=a/>bold</b></p>").tags.count("b") == 1
    assert texts_under(Page("<p><b class=a/>bold</b></p>"), "b") == ["bold"]


@pytest.mark.parametrize("page", ["<div>" * 30_000 + "x" + "</p>" * 30_000, "<div>" * 20_000 + "<li>x" * 5_000, "<p><span>" * 10_000, "</a>" * 30_000])
def test_deep_and_broken_pages_take_linear_time(page):
    began = time.time()
    parsed = Page(page)
    assert time.time() - began < 5 and parsed.tags[0] == "#root"


def test_blocks_are_joined_by_two_line_feeds():
    page = Page("<article><h1>One\n two</h1>&amp;<p>a <b>b</b> c<br>d</p>tail<ul><li>x<li>y</ul></article>")
    assert html_extract.blocks(page, np.ones(len(page.tags), dtype=bool)) == "One two\n\n&\n\na b c d\n\ntail\n\nx\n\ny"


def best_labelling(page, odds):
    """The largest total of any choice of keep, drop or split per element, a choice above deciding all below."""
    n = len(page.tags)
    keep = np.where([t in html_extract.SKIPPED for t in page.tags], -1e9, -np.logaddexp(0, -odds))
    drop = -np.logaddexp(0, odds)
    own = [any(at == i and t != " " for at, t, _ in page.texts) for i in range(n)]
    below = [[j for j in range(n) if j == i or j in _under(page, i)] for i in range(n)]
    best = None
    for choice in itertools.product((0, 1, 2), repeat=n):
        total, decided = 0.0, [2] * n
        for i in range(n):
            above = decided[page.parents[i]] if i else 2
            decided[i] = above if above != 2 else choice[i]
            if above != 2:
                if choice[i] != above:
                    break
                continue
            if choice[i] == 2:
                total += (max(keep[i], drop[i]) if own[i] else 0.0) - 0.2
            else:
                total += sum((keep, drop)[choice[i]][j] for j in below[i])
        else:
            if best is None or total > best[0] + 1e-9:
                best = total, tuple(decided[i] == 0 or (decided[i] == 2 and keep[i] > drop[i]) for i in range(n))
    return best


def _under(page, i):
    found = set()
    for j in range(i + 1, len(page.tags)):
        if page.parents[j] == i or page.parents[j] in found:
            found.add(j)
    return found


def test_decoding_is_the_best_labelling():
    r = np.random.default_rng(0)
    sources = ["<div><p>a</p><p>b</p></div><nav>c</nav>", "<section>x<div>y<p>z</p></div></section>", "<div><div><div>deep</div></div>t</div>", "<ul><li>a<li>b</ul><script>s</script>"]
    for source in sources * 12:
        page = Page(source)
        odds = r.normal(size=len(page.tags)) * 2
        want, kept = best_labelling(page, odds)
        got = html_extract.decode(page, odds)
        with_own = [i for i in range(len(page.tags)) if any(at == i and t != " " for at, t, _ in page.texts)]
        assert [bool(got[i]) for i in with_own] == [kept[i] for i in with_own], (source, odds, want)
