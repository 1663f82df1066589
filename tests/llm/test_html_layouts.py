"""Layouts without telling names, layouts never seen, large pages, references across elements."""

import random
import tracemalloc

import numpy as np
import pytest

from bescheid.llm import html_text as H

PLAIN = {
    "<html><body><p>Just a plain page with one paragraph of text.</p></body></html>": "Just a plain page with one paragraph of text.",
    "<html><body><div><div><a href=x>Home</a> <a href=y>About us</a></div></div><div><div><h1>The heading of it</h1><div><p>First paragraph of the story, with some words in it.</p><p>Second paragraph goes on for a while and ends here.</p></div></div></div><div>&copy; 2024 Example Inc.</div></body></html>":
        "The heading of it\nFirst paragraph of the story, with some words in it.\nSecond paragraph goes on for a while and ends here.",
    "<p>AT&am<b>p</b>;T is a company": "AT&amp;T is a company",
    "<b>one<p>two</b> three</p><p>&lt;b&gt; four": "one\ntwo three\n<b> four",
}

STORY = "The town council met on Tuesday and agreed to rebuild the old bridge over the river before winter comes, as many people had asked for."
#: One paragraph beside a form, a paragraph that is a link, comments under a common name.
PLAIN |= {
    f"<body><p>{STORY}</p><form><textarea>draft</textarea><button>Send</button></form></body>": STORY,
    f"<article><p><a href=/x>{STORY}</a></p><p>{STORY}</p></article>": f"{STORY}\n{STORY}",
    f'<article><p>{STORY}</p></article><div id="disqus_thread"><div class="post"><p>Great article, thanks!</p></div></div>': STORY,
}


@pytest.mark.parametrize("page", PLAIN)
def test_plain_pages(page):
    assert H.main_texts([page], H.labeller()) == [PLAIN[page]]


def accuracy(net, family, n=150, seed=99):
    r, right, total = random.Random(seed), 0, 0
    for _ in range(n):
        page, main = H._page(r, family)
        if found := H.blocks(page):
            p = net.labels(*H._padded([net.projected(found)]))[:, 0]
            right += int(((p >= 0.5) == np.array([b.text in main and not b.titled for b in found])).sum())
            total += len(found)
    return right / total


@pytest.mark.parametrize("family", H.FAMILIES)
def test_new_pages_of_each_family(family):
    assert accuracy(H.labeller(), family) >= 0.98


@pytest.mark.parametrize("family", ["table", "divs"])
def test_families_never_seen(family):
    assert accuracy(H.labeller(without=family), family) >= 0.95


def test_projections_equal_dense_rows():
    net, r = H.labeller(), random.Random(1)
    for _ in range(20):
        found = H.blocks(H._page(r, r.choice(list(H.FAMILIES)))[0])
        x = H.vectors(found)
        assert np.allclose(net.projected(found, part=7), np.concatenate((x @ net.p["x0"], x @ net.p["x1"]), axis=1), atol=1e-4)


def test_memory_of_a_large_page():
    found = H.blocks("<body>" + "<p>some words of a line here.</p>" * 50_000)
    tracemalloc.start()
    z = H.labeller().projected(found)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(z) == 50_000 and peak < 125e6


def test_deep_and_unclosed_pages_are_quick():
    for page in ("<div>" * 20_000 + "x", "<b>" * 20_000 + "<p>a" * 2000, "<b><div>" * 3000 + "x" + "</b>" * 3000):
        assert H.blocks(page)
