"""Block features see every open element, every name and every open link."""

import re

import numpy as np

from bescheid.llm import html_text


def nested(outer, inner, names="comments"):
    return "<html><body>" + "<div>" * outer + f'<div class="{names}">' + "<div>" * inner + "<p>First comment, nice text here.</p>" + "</div>" * (outer + inner + 1)


def test_names_in_the_middle_and_at_the_end_of_lists():
    mark = html_text._bucket(".comments", html_text.PATH)
    long = " ".join(f"mt-{w}-auto" for w in "abcdefgh") + " comments"
    for page in (nested(10, 20), nested(200, 200), nested(1, 1, long), nested(10, 20, long)):
        block = html_text.blocks(page)[-1]
        assert mark in block.ids and html_text.vectors([block])[0, mark] == 1
    assert np.array_equal(html_text.vectors(html_text.blocks(nested(3, 2)))[:, mark], html_text.vectors(html_text.blocks(nested(9, 90)))[:, mark])


def test_closed_elements_leave_no_names():
    found = html_text.blocks('<div class="x y"><div class="x"><p>a</div><p>b</div><p>c')
    of = lambda w: html_text._bucket("." + w, html_text.PATH)
    assert [(of("x") in b.ids, of("y") in b.ids, b.tag) for b in found] == [(True, True, "p"), (True, True, "p"), (False, False, "p")]


def test_deep_text_in_a_link_is_linked():
    inner = "<b><i><u><em><strong>"
    assert [b.linked for b in html_text.blocks(f"<a href=x>{inner}text{re.sub('<', '</', inner)}</a><p>after")] == [1.0, 0.0]
    many = "<span>" * 12
    assert [b.linked for b in html_text.blocks(f"<a href=x>{many}text</a><p>after")] == [1.0, 0.0]
    assert [b.linked for b in html_text.blocks("<a name=x><div><p>in</p></div><a href=y>link</a><p>after")] == [1.0, 1.0, 0.0]


def test_svg_closed_by_itself_drops_nothing():
    page = "<p>before <svg class=icon title='a>b'/> it</p><p>article</p>{}<p>end"
    for more in ("", "<svg><text>drawn</text></svg>"):
        assert [b.text for b in html_text.blocks(page.format(more))] == ["before it", "article", "end"]
    assert [b.text for b in html_text.blocks("<p>x<svg a=b><path d='1'/></svg>y")] == ["xy"]
