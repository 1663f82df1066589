"""Tags of pages against one pattern, and time on pages that close nothing."""

import random
import re
import time

import pytest

from bescheid.llm import html_text as H

#: The tokens as one pattern; on pages that close nothing it takes the square of their length.
PATTERN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"""|<svg\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?<=/)>"""
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-z][a-z0-9-]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<end2>/?)(?P<tag2>[a-z][a-z0-9-]*)[^>]*>"
    r"|<[!?/][^>]*>?"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)


def plain(page):
    for m in PATTERN.finditer(page):
        if m["text"] is not None:
            yield m["text"], "", False, None
        elif m["tag"] or m["tag2"]:
            yield None, m["tag"] or m["tag2"], bool(m["end"] or m["end2"]), m["attrs"]


PARTS = ["<", ">", "</", "<a ", "<p>", "</p>", "<svg", "/>", "</svg>", "<script", "</script >", "<!--", "-->", "<!", "<?", '"', "'", "x", " ", "=", "<SVG a='/'", "text", "<textarea-x>", "\n", "é"]


def test_tokens_equal_the_pattern():
    r = random.Random(8)
    for k in range(30_000):
        page = "".join(r.choice(PARTS) for _ in range(r.randint(0, 12)))
        assert list(H._tokens(page)) == list(plain(page)), page
        if k % 3 == 0:  # with the ends worked out from the back at once
            ends = H._Ends(page)
            ends._all()
            for at in range(len(page)):
                m = H._ATTRIBUTES.match(page, at)
                assert ends.after(at) == (m.end() if m else -1), (page, at)


def test_tokens_of_the_tables(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        assert list(H._tokens(r.html or "")) == list(plain(r.html or ""))


@pytest.mark.parametrize("what", ["<svg ", '<a x="y', '<a "', "<p>", '<a ">"', "<svg '></svg>", "<!--", "</", "<", "<script>", '<b "x" \'', "<p><a '>", "</p", "<!x", "<svg/>"])
def test_broken_pages_take_time_in_proportion(what):
    for tail in ("", ">", '">', "'>"):
        took = []
        for size in (250_000, 1_000_000):
            page = what * (size // len(what)) + tail
            began = time.process_time()
            for _ in H._tokens(page):
                pass
            took.append(time.process_time() - began)
        assert took[1] < max(5, 9 * took[0]), (what, tail, took)
