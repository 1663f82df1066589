"""Links, headings and texts of pages, sane and broken; time in proportion to the page."""

import re
import time

import pytest
from pyspark.sql import functions as F

from bescheid.functions import markup
from bescheid.operators import discovery, links
from bescheid.sources import store

#: What the links of a page were before they were read in one pass; broken pages took it the square of their length.
ANCHOR = re.compile(r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))[^>]*>([^<]*(?:<(?!/a>|a\s)[^<]*)*)""")

PAGES = [
    '<a href="x">one</a> <A class=b HREF = \'y z\'>two <b>bold</b></A><a href=plain>three</a>', '<a name="n">no</a><a data-href="q">no</a><a href="">empty</a>', '<a href="a>b" title="t">gt</a><a title="t" href="c">after</a>',
    '<a href="x"><img src="i"></a><abbr href="z">no</abbr><a\n\thref="n">newline</a>', "<a href='unclosed>t</a>", "<a href=\"q\">open <a href='r'>next</a>", "no links", "", '<a href="x"', '<a href="p">tail', "<p><a href=u>x < y</a> < z",
]


def test_links_equal_the_pattern(spark):
    df = spark.createDataFrame(list(enumerate(PAGES)), "page_id int, html string").withColumn("url", F.lit("http://h/"))
    got = {}
    for r in links.links(df).orderBy("page_id", "pos").collect():
        got.setdefault(r.page_id, []).append((r.pos, r.href, r.text))
    for i, p in enumerate(PAGES):
        found = [(m[1] or m[2] or m[3] or "", " ".join(re.sub("<[^>]*>", " ", m[4]).split())) for m in ANCHOR.finditer(p)]
        assert got.get(i, []) == [(k + 1, *x) for k, x in enumerate(found)], p


def test_links_of_the_tables(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").where("html is not null")
    got = {}
    for r in links.links(pages).collect():
        got.setdefault(r.page_id, []).append((r.pos, r.href))
    plain = lambda x: x.replace("&amp;", "&")
    for r in pages.collect():
        want = [(k + 1, plain(m[1] or m[2] or m[3] or "")) for k, m in enumerate(ANCHOR.finditer(r.html))]
        assert sorted(got.get(r.page_id, [])) == want


def test_headings_and_texts(spark):
    rows = [("<h1 class=x>A <b>b</b> &amp; c</h1><h1>no</h1>", "A b & c"), ("<h1>open", None), ("<H1></H1><title>T</title>", "T"), ("<h1 <h1>x</h1>", "x"), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "html string, want string")
    assert all(r[0] == r[1] for r in df.select(links.heading("html"), "want").collect())
    pages = [("<p>a<script>x < y</script>b</p><!-- c <b> -->d", "a\nb\nd".replace("a\nb", "ab").replace("ab\nd", "ab\nd")), ("a <style>b", "a"), ("a <!-- b", "a"), ("a   \n\n <br>  b  c", "a\nb  c"), ("x < y", "x < y"), ("<script>a</style>b", "b")]
    got = [r[0] for r in spark.createDataFrame(pages, "html string, want string").select(store.page_text("html")).collect()]
    assert got == [w for _, w in pages]
    frames = spark.createDataFrame([('<iframe width=1 src="a.pdf"></iframe><iframe src=b.html><iframe src=\'C.PDF?x\'>',)], "html string")
    assert frames.select(discovery.iframe_files("html")).first()[0] == ["a.pdf", "C.PDF?x"]


BROKEN = ["<a ", "<script>", "<script ", "<", '<a href="', "<a href='x", "<a href ", "<!--", "<h1", "<h1>", " ", "<a href=x>", '"', "<iframe ", "</a>", "<a href=\"x\" href=\"y\" "]


@pytest.mark.parametrize("what", BROKEN)
def test_broken_pages_take_time_in_proportion(spark, what):
    """A megabyte of a tag, quote or blank that is never closed."""
    page = spark.createDataFrame([(1, "http://h/", what * (1_000_000 // len(what)))], "page_id int, url string, html string")
    page = page.select("page_id", "url", F.concat("html", F.lit("")).alias("html"))
    for step in (links.links(page).select(F.count("*")), page.select(F.length(store.page_text("html"))), page.select(F.length(links.heading("html")), F.size(discovery.iframe_files("html")))):
        step.collect()
        began = time.time()
        step.collect()
        assert time.time() - began < 6, what


def test_silent_parts_end_with_the_page():
    assert re.sub(markup.SILENT.replace(r"\z", r"\Z"), "", "a<script>b</script>c<style>d") == "ac"
