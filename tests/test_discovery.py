"""Addresses, references, PDF texts, linking and the queries without SQL, against plain Python."""

import html
import random
import re
import unicodedata
import zlib
from datetime import date
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from bescheid.functions import text as X
from bescheid.operators import entities, extract, links
from bescheid.plans import registry
from bescheid.sources import pdf
from bescheid.streaming import jobs


def test_absolute(spark):
    bases = ["https://a.example/x/y?q=1#f", "https://a.example", "http://a.example:80/", "https://a.example/b/c/"]
    hrefs = ["", "z", "z/../w", "./", "../", "../../k", "/r/./s/../t", "?p=2", "#g", "//h.example/i", "mailto:x@y", "https://b.example/q", "a?b#c", "..", "/", "/..x/.y", "v?id=7"]
    rows = [(b, h) for b in bases for h in hrefs] + [(None, "x"), ("https://a.example", None)]
    got = spark.createDataFrame(rows, "b string, h string").select("b", "h", links.absolute("b", "h").alias("a")).collect()
    for r in got:
        assert r.a == (urljoin(r.b, r.h) if r.b is not None and r.h is not None else None), (r.b, r.h)


def test_references(spark):
    names = list(X.REFERENCES)
    texts = [f"a&{n};b" for n in names] + ["&#167;&#xA7;&#XA7; &#0; &#x110000; &#55296; &#8364;x", "&amp;lt; &amp;amp; &unknown; & &#; &#x; &#abc;", "plain", "", "&#38;lt;", None]
    got = [r.x for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.decode_references("t").alias("x")).orderBy("i").collect()]
    want = [None if t is None else html.unescape(t) for t in texts]
    assert got[: len(names)] == want[: len(names)] and got[len(names)] == want[len(names)] and got[len(names) + 2 :][:2] == ["plain", ""] and got[-1] is None
    assert got[len(names) + 1] == "&lt; &amp; &unknown; & &#; &#x; &#abc;"


def test_anchors(spark):
    page = """<A class=x HREF='/one?a=1&amp;b=2'>Eins &Uuml;</A><a href=/two target=_blank>Zwei <b>fett</b></a><a href="/open">offen <a data-href="/no" href = "/three">Drei</a><a name=n>kein</a><area href="/no"><a href="">leer</a>"""
    got = links.links(spark.createDataFrame([(1, "u", page)], "page_id int, url string, html string")).orderBy("pos").collect()
    assert [(r.pos, r.href, r.text) for r in got] == [(1, "/one?a=1&b=2", "Eins Ü"), (2, "/two", "Zwei fett"), (3, "/open", "offen"), (4, "/three", "Drei"), (5, "", "leer")]


def made_pdf(streams, deflate=False, packed=False):
    out = [b"%PDF-1.5\n1 0 obj <</Type/Catalog/Pages 2 0 R>> endobj\n"]
    kids = b" ".join(b"%d 0 R" % (10 + i) for i in range(len(streams)))
    tree = b"<</Type /Pages /Kids [%s] /Count %d>>" % (kids, len(streams))
    pages = [b"<</Type /Page /Parent 2 0 R /Contents %d 0 R>>" % (50 + i) for i in range(len(streams))]
    if packed:
        bodies = [tree, *pages]
        heads, at = [], 0
        for n, b in zip([2, *range(10, 10 + len(pages))], bodies, strict=True):
            heads.append(b"%d %d" % (n, at))
            at += len(b) + 1
        head = b" ".join(heads) + b" "
        raw = zlib.compress(head + b" ".join(bodies))
        out.append(b"3 0 obj <</Type /ObjStm /N %d /First %d /Filter /FlateDecode>>\nstream\n%s\nendstream endobj\n" % (len(bodies), len(head), raw))
    else:
        out.append(b"2 0 obj " + tree + b" endobj\n")
        out += [b"%d 0 obj %s endobj\n" % (10 + i, p) for i, p in enumerate(pages)]
    for i, s in enumerate(streams):
        body = zlib.compress(s) if deflate else s
        out.append(b"%d 0 obj <<%s>>\nstream\n%s\nendstream endobj\n" % (50 + i, b"/Filter /FlateDecode" if deflate else b"", body))
    return b"".join(out) + b"%%EOF"


STREAMS = [b"BT 10 700 Td (Bebauungs\\(plan\\) \\344\\\\) Tj 0 -12 Td [(Nr.) -300 (12) 20 (a)] TJ T* <5A776569> Tj ET", b"", b"BT (drei) ' ET BT (vier) Tj ET"]


@pytest.mark.parametrize("deflate", [False, True])
@pytest.mark.parametrize("packed", [False, True])
def test_pdf_pages(deflate, packed):
    assert pdf.pages(made_pdf(STREAMS, deflate, packed)) == ["Bebauungs(plan) ä\\\nNr. 12a\nZwei", "", "drei\nvier"]


def test_pdf_rows(spark):
    rows = [(1, bytearray(made_pdf(STREAMS, True))), (2, bytearray(b"no file")), (3, None), (4, bytearray(b"%PDF-1.4 nothing"))]
    df = spark.createDataFrame(rows, "i int, data binary").select("i", pdf.page_texts("data").alias("p")).select("i", pdf.text("p").alias("all"), pdf.text("p", 1).alias("first"))
    got = {r.i: (r.all, r.first) for r in df.collect()}
    assert got == {1: ("Bebauungs(plan) ä\\\nNr. 12a\nZwei\n\ndrei\nvier", "Bebauungs(plan) ä\\\nNr. 12a\nZwei"), 2: (None, None), 3: (None, None), 4: (None, None)}


def plain_fold(rows):
    """Every procedure looks at all projects before it, in order."""
    projects, out = [], []
    for pid, plan, parcel, dev, words, title, place, company, kind in rows:
        hit = next(((p[0], 0.95, "PARCEL_MATCH") for p in projects if parcel and p[1] and parcel in p[1]), None)
        hit = hit or next(((p[0], 0.9, "PLAN_TOKEN_MATCH") for p in projects if plan and p[2] and plan in p[2]), None)
        hit = hit or next(((p[0], 0.8, "DEV+TITLE_MATCH") for p in [p for p in projects if p[3]][:50] if dev and words and p[3] == dev), None)
        if not hit:
            hit = (f"project-{pid}", 0.85, "PERMIT_36_NEW") if kind == "PERMIT_36_EINVERNEHMEN" else (f"project-{pid}", 1.0, "NEW_PROJECT")
            projects.append((hit[0], parcel or place, f"B-Plan {plan}" if plan else title, dev if company and dev else None))
        out.append((pid, *hit))
    return out


def test_fold_against_all_projects(spark):
    r = random.Random(8)
    pick = lambda xs: r.choice([None, None, *xs])
    rows = []
    for i in range(600):
        rows.append((i, pick(["1", "12", "nord", "12a", f"p{i % 90}"]), pick([f"flur={i % 40}", f"flur={i % 7};flurstueck=1"]), pick([f"firma{i % 70}"]), pick(["w"]), pick(["Plan 12", f"Titel {i}"]), pick([f"Flur: {i % 9}"]), pick(["F"]), pick(["PERMIT_36_EINVERNEHMEN"])))
    assert list(entities.fold(rows)) == plain_fold(rows)
    big = 2**53
    ids = [big + 1, None, big + 3, 2]
    schema = "municipality_key string, seen date, doc_id long, plan_token string, parcel_token string, developer_token string, title_signature string, title string, location string, company string, procedure_type string"
    df = spark.createDataFrame([("m", None, x, str(n), None, None, None, None, None, None, None) for n, x in enumerate(ids)], schema).coalesce(1)
    got = {r.procedure_id: r.project_id for r in entities.link(df).collect()}
    assert got == {x: f"project-{x}" for x in ids}


def announcements(spark, sf):
    return registry.announcements.fx(spark, sf).collect()


def test_linking_query(spark, sf):
    rows = registry.announcements._procs(spark, sf).collect()
    want = set()
    for key in {r.municipality_key for r in rows}:
        own = sorted((r for r in rows if r.municipality_key == key), key=lambda r: (r.seen is not None, r.seen or date.min, r.doc_id))
        want |= {(key, *x) for x in plain_fold([(r.doc_id, r.plan_token, r.parcel_token, r.developer_token, r.title_signature, r.title, r.location, r.company, r.procedure_type) for r in own])}
    got = registry.QUERIES["entity_link_fold"](spark, sf).collect()
    assert {(r.municipality_key, r.procedure_id, r.project_id, r.link_confidence, r.link_reason) for r in got} == want and len(got) == len(rows)


def test_company_queries(spark, sf):
    texts = {r.doc_id: r.text for r in announcements(spark, sf)}
    found = {d: [m.group() for m in re.finditer(r"\b[A-ZÄÖÜ][A-Za-zÄÖÜäöüß0-9\s,&.-]+?(?:GmbH|AG|UG|GmbH & Co\. KG|KG)\b", t)] for d, t in texts.items()}
    got = {r.doc_id: (r.n, r.developer) for r in registry.QUERIES["companies"](spark, sf).collect()}
    assert got == {d: (len(f), ", ".join(f[:3]) or None) for d, f in found.items()}
    procs = registry.announcements._procs(spark, sf).collect()
    best = {}
    for key in {p.municipality_key for p in procs}:
        own = sorted((p for p in procs if p.municipality_key == key), key=lambda p: (p.seen or date(1900, 1, 1), p.doc_id))
        names = [p.company for p in own if p.company]
        best[key] = max(names, key=lambda n: (names.count(n), -names.index(n))) if names else None
    assert {r.project_id: r.developer_company_best for r in registry.QUERIES["project_developers"](spark, sf).collect()} == best


def test_decision_query(spark, sf):
    """Dates near a word of decision, found anew with another scan."""
    from bescheid.functions import terms as T

    def plain(t):
        found = []
        for p in (r"(\d{1,2})\.\s*(\d{1,2})\.\s*(\d{4})", r"(\d{1,2})\.\s*(\d{1,2})\.\s*(\d{2})\b", r"(\d{1,2})[/-]\s*(\d{1,2})[/-]\s*(\d{4})"):
            for m in re.finditer(p, t):
                d, mo, y = (int(x) for x in m.groups())
                y += (2000 if y < 50 else 1900) if len(m[3]) == 2 else 0
                try:
                    if 2020 <= date(y, mo, d).year <= 2030:
                        found.append((t[max(0, m.start() - 50) : m.end() + 50].strip().lower(), date(y, mo, d)))
                except ValueError:
                    pass
        low = t.lower()
        near = [day for w in T.DECISION if w in low for around, day in found if around in low and abs(low.index(around) - low.index(w)) < 200]
        return (near or [d for _, d in found] or [None])[0]

    texts = {r.doc_id: r.text for r in announcements(spark, sf)}
    assert {r.doc_id: r.decision_date for r in registry.QUERIES["decision_date"](spark, sf).collect()} == {d: plain(t) for d, t in texts.items()}


def test_records_query(spark, sf):
    """Each column of the records as the query of that column gives it."""
    rows = {r.doc_id: r for r in registry.QUERIES["procedure_records"](spark, sf).collect()}
    one = lambda q, x: {r.doc_id: r[x] for r in registry.QUERIES[q](spark, sf).collect()}
    decisions, places, firms = one("decision_date", "decision_date"), one("location", "location"), one("companies", "developer")
    valid = {r.doc_id for r in registry.QUERIES["procedure_validity"](spark, sf).collect() if r.ok}
    assert rows.keys() == valid
    for d, r in rows.items():
        assert (r.decision_date, r.site_location_raw, r.developer_company) == (decisions[d], places[d], firms[d])


def test_title_hash_query(spark, sf):
    def key(title):
        kept = [c if c.isascii() and c.isalnum() or c in "äöüß" else " " for c in unicodedata.normalize("NFKD", title or "").lower()]
        return " ".join("".join(kept).split())

    rows = {r.doc_id: r.procedure_hash for r in registry.QUERIES["normalize_title_hash"](spark, sf).collect()}
    assert rows == {r.doc_id: f"{r.municipality_key}:{key(r.title)}" for r in announcements(spark, sf)}


def test_counters_and_folders(spark, tmp_path):
    df = spark.createDataFrame([("RIS", "m", None), ("GAZETTE", "m", "c1"), ("RIS", "n", "c2")], "source string, municipality_key string, candidate_id string")
    watched, seen = jobs.counted(df, "three")
    watched.write.parquet(f"file://{tmp_path}/jobs")
    assert seen.get["jobs"] == 3 and seen.get["extractions"] == 2 and sorted(seen.get["sources"]) == ["GAZETTE", "RIS"]

    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda _, default=None: default)

        class sparkContext:  # noqa: N801
            master = "yarn"

    with pytest.raises(RuntimeError):
        jobs.work_folder(Cluster())


def test_early_stop_of_a_hot_key(spark):
    """Against a plain loop, with one key that has most rows."""
    r = random.Random(5)
    rows = [(1 if r.random() < 0.8 else r.randint(2, 5), i, r.choice([None, date(2022, 5, 1), date(2022, 6, 1), date(2023, 5, 1), date(2023, 6, 1)])) for i in range(2000)]
    got = {(x.k, x.i) for x in links.until_old(spark.createDataFrame(rows, "k int, i int, day date"), "k", "i", "day", "2023-01-01").collect()}
    want, run, done = set(), {}, set()
    for k, i, day in rows:
        run[k] = run.get(k, 0) + 1 if day and day < date(2023, 1, 1) else 0
        if run[k] == 3:
            done.add(k)
        if k not in done:
            want.add((k, i))
    assert got == want


def test_similar_titles_against_all_pairs(spark):
    r = random.Random(2)
    titles = {(r.choice("ab"), " ".join(r.sample(["plan", "nord", "süd", "ost", "solar", "park", "wind", "am", "see"], r.randint(1, 5)))) for _ in range(120)} | {("a", "")}
    df = spark.createDataFrame(sorted(titles), "municipality_key string, s string")
    for least in (0.5, 0.75, 1.0):
        got = {(x.municipality_key, x.a, x.b): round(x.similarity, 9) for x in entities.similar_titles(df, least).collect()}
        want = {}
        for k, a in titles:
            for m, b in titles:
                x, y = set(a.split()), set(b.split())
                if k == m and a < b and x and y and len(x & y) / len(x | y) >= least:
                    want[k, a, b] = round(len(x & y) / len(x | y), 9)
        assert got == want




def test_pdf_files_are_dealt_out(spark, sf):
    """Files made from a table of one file are read on all cores, not in one task."""
    assert registry.QUERIES["pdf_texts"](spark, sf).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
