"""Queries over announcements (the fixture over `documents`), pages and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import classify as C
from ..operators import entities as E
from ..operators import extract as G
from ..operators import founders
from ..operators import links as L
from ..operators import merge as M
from ..operators import scoring as S
from ..sources import answers, shared, store
from ..sources.keyed import KeyedTable
from ..streaming import jobs, linking
from . import bindings as B
from . import fixture
from .base import Book

BOOK = Book()
query = BOOK.query
fx = fixture.announcements
FX = f"fx AS ({fixture.sql()})"
N = f"{FX}, {S.NORMAL_SQL}"
CL = f"{N}, {C.classify_sql()}"
c = F.col


@query("normalize_text_german", f"WITH {FX} SELECT doc_id, {X.normalize_sql('title')} AS title_norm, sha256({X.normalize_sql('text')}) AS text_sha256 FROM fx")
def normalize_text_german(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", X.normalize("title").alias("title_norm"), X.sha256(X.normalize("text")).alias("text_sha256"))


@query("text_variants", f"WITH {FX} SELECT doc_id, array_to_string(CASE WHEN a = b THEN [a] ELSE [a, b] END, '|') AS variants FROM (SELECT doc_id, {X.normalize_sql('title')} AS a, lower(title) AS b FROM fx)")
def text_variants(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", F.array_join(X.text_variants("title"), "|").alias("variants"))


@query("normalize_title_hash", f"WITH {FX} SELECT doc_id, municipality_key || ':' || {X.normalize_title_sql('title')} AS procedure_hash FROM fx")
def normalize_title_hash(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", X.procedure_hash("title", "municipality_key").alias("procedure_hash"))


@query("dedupe_by_hash", f"WITH {FX} SELECT municipality_key, key, min(doc_id) AS doc_id, count(*) AS copies FROM (SELECT municipality_key, doc_id, trim(regexp_replace(regexp_replace(lower(regexp_replace(title, '[^A-Za-z0-9 ]', '', 'g')), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS key FROM fx) GROUP BY 1, 2")
def dedupe_by_hash(spark: SparkSession, d: str) -> DataFrame:
    """One row per normal title and municipality; on ASCII titles, where SQL can follow."""
    plain = F.regexp_replace("title", "[^A-Za-z0-9 ]", "")
    keyed = fx(spark, d).select("municipality_key", "doc_id", X.normalize_title(plain).alias("key"))
    return keyed.groupBy("municipality_key", "key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("prefilter_score", f"WITH {FX} SELECT doc_id, round({S.prefilter_sql()}, 6) AS score FROM fx")
def prefilter_score(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", F.round(S.prefilter_score(c("title"), c("url")), 6).alias("score"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", "municipality_key", "discovery_source", "title", F.round(S.prefilter_score(c("title"), c("url")), 6).alias("score"))


_SCORED = f"{FX}, s AS (SELECT doc_id, municipality_key, discovery_source, title, round({S.prefilter_sql()}, 6) AS score FROM fx)"


@query("prefilter_by_source", f"WITH {_SCORED} SELECT discovery_source, count(*) AS candidates, count(*) FILTER (score >= {S.threshold_sql()}) AS passed, round(avg(score), 4) AS avg_score FROM s GROUP BY 1")
def prefilter_by_source(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).groupBy("discovery_source").agg(F.count("*").alias("candidates"), F.count_if(S.should_extract(c("score"), c("discovery_source"))).alias("passed"), F.round(F.avg("score"), 4).alias("avg_score"))


@query("prefilter_gate", f"WITH {_SCORED} SELECT doc_id, score >= {S.threshold_sql()} AS fast, score >= {S.threshold_sql(mode='deep')} AS deep FROM s")
def prefilter_gate(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("doc_id", S.should_extract(c("score"), c("discovery_source")).alias("fast"), S.should_extract(c("score"), c("discovery_source"), "deep").alias("deep"))


@query("worklist_topk", f"WITH {_SCORED} SELECT doc_id, score FROM s WHERE score >= 0.3 ORDER BY score DESC, doc_id LIMIT 100")
def worklist_topk(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where("score >= 0.3").orderBy(F.desc("score"), "doc_id").limit(100).select("doc_id", "score")


@query("attachment_gate", f"WITH {_SCORED}, g AS (SELECT doc_id, coalesce(discovery_source = 'RIS', FALSE) AND {S.any_sql('lower(title)', S.T.AGENDA)} AS wanted, doc_id * 997 % 50000000 > 25 * 1024 * 1024 AND score < 0.8 AS skipped FROM s) SELECT * FROM g")
def attachment_gate(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("doc_id", S.wants_attachments(c("title"), c("discovery_source")).alias("wanted"), S.skips_file(c("doc_id") * 997 % 50_000_000, c("score")).alias("skipped"))


_STATUS = f"CASE WHEN score >= {S.threshold_sql()} THEN 'ENQUEUED' WHEN doc_id % 17 = 0 THEN 'ERROR' ELSE 'SKIPPED' END"


def _with_status(spark: SparkSession, d: str) -> DataFrame:
    passed = S.should_extract(c("score"), c("discovery_source"))
    return _scored(spark, d).withColumn("status", F.when(passed, "ENQUEUED").when(c("doc_id") % 17 == 0, "ERROR").otherwise("SKIPPED"))


@query("recall_skipped", f"WITH {_SCORED} SELECT discovery_source, status, count(*) AS n, round(avg(score), 4) AS avg_score FROM (SELECT *, {_STATUS} AS status FROM s) WHERE status IN ('SKIPPED', 'ERROR') GROUP BY 1, 2")
def recall_skipped(spark: SparkSession, d: str) -> DataFrame:
    return _with_status(spark, d).where(c("status").isin("SKIPPED", "ERROR")).groupBy("discovery_source", "status").agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("avg_score"))


@query("recall_top_skipped", f"WITH {_SCORED} SELECT doc_id, title, discovery_source, score FROM (SELECT *, {_STATUS} AS status FROM s) WHERE status = 'SKIPPED' ORDER BY score DESC, doc_id LIMIT 50")
def recall_top_skipped(spark: SparkSession, d: str) -> DataFrame:
    return _with_status(spark, d).where("status = 'SKIPPED'").orderBy(F.desc("score"), "doc_id").limit(50).select("doc_id", "title", "discovery_source", "score")


@query("candidate_gate", f"WITH {N} SELECT doc_id, {C.candidate_sql()} AS is_candidate FROM n")
def candidate_gate(spark: SparkSession, d: str) -> DataFrame:
    return S.with_hits(fx(spark, d)).select("doc_id", C.is_candidate(c("hc")).alias("is_candidate"))


@query("classify_relevance", f"WITH {CL} SELECT doc_id, is_relevant, procedure_type, legal_basis, project_components, round(confidence_score, 6) AS confidence_score, ambiguity_flag, review_recommended FROM c")
def classify_relevance(spark: SparkSession, d: str) -> DataFrame:
    return C.classify(fx(spark, d)).select("doc_id", "is_relevant", "procedure_type", "legal_basis", "project_components", F.round("confidence_score", 6).alias("confidence_score"), "ambiguity_flag", "review_recommended")


def _counts(name: str, column: str, make, make_sql: str) -> None:
    @query(name, f"WITH {N} SELECT {make_sql} AS {column}, count(*) AS n FROM n GROUP BY 1")
    def run(spark: SparkSession, d: str) -> DataFrame:
        return S.with_hits(fx(spark, d)).select(make(c("hc")).alias(column)).groupBy(column).agg(F.count("*").alias("n"))


_counts("procedure_type_counts", "procedure_type", C.procedure_type, C.procedure_type_sql())
_counts("legal_basis_counts", "legal_basis", C.legal_basis, C.legal_basis_sql())
_counts("components_counts", "project_components", C.components, C.components_sql())


@query("evidence_snippets", f"WITH {CL} SELECT doc_id, len(evidence_snippets) AS n, array_to_string(evidence_snippets, '|') AS snippets FROM c WHERE is_relevant")
def evidence_snippets(spark: SparkSession, d: str) -> DataFrame:
    return C.classify(fx(spark, d)).where("is_relevant").select("doc_id", F.size("evidence_snippets").cast("long").alias("n"), F.array_join("evidence_snippets", "|").alias("snippets"))


@query("storage_score", f"WITH {N}, b AS (SELECT *, comb || ' ' || nn AS twice FROM n) SELECT doc_id, {C.storage_score_sql()} AS score FROM b")
def storage_score(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", C.storage_score(c("text"), c("title")).alias("score"))


@query("storage_score_plain", f"WITH {FX} SELECT doc_id, CAST({S.storage_plain_sql()} AS INT) AS score FROM fx")
def storage_score_plain(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", S.storage_score_plain(c("text")).alias("score"))


@query("grid_score", f"WITH {FX} SELECT doc_id, CAST({S.grid_sql()} AS INT) AS score FROM fx")
def grid_score(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", S.grid_score(c("text")).alias("score"))


_BUCKET = "CASE WHEN storage >= 3 AND grid >= 3 THEN 'high' WHEN storage >= 1 OR grid >= 1 THEN 'medium' ELSE 'low' END"


@query("rescore_titles", f"WITH {FX}, r AS (SELECT doc_id, greatest({S.storage_plain_sql('title')}, {S.storage_plain_sql('lower(title)')}) AS storage, {S.grid_sql('title')} AS grid FROM fx) SELECT doc_id, CAST(storage AS INT) AS storage, CAST(grid AS INT) AS grid, {_BUCKET} AS confidence FROM r")
def rescore_titles(spark: SparkSession, d: str) -> DataFrame:
    r = fx(spark, d).select("doc_id", S.storage_score_plain(c("title")).alias("storage"), S.grid_score(c("title")).alias("grid"))
    return r.withColumn("confidence", S.confidence(c("storage"), c("grid")))


@query("rescore_with_documents", f"WITH {FX}, g AS (SELECT municipality_key, discovery_source, array_to_string(list_sort(list(DISTINCT title)), ' ') AS text FROM fx GROUP BY 1, 2), r AS (SELECT municipality_key, discovery_source, {S.storage_plain_sql()} AS storage, {S.grid_sql()} AS grid FROM g) SELECT municipality_key, discovery_source, CAST(storage AS INT) AS storage, CAST(grid AS INT) AS grid, {_BUCKET} AS confidence FROM r")
def rescore_with_documents(spark: SparkSession, d: str) -> DataFrame:
    """Distinct titles of a group joined in order, scored as one text; titles are few, so groups stay small."""
    g = fx(spark, d).groupBy("municipality_key", "discovery_source").agg(F.concat_ws(" ", F.array_sort(F.collect_set("title"))).alias("text"))
    r = g.select("municipality_key", "discovery_source", S.storage_score_plain(c("text")).alias("storage"), S.grid_score(c("text")).alias("grid"))
    return r.withColumn("confidence", S.confidence(c("storage"), c("grid")))


@query("container_flag", f"WITH {FX} SELECT doc_id, {C.container_sql()} AS is_container FROM fx")
def container_flag(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", C.is_container(c("title"), c("url")).alias("is_container"))


_OK, _REASON = C.validity_sql()


@query("procedure_validity", f"WITH {CL} SELECT doc_id, {_OK} AS ok, {_REASON} AS reason FROM c")
def procedure_validity(spark: SparkSession, d: str) -> DataFrame:
    v = C.classify(fx(spark, d)).withColumn("v", C.validity(c("nn"), c("url"), c("discovery_source"), c("procedure_type"), c("text")))
    return v.select("doc_id", "v.ok", "v.reason")


@query("capacity", f"WITH {FX} SELECT doc_id, round({G.capacity_sql()}, 6) AS mw, round({G.capacity_sql(unit='MWh')}, 6) AS mwh FROM fx")
def capacity(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", F.round(G.capacity(c("text")), 6).alias("mw"), F.round(G.capacity(c("text"), "MWh"), 6).alias("mwh"))


@query("area", f"WITH {FX} SELECT doc_id, round({G.area_sql()}, 6) AS hectares FROM fx")
def area(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", F.round(G.area(c("text")), 6).alias("hectares"))


@query("dates_all", f"WITH {FX}, x AS (SELECT doc_id, {G.dates_sql()} AS dates FROM fx) SELECT doc_id, len(dates) AS n, array_to_string(list_transform(dates, lambda x: CAST(x AS VARCHAR)), '|') AS dates FROM x")
def dates_all(spark: SparkSession, d: str) -> DataFrame:
    found = fx(spark, d).select("doc_id", G.dates(c("text")).alias("dates"))
    return found.select("doc_id", F.size("dates").cast("long").alias("n"), F.array_join(F.transform("dates", lambda x: x.cast("string")), "|").alias("dates"))


@query("decision_date")
def decision_date(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", G.decision_date("text").alias("decision_date"))


@query("companies", f"WITH {FX} SELECT doc_id, len(x) AS n, {G.developer_sql('x')} AS developer FROM (SELECT doc_id, {G.companies_sql()} AS x FROM fx)")
def companies(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", G.companies(c("text")).alias("x")).select("doc_id", F.size("x").alias("n"), G.developer(c("x")).alias("developer"))


@query("location", f"WITH {N}, x AS (SELECT doc_id, {G.location_sql()} AS location FROM n) SELECT doc_id, location, {G.parcel_token_sql()} AS parcel_token FROM x")
def location(spark: SparkSession, d: str) -> DataFrame:
    x = fx(spark, d).select("doc_id", G.location(c("text")).alias("location"))
    return x.withColumn("parcel_token", G.parcel_token(c("location")))


@query("plan_token", f"WITH {FX} SELECT doc_id, {G.plan_token_sql()} AS plan_token FROM fx")
def plan_token(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", G.plan_token(c("title")).alias("plan_token"))


_FORM = "CASE c_custkey % 5 WHEN 0 THEN ' GmbH' WHEN 1 THEN '  AG ' WHEN 2 THEN ' e.V.' WHEN 3 THEN '' ELSE ' & Co. KG' END"


@query("company_norm", f"SELECT c_custkey, {G.company_name_sql(f'(c_name || {_FORM})')} AS company FROM customer")
def company_norm(spark: SparkSession, d: str) -> DataFrame:
    return B.read(spark, d, "customer").select("c_custkey", G.company_name(F.expr(f"c_name || {_FORM}")).alias("company"))


@query("title_signature", f"WITH {FX} SELECT doc_id, {G.title_signature_sql()} AS signature FROM fx")
def title_signature(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d).select("doc_id", G.title_signature(c("title")).alias("signature"))


#: Titles with an ending by doc_id, so that similar ones occur.
_VARIED = "title || CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN ' Bereich Nord' WHEN 2 THEN ' Bereich Nordost' WHEN 3 THEN ' Teilfläche Nord Bereich' ELSE ' Ergänzung' END"


@query("title_jaccard_pairs", f"""WITH {FX}, v AS (SELECT municipality_key, {_VARIED} AS title FROM fx), t AS (SELECT DISTINCT municipality_key, {G.title_signature_sql()} AS s FROM v), w AS (SELECT municipality_key, s, list_distinct(list_filter(string_split(s, ' '), lambda x: x <> '')) AS ws FROM t)
SELECT a.municipality_key, a.s AS a, b.s AS b, round(len(list_intersect(a.ws, b.ws)) / (len(a.ws) + len(b.ws) - len(list_intersect(a.ws, b.ws))), 6) AS similarity FROM w a JOIN w b ON a.municipality_key = b.municipality_key AND a.s < b.s WHERE len(list_intersect(a.ws, b.ws)) / (len(a.ws) + len(b.ws) - len(list_intersect(a.ws, b.ws))) >= 0.5""")
def title_jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Similar distinct titles of a municipality."""
    t = fx(spark, d).select("municipality_key", G.title_signature(F.expr(_VARIED)).alias("s")).distinct()
    return E.similar_titles(t, 0.5).select("municipality_key", "a", "b", F.round("similarity", 6).alias("similarity"))


_PLACE = "CASE n_nationkey % 6 WHEN 0 THEN n_name || ' (Oder)' WHEN 1 THEN 'Bad ' || n_name || '/Mark' WHEN 2 THEN n_name || ', St. Jürgen' WHEN 3 THEN '(' || n_name || ')' WHEN 4 THEN 'Groß_' || n_name || ' . ' ELSE '' END"


@query("url_slug", "SELECT n_nationkey, " + ", ".join(f"{X.slug_sql(f'({_PLACE})', v)} AS slug_{v.lower()}" for v in "ABCD") + " FROM nation")
def url_slug(spark: SparkSession, d: str) -> DataFrame:
    p = B.read(spark, d, "nation").select("n_nationkey", F.expr(_PLACE).alias("p"))
    return p.select("n_nationkey", *[X.slug("p", v).alias(f"slug_{v.lower()}") for v in "ABCD"])


@query("url_authority", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS authority, sha256(url) AS url_sha256 FROM pages WHERE url IS NOT NULL")
def url_authority(spark: SparkSession, d: str) -> DataFrame:
    return B.pages(spark, d).where("url is not null").select("page_id", X.authority("url").alias("authority"), X.sha256("url").alias("url_sha256"))


_MESSAGE = "CASE event_id % 5 WHEN 0 THEN 'SSL handshake' WHEN 1 THEN 'bad Certificate' WHEN 2 THEN 'Connection refused' WHEN 3 THEN 'read TimeOut' ELSE 'not found' END"


@query("error_status", f"SELECT CASE WHEN contains(lower(m), 'ssl') OR contains(lower(m), 'certificate') OR contains(lower(m), 'tls') THEN 'ERROR_SSL' WHEN contains(lower(m), 'timeout') OR contains(lower(m), 'connection') THEN 'ERROR_NETWORK' ELSE 'ERROR_OTHER' END AS status, count(*) AS n FROM (SELECT {_MESSAGE} AS m FROM events) GROUP BY 1")
def error_status(spark: SparkSession, d: str) -> DataFrame:
    return B.read(spark, d, "events").select(X.error_status(F.expr(_MESSAGE)).alias("status")).groupBy("status").agg(F.count("*").alias("n"))


@query("reason_code", f"SELECT CASE WHEN user_id % 4 = 0 THEN 'NO_SEED_URL' WHEN count(*) FILTER (event_id % 3 <> 0 AND m <> 'not found') = 0 THEN 'ALL_URLS_404' WHEN count(*) FILTER (event_id % 3 <> 0 AND contains(m, 'SSL')) > 0 THEN 'SSL_BLOCKED' ELSE 'NO_MARKERS_FOUND' END AS reason, user_id FROM (SELECT user_id, event_id, CASE WHEN user_id % 7 > 2 THEN 'not found' ELSE {_MESSAGE} END AS m FROM events) GROUP BY user_id")
def reason_code(spark: SparkSession, d: str) -> DataFrame:
    m = F.when(c("user_id") % 7 > 2, "not found").otherwise(F.expr(_MESSAGE))
    failed = F.when(c("event_id") % 3 != 0, F.struct(m.alias("k"), F.when(m == "not found", "404 Not Found").otherwise(m).alias("v")))
    per = B.read(spark, d, "events").groupBy("user_id").agg(F.map_from_entries(F.collect_set(failed)).alias("failures"))  # five messages at most
    return per.select(X.reason_code(c("user_id") % 4 != 0, c("failures")).alias("reason"), "user_id")


_ADDED = """CASE page_id % 5 WHEN 0 THEN '<a href="/bekanntmachung/ausgabe-7.pdf?x=1">Amtsblatt <b>Ausgabe 7</b></a>' WHEN 1 THEN '<a class="t" href="https://sessionnet.example.org/si0100.asp#a">Sitzung</a><a href="/bekanntmachung/ausgabe-7.pdf#s">Bebauungsplan Nr. 3</a>'
WHEN 2 THEN '<A HREF="/plan.PDF">B-Plan Auslegung</A><a href="/g1">Bauausschuss</a><a href="/s1">Sitzung am 3.4.2023</a>' WHEN 3 THEN '<a href="/s2">Sitzungstag 2022-12-01</a><a href="/s3">Datum 31-02-2024</a><a href="/vorlage/7">TOP 3 Energie</a><p>Bebauungsplan</p>'
ELSE '<a class=x href=''/amtsblatt/7?a=1&amp;b=2''>Amtsblatt &sect; 36, &#167; 35 &#xA7; 34 &amp;sect;</a><a href=/frei.html target=_blank>Verfahren &amp; Beteiligung</a><a href="/offen">Satzung <a data-href="/x" href = "/zu">Bebauungsplan</a><a name="kein">Anker</a>' END"""
PG = f"pg AS (SELECT page_id, url, coalesce(html, '') || {_ADDED} AS html FROM pages)"


def _links(spark: SparkSession, d: str) -> DataFrame:
    return L.links(B.pages(spark, d).select("page_id", "url", F.expr(f"coalesce(html, '') || {_ADDED}").alias("html")))


@query("html_links", f"WITH {PG}, {L.LINKS_SQL} SELECT page_id, CAST(pos AS INT) AS pos, href, text FROM l")
def html_links(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d).select("page_id", "pos", "href", "text")


@query("links_by_term", f"WITH {PG}, {L.LINKS_SQL} SELECT page_id, href, text FROM l WHERE {S.any_sql('lower(text)', L.ISSUE_TERMS)}")
def links_by_term(spark: SparkSession, d: str) -> DataFrame:
    return L.by_term(_links(spark, d), L.ISSUE_TERMS, "text").select("page_id", "href", "text")


@query("typed_links", f"WITH {PG}, {L.LINKS_SQL} SELECT page_id, href, CASE WHEN lower(regexp_replace(href, '[?#].*$', '')) LIKE '%.pdf' THEN 'document' ELSE 'procedure' END AS kind FROM l WHERE {S.any_sql('lower(text || chr(32) || href)', L.PLAN_TERMS)} AND NOT {S.any_sql('lower(href)', ['sessionnet', 'allris', 'amtsblatt'])}")
def typed_links(spark: SparkSession, d: str) -> DataFrame:
    return L.typed_links(_links(spark, d)).select("page_id", "href", "kind")


@query("document_links", f"WITH {PG}, {L.LINKS_SQL} SELECT page_id, CAST(pos AS INT) AS pos, href FROM l WHERE regexp_matches(lower(regexp_replace(href, '[?#].*$', '')), '\\.(pdf|doc|docx)$')")
def document_links(spark: SparkSession, d: str) -> DataFrame:
    return L.documents(_links(spark, d)).select("page_id", "pos", "href")


@query("first_links", f"WITH {PG}, {L.LINKS_SQL} SELECT page_id, address, CAST(min(pos) AS INT) AS pos FROM (SELECT *, regexp_replace(href, '[?#].*$', '') AS address FROM l) GROUP BY 1, 2")
def first_links(spark: SparkSession, d: str) -> DataFrame:
    return L.first_per_address(_links(spark, d)).select("page_id", "address", "pos")


@query("ranked_links", f"WITH {PG}, {L.LINKS_SQL}, r AS (SELECT href, CASE WHEN contains(lower(href), 'allris') OR contains(lower(href), 'sessionnet') THEN 10 ELSE 0 END + CASE WHEN contains(lower(href), 'si0100') OR contains(lower(href), 'ris') THEN 5 ELSE 0 END AS council, CASE WHEN contains(lower(href), 'amtsblatt') THEN 10 ELSE 0 END + CASE WHEN contains(lower(href), 'bekanntmachung') THEN 5 ELSE 0 END AS gazette FROM l) SELECT href, council, gazette, count(*) AS n FROM r GROUP BY ALL")
def ranked_links(spark: SparkSession, d: str) -> DataFrame:
    r = _links(spark, d).groupBy("href").agg(F.count("*").alias("n"))
    return r.select("href", L.council_rank(c("href")).alias("council"), L.gazette_rank(c("href")).alias("gazette"), "n").orderBy(F.desc("council"), F.desc("gazette"), "href")


def _term_query(name: str, terms: list[str], where: str) -> None:
    x = {"text": "lower(text)", "href": "lower(href)", "both": "lower(text || ' ' || href)"}[where]

    @query(name, f"WITH {PG}, {L.LINKS_SQL} SELECT page_id, CAST(pos AS INT) AS pos, href, text FROM l WHERE {S.any_sql(x, terms)}")
    def run(spark: SparkSession, d: str) -> DataFrame:
        return L.by_term(_links(spark, d), terms, where).select("page_id", "pos", "href", "text")


_term_query("section_links", L.SECTION_TERMS, "both")
_term_query("committee_links", L.COMMITTEES, "text")
_term_query("session_item_links", L.ITEM_TERMS, "text")
_term_query("direct_session_links", L.DIRECT_SESSION_TERMS, "text")
_term_query("item_marker_links", L.ITEM_MARKERS, "href")


@query("session_links", f"WITH {PG}, {L.LINKS_SQL} SELECT page_id, href, coalesce(CAST(try_strptime(regexp_extract(text, '[0-9]{{1,2}}\\.[0-9]{{1,2}}\\.[0-9]{{4}}'), '%d.%m.%Y') AS DATE), CAST(try_strptime(regexp_extract(text, '[0-9]{{1,2}}-[0-9]{{1,2}}-[0-9]{{4}}'), '%d-%m-%Y') AS DATE), CAST(try_strptime(regexp_extract(text, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}'), '%Y-%m-%d') AS DATE)) AS day FROM l WHERE {S.any_sql('lower(text)', L.SESSION_TERMS)}")
def session_links(spark: SparkSession, d: str) -> DataFrame:
    return L.sessions(_links(spark, d)).select("page_id", "href", "day")


@query("gazette_items", f"WITH {PG}, {L.LINKS_SQL}, h AS (SELECT page_id, url FROM pg WHERE {S.any_sql('lower(html)', L.GAZETTE_TERMS)}), p AS (SELECT page_id, href AS item, 'document' AS kind FROM l WHERE lower(href) LIKE '%.pdf' AND page_id IN (SELECT page_id FROM h)) SELECT * FROM p UNION ALL SELECT page_id, url, 'issue' FROM h WHERE page_id NOT IN (SELECT page_id FROM p)")
def gazette_items(spark: SparkSession, d: str) -> DataFrame:
    pages = B.pages(spark, d).select("page_id", "url", F.expr(f"coalesce(html, '') || {_ADDED}").alias("html"))
    return L.gazette_items(pages, L.links(pages))


@query("absolute_links", f"WITH {PG}, {L.LINKS_SQL} SELECT page_id, CAST(pos AS INT) AS pos, CASE WHEN href LIKE '/%' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href ELSE href END AS address FROM l")
def absolute_links(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d).select("page_id", "pos", L.absolute("url", "href").alias("address"))


@query("early_stop_sessions", """WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE DATE '2022-12-01' + CAST((event_id * 37) % 60 AS INT) END AS day FROM events),
o AS (SELECT *, coalesce(day < DATE '2023-01-01', FALSE) AS old FROM e), b AS (SELECT *, sum(CASE WHEN old THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS block FROM o),
r AS (SELECT *, sum(CAST(old AS INT)) OVER (PARTITION BY user_id, block ORDER BY event_id) AS run FROM b), s AS (SELECT *, max(CASE WHEN run >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS stop FROM r)
SELECT user_id, event_id, day FROM s WHERE stop = 0""")
def early_stop_sessions(spark: SparkSession, d: str) -> DataFrame:
    day = F.when(c("event_id") % 9 != 0, F.date_add(F.lit("2022-12-01").cast("date"), ((c("event_id") * 37) % 60).cast("int")))
    return L.until_old(B.read(spark, d, "events").select("user_id", "event_id", day.alias("day")), "user_id", "event_id", "day", "2023-01-01")


@query("link_reach", """WITH RECURSIVE e AS (SELECT DISTINCT n_nationkey AS src, (n_nationkey * 7 + k) % 25 AS dst FROM nation, (VALUES (1), (5)) AS t(k)), r AS (SELECT 0 AS url, 0 AS depth UNION SELECT dst, depth + 1 FROM r JOIN e ON src = url WHERE depth < 3)
SELECT url, min(depth) AS depth FROM r GROUP BY url""")
def link_reach(spark: SparkSession, d: str) -> DataFrame:
    n = B.read(spark, d, "nation").select(c("n_nationkey").alias("src"), F.explode(F.array(F.lit(1), F.lit(5))).alias("k"))
    e = n.select("src", ((c("src") * 7 + c("k")) % 25).alias("dst")).distinct()
    return L.reach(e, spark.range(1).select(F.lit(0).alias("url")), 3)


@query("first_candidate_page", "SELECT n_nationkey AS key, min_by(u, i) AS url FROM (SELECT n_nationkey, i, 'https://n' || CAST(n_nationkey AS VARCHAR) || p AS u FROM nation, (VALUES (0, '/ris'), (1, '/sessionnet'), (2, '/bi')) AS t(i, p)) WHERE (n_nationkey + i) % 3 = 1 GROUP BY 1")
def first_candidate_page(spark: SparkSession, d: str) -> DataFrame:
    paths = ["/ris", "/sessionnet", "/bi"]
    n = B.read(spark, d, "nation").select(c("n_nationkey").alias("key"), F.concat(F.lit("https://n"), c("n_nationkey").cast("string")).alias("base"))
    pages = n.select("key", "base", F.posexplode(F.array(*[F.lit(p) for p in paths])).alias("i", "p")).select(F.concat("base", "p").alias("url"), F.when((c("key") + c("i")) % 3 == 1, "Gremien und Sitzungskalender").otherwise("nichts").alias("body"))
    return L.candidates(n, paths, pages, answers.COUNCIL_MARKERS)


_UP = "SELECT o_orderkey AS k, o_custkey AS v, o_orderdate AS day_, o_totalprice AS p, o_orderstatus AS s FROM orders"
_SPLIT = f"u AS ({_UP}), b AS (SELECT k % 1000 AS key, min_by(k, day_) AS v FROM u WHERE day_ < TIMESTAMP '1996-01-01' GROUP BY 1), n AS (SELECT k % 1100 AS key, k AS v, row_number() OVER (PARTITION BY k % 1100 ORDER BY day_, k) AS asc_n, row_number() OVER (PARTITION BY k % 1100 ORDER BY day_ DESC, k DESC) AS desc_n FROM u WHERE day_ >= TIMESTAMP '1996-01-01')"


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    u = B.read(spark, d, "orders").select(c("o_orderkey").alias("k"), c("o_orderdate").alias("at"))
    cut = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    base = u.where(c("at") < cut).groupBy((c("k") % 1000).alias("key")).agg(F.min_by("k", F.struct("at", "k")).alias("v"))
    return base, u.where(c("at") >= cut).select((c("k") % 1100).alias("key"), c("k").alias("v"), F.struct("at", "k").alias("order"))


_REVIEWS = f"{B.PROCEDURES_SQL}, {B.PROJECTS_SQL}, p AS (SELECT project_id, needs_review FROM projects), r AS (SELECT project_id, bool_or(review_recommended) AS asked FROM links l JOIN procedures q ON q.procedure_id = l.procedure_id GROUP BY 1)"
_BASE = _SPLIT.replace("min_by(k, day_)", "arg_min(k, (day_, k))")


@query("upsert_last_wins", f"WITH {_BASE} SELECT key, v FROM n WHERE desc_n = 1 UNION ALL SELECT key, v FROM b WHERE key NOT IN (SELECT key FROM n)")
def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    base, delta = _split(spark, d)
    return M.last_wins(base.withColumn("order", F.lit(None).cast(delta.schema["order"].dataType)), delta, ["key"], "order").select("key", "v")


@query("stored_upsert", f"WITH {_BASE} SELECT key, v FROM n WHERE desc_n = 1 UNION ALL SELECT key, v FROM b WHERE key NOT IN (SELECT key FROM n)")
def stored_upsert(spark: SparkSession, d: str) -> DataFrame:
    """`upsert_last_wins` over a written table; the delta comes twice."""
    base, delta = _split(spark, d)
    table = KeyedTable(f"{shared.work_folder(spark)}/upsert", ("key",), 16)
    how = lambda old, new: M.last_wins(old, new, ["key"], "order")
    for rows in (base.select("key", "v", F.lit(None).cast(delta.schema["order"].dataType).alias("order")), delta, delta):
        table.merge(rows, how)
    return table.read(spark).select("key", "v")


@query("insert_ignore", f"WITH {_BASE} SELECT key, v FROM b UNION ALL SELECT key, v FROM n WHERE asc_n = 1 AND key NOT IN (SELECT key FROM b)")
def insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    base, delta = _split(spark, d)
    return M.first_wins(base.withColumn("order", F.lit(None).cast(delta.schema["order"].dataType)), delta, ["key"], "order").select("key", "v")


_PROJECT = "SELECT procedure_id % 2000 AS project_id, {agg} FROM procedures WHERE procedure_id % 2 = {side} GROUP BY 1"
_AGG = "max(CASE WHEN procedure_id % 3 > 0 THEN title END) AS canonical_project_name, max(legal_basis) AS legal_basis_best, max(capacity_mw) AS capacity_mw_best, max(least(score, 1.0::DOUBLE)) AS max_confidence, max(coalesce(procedure_type, 'x')) AS maturity_stage, min(CASE WHEN procedure_id % 5 > 0 THEN seen END) AS first_seen_date, max(CASE WHEN procedure_id % 5 > 0 THEN seen END) AS last_seen_date, bool_or(review_recommended) AS needs_review"


@query("merge_project_policy", f"""WITH {B.PROCEDURES_SQL}, o AS ({_PROJECT.format(agg=_AGG, side=0).replace('% 2000', '% 1500')}), n AS ({_PROJECT.format(agg=_AGG, side=1).replace('% 2000', '% 1501')})
SELECT coalesce(n.project_id, o.project_id) AS project_id, coalesce(n.canonical_project_name, o.canonical_project_name) AS canonical_project_name,
CASE WHEN n.legal_basis_best IN ('§35', '§34') THEN n.legal_basis_best WHEN o.legal_basis_best IN ('§35', '§34') THEN o.legal_basis_best ELSE coalesce(n.legal_basis_best, o.legal_basis_best) END AS legal_basis_best,
CASE WHEN o.project_id IS NULL THEN n.capacity_mw_best WHEN n.project_id IS NULL THEN o.capacity_mw_best ELSE greatest(coalesce(n.capacity_mw_best, 0), coalesce(o.capacity_mw_best, 0)) END AS capacity_mw_best,
CASE WHEN n.project_id IS NULL THEN o.maturity_stage ELSE n.maturity_stage END AS maturity_stage,
CASE WHEN o.project_id IS NULL THEN n.first_seen_date WHEN n.project_id IS NULL THEN o.first_seen_date ELSE least(coalesce(n.first_seen_date, DATE '9999-12-31'), coalesce(o.first_seen_date, DATE '9999-12-31')) END AS first_seen_date,
CASE WHEN o.project_id IS NULL THEN n.needs_review WHEN n.project_id IS NULL THEN o.needs_review ELSE n.needs_review OR o.needs_review END AS needs_review
FROM o FULL OUTER JOIN n ON o.project_id = n.project_id""")
def merge_project_policy(spark: SparkSession, d: str) -> DataFrame:
    def side(k: int, mod: int) -> DataFrame:
        p = B.procedures(spark, d).where(c("procedure_id") % 2 == k)
        seen = F.when(c("procedure_id") % 5 > 0, c("seen"))
        return p.groupBy((c("procedure_id") % mod).alias("project_id")).agg(
            F.max(F.when(c("procedure_id") % 3 > 0, c("title"))).alias("canonical_project_name"), F.lit(None).cast("string").alias("site_location_best"), F.max("legal_basis").alias("legal_basis_best"), F.max("capacity_mw").alias("capacity_mw_best"),
            F.max(F.least(c("score"), F.lit(1.0))).alias("max_confidence"), F.max(F.coalesce("procedure_type", F.lit("x"))).alias("maturity_stage"), F.min(seen).alias("first_seen_date"), F.max(seen).alias("last_seen_date"), F.bool_or("review_recommended").alias("needs_review"),
        )

    return M.merge_projects(side(0, 1500), side(1, 1501)).select("project_id", "canonical_project_name", "legal_basis_best", "capacity_mw_best", "maturity_stage", "first_seen_date", "needs_review")


@query("merge_candidate_status", f"WITH {_SCORED}, u AS (SELECT doc_id AS k, CASE WHEN doc_id % 2 = 0 THEN 'DONE' ELSE 'ERROR' END AS st, CASE WHEN doc_id % 6 = 0 THEN 'late' END AS r FROM s WHERE doc_id % 3 = 0) SELECT doc_id, coalesce(st, 'NEW') AS status, coalesce(r, 'r' || CAST(doc_id % 10 AS VARCHAR)) AS reason FROM s LEFT JOIN u ON k = doc_id")
def merge_candidate_status(spark: SparkSession, d: str) -> DataFrame:
    base = fx(spark, d).select("doc_id", F.lit("NEW").alias("status"), F.concat(F.lit("r"), (c("doc_id") % 10).cast("string")).alias("reason"))
    delta = base.where("doc_id % 3 = 0").select("doc_id", F.when(c("doc_id") % 2 == 0, "DONE").otherwise("ERROR").alias("status"), F.when(c("doc_id") % 6 == 0, "late").alias("reason"))
    return M.update_status(base, delta, "doc_id")


@query("json_backfill", "SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN '{\"url\":\"x\"}' WHEN n_nationkey % 3 = 1 THEN '{\"url\":\"' || lower(n_name) || '\"}' ELSE '{\"a\":1,\"url\":\"' || lower(n_name) || '\"}' END AS metadata FROM nation")
def json_backfill(spark: SparkSession, d: str) -> DataFrame:
    k = c("n_nationkey") % 3
    n = B.read(spark, d, "nation").withColumn("metadata", F.when(k == 0, '{"url":"x"}').when(k == 1, "{}").otherwise('{"a":1}'))
    return M.backfill_json(n, "metadata", "url", F.lower("n_name")).select("n_nationkey", "metadata")


@query("partition_replace", f"WITH {B.SEED_SQL} SELECT municipality_key, name, state FROM seed WHERE state <> 'BB' UNION ALL SELECT municipality_key + 100, lower(name), 'BB' FROM seed WHERE state = 'BB'")
def partition_replace(spark: SparkSession, d: str) -> DataFrame:
    s = B.seed(spark, d).select("municipality_key", "name", "state")
    return M.replace_partition(s, s.where("state = 'BB'").select((c("municipality_key") + 100).alias("municipality_key"), F.lower("name").alias("name"), "state"), "state", "BB")


@query("job_fanout", f"WITH {B.SEED_SQL} SELECT municipality_key, unnest(['RIS', 'GAZETTE', 'MUNICIPAL_WEBSITE']) AS source FROM seed")
def job_fanout(spark: SparkSession, d: str) -> DataFrame:
    return jobs.fan_out(B.seed(spark, d)).select("municipality_key", c("job.source").alias("source"))


def _procs(spark: SparkSession, d: str) -> DataFrame:
    """Relevant announcements with their extracted fields and tokens."""
    x = C.classify(fx(spark, d)).where("is_relevant")
    x = x.withColumns({"location": G.location(c("text")), "company": G.developer(G.companies(c("text"))), "capacity_mw": G.capacity(c("text")), "capacity_mwh": G.capacity(c("text"), "MWh"), "area_hectares": G.area(c("text")), "seen": c("date_hint")})
    return E.signatures(x)


_PLAN = G.plan_token_sql("title", "array_to_string(evidence_snippets[1:3], ' ')")
_FOUNDED = f"""{CL}, q AS (SELECT doc_id, municipality_key AS m, procedure_type AS kind, title, date_hint, {G.location_sql()} AS location, {_PLAN} AS plan, {G.developer_sql(G.companies_sql())} AS company, {G.title_signature_sql()} AS words FROM c WHERE is_relevant),
r AS MATERIALIZED (SELECT *, {G.parcel_token_sql()} AS parcel, {G.company_name_sql("company")} AS dev, row_number() OVER (PARTITION BY m ORDER BY date_hint NULLS FIRST, doc_id) AS nth FROM q),"""
#: Procedure by procedure, the projects of a municipality in a list.
_FOLD = """fold AS (SELECT m, 0::BIGINT AS nth, []::STRUCT(project VARCHAR, place VARCHAR, name VARCHAR, dev VARCHAR)[] AS ps, NULL::BIGINT AS procedure_id, NULL::VARCHAR AS project_id, NULL::DOUBLE AS link_confidence, NULL::VARCHAR AS link_reason FROM (SELECT DISTINCT m FROM r)
  UNION ALL SELECT m, nth, CASE WHEN coalesce(pa, pl, de) IS NULL THEN list_append(ps, {'project': own, 'place': coalesce(parcel, location), 'name': coalesce('B-Plan ' || plan, nullif(title, '')), 'dev': dev}) ELSE ps END, doc_id, coalesce(pa, pl, de, own),
    CASE WHEN pa IS NOT NULL THEN 0.95 WHEN pl IS NOT NULL THEN 0.9 WHEN de IS NOT NULL THEN 0.8 WHEN kind = 'PERMIT_36_EINVERNEHMEN' THEN 0.85 ELSE 1.0 END::DOUBLE,
    CASE WHEN pa IS NOT NULL THEN 'PARCEL_MATCH' WHEN pl IS NOT NULL THEN 'PLAN_TOKEN_MATCH' WHEN de IS NOT NULL THEN 'DEV+TITLE_MATCH' WHEN kind = 'PERMIT_36_EINVERNEHMEN' THEN 'PERMIT_36_NEW' ELSE 'NEW_PROJECT' END
  FROM (SELECT r.*, f.ps, 'project-' || r.doc_id AS own, list_filter(f.ps, lambda x: contains(x.place, r.parcel))[1].project AS pa, list_filter(f.ps, lambda x: contains(x.name, r.plan))[1].project AS pl,
      CASE WHEN r.words <> '' THEN list_filter(list_filter(f.ps, lambda x: x.dev IS NOT NULL)[1:50], lambda x: x.dev = r.dev)[1].project END AS de FROM fold f JOIN r ON r.m = f.m AND r.nth = f.nth + 1))
SELECT m AS municipality_key, procedure_id, project_id, link_confidence, link_reason FROM fold WHERE nth > 0"""
_LINKS = f"WITH RECURSIVE {_FOUNDED} {_FOLD}"


@query("entity_link_fold", _LINKS)
def entity_link_fold(spark: SparkSession, d: str) -> DataFrame:
    """Links of all procedures, settled in rounds over tokens."""
    return founders.linked(_procs(spark, d))


@query("entity_link_stream", _LINKS)
def entity_link_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same links by a stream with keyed state that is stopped and restarted twice."""
    return linking.run(_procs(spark, d), shared.work_folder(spark), 3)


@query("entity_link_keys")
def entity_link_keys(spark: SparkSession, d: str) -> DataFrame:
    return E.link_by_key(_procs(spark, d)).drop("k")


@query("project_rollup", f"""WITH {CL}, q AS (SELECT *, municipality_key AS project_id, {G.capacity_sql()} AS capacity_mw, {G.capacity_sql(unit='MWh')} AS capacity_mwh, {G.area_sql()} AS area_hectares, {G.location_sql()} AS location, {_PLAN} AS plan_token, {G.developer_sql(G.companies_sql())} AS company,
row_number() OVER (PARTITION BY municipality_key ORDER BY coalesce(date_hint, DATE '1900-01-01'), doc_id) AS nth, contains(lower(title), 'plan') AS planned, coalesce(date_hint, DATE '2022-01-01' + CAST(doc_id % 300 AS INT)) AS day FROM c WHERE is_relevant), p AS (SELECT *, {G.parcel_token_sql()} AS parcel_token FROM q),
k AS (SELECT project_id, company, count(*) AS n, min(nth) AS first FROM q GROUP BY 1, 2), v AS (SELECT project_id, arg_max(company, (n, -first)) FILTER (company IS NOT NULL) AS developer_company_best FROM k GROUP BY 1),
r AS (SELECT project_id, coalesce('B-Plan ' || arg_min(plan_token, nth) FILTER (plan_token <> ''), arg_max(title, (length(title), -nth)) FILTER (planned), arg_max(title, (length(title), -nth)) FILTER (title <> '')) AS canonical_project_name,
coalesce(arg_min(parcel_token, nth) FILTER (parcel_token <> ''), arg_max(location, (length(location), -nth)) FILTER (location <> '')) AS site_location_best,
round(max(capacity_mw), 6) AS capacity_mw_best, round(max(capacity_mwh), 6) AS capacity_mwh_best, round(max(area_hectares), 6) AS area_hectares_best,
CASE WHEN bool_or(legal_basis = '§35') THEN '§35' WHEN bool_or(legal_basis = '§34') THEN '§34' WHEN bool_or(legal_basis = '§36') THEN '§36' ELSE arg_min(legal_basis, nth) END AS legal_basis_best, min(day) AS first_seen_date, max(day) AS last_seen_date,
CASE WHEN bool_or(procedure_type = 'PERMIT_BAUGENEHMIGUNG') THEN 'BAUGENEHMIGUNG' WHEN bool_or(procedure_type = 'PERMIT_BAUVORBESCHEID') THEN 'BAUVORBESCHEID' WHEN bool_or(procedure_type = 'PERMIT_36_EINVERNEHMEN') THEN 'PERMIT_36' WHEN bool_or(procedure_type = 'BPLAN_SATZUNG') THEN 'BPLAN_SATZUNG'
WHEN bool_or(procedure_type = 'BPLAN_AUSLEGUNG_3_2') THEN 'BPLAN_AUSLEGUNG' WHEN bool_or(procedure_type IN ('BPLAN_FRUEHZEITIG_3_1', 'BPLAN_AUFSTELLUNG')) THEN 'BPLAN_AUFSTELLUNG' ELSE 'DISCOVERED' END AS maturity_stage,
round(max(confidence_score), 6) AS max_confidence, bool_or(review_recommended) AS needs_review, count(*) AS procedures FROM p GROUP BY 1)
SELECT r.*, developer_company_best FROM r JOIN v ON r.project_id IS NOT DISTINCT FROM v.project_id""")
def project_rollup(spark: SparkSession, d: str) -> DataFrame:
    p = _procs(spark, d).withColumn("created_at", F.date_add(F.lit("2022-01-01").cast("date"), (c("doc_id") % 300).cast("int")).cast("timestamp"))
    r = E.rollup(p.withColumn("project_id", c("municipality_key")))
    return r.withColumns({x: F.round(x, 6) for x in ("capacity_mw_best", "capacity_mwh_best", "area_hectares_best", "max_confidence")})


@query("project_developers", f"WITH {CL}, q AS (SELECT municipality_key AS project_id, {G.developer_sql(G.companies_sql())} AS company, row_number() OVER (PARTITION BY municipality_key ORDER BY coalesce(date_hint, DATE '1900-01-01'), doc_id) AS nth FROM c WHERE is_relevant), k AS (SELECT project_id, company, count(*) AS n, min(nth) AS first FROM q GROUP BY 1, 2) SELECT project_id, arg_max(company, (n, -first)) FILTER (company IS NOT NULL) AS developer_company_best FROM k GROUP BY 1")
def project_developers(spark: SparkSession, d: str) -> DataFrame:
    """The developer of each project."""
    return E.developers(_procs(spark, d).withColumn("project_id", c("municipality_key")))


@query("maturity_stage", f"""WITH {CL}, g AS (SELECT municipality_key, discovery_source, list(DISTINCT procedure_type) AS t FROM c WHERE is_relevant GROUP BY 1, 2)
SELECT municipality_key, discovery_source, CASE WHEN list_contains(t, 'PERMIT_BAUGENEHMIGUNG') THEN 'BAUGENEHMIGUNG' WHEN list_contains(t, 'PERMIT_BAUVORBESCHEID') THEN 'BAUVORBESCHEID' WHEN list_contains(t, 'PERMIT_36_EINVERNEHMEN') THEN 'PERMIT_36' WHEN list_contains(t, 'BPLAN_SATZUNG') THEN 'BPLAN_SATZUNG'
WHEN list_contains(t, 'BPLAN_AUSLEGUNG_3_2') THEN 'BPLAN_AUSLEGUNG' WHEN list_contains(t, 'BPLAN_FRUEHZEITIG_3_1') OR list_contains(t, 'BPLAN_AUFSTELLUNG') THEN 'BPLAN_AUFSTELLUNG' ELSE 'DISCOVERED' END AS stage FROM g""")
def maturity_stage(spark: SparkSession, d: str) -> DataFrame:
    g = C.classify(fx(spark, d)).where("is_relevant").groupBy("municipality_key", "discovery_source").agg(F.collect_set("procedure_type").alias("t"))
    return g.select("municipality_key", "discovery_source", E.stage(c("t")).alias("stage"))


@query("labels_recall", f"WITH {CL} SELECT is_relevant, quality, count(*) AS n, round(avg(confidence_score), 6) AS avg_confidence FROM c JOIN labels l ON l.doc_id = c.doc_id GROUP BY 1, 2")
def labels_recall(spark: SparkSession, d: str) -> DataFrame:
    labels = B.read(spark, d, "labels").select("doc_id", "quality")
    return C.classify(fx(spark, d)).select("doc_id", "is_relevant", "confidence_score").join(labels, "doc_id").groupBy("is_relevant", "quality").agg(F.count("*").alias("n"), F.round(F.avg("confidence_score"), 6).alias("avg_confidence"))


@query("progressive_text", f"WITH {FX}, p AS (SELECT doc_id, string_split(text, chr(10)) AS pages FROM fx) SELECT doc_id, hit, sha256(array_to_string(CASE WHEN hit THEN list_filter(pages, lambda x: trim(x) <> '') ELSE list_filter(pages[1:2], lambda x: trim(x) <> '') END, chr(10) || chr(10))) AS text_sha256 FROM (SELECT *, {S.any_sql('lower(array_to_string(pages[1:2], chr(10)))', store.TRIGGERS)} AS hit FROM p)")
def progressive_text(spark: SparkSession, d: str) -> DataFrame:
    pages = fx(spark, d).select("doc_id", F.split("text", "\n").alias("pages"))
    x = store.progressive(pages, "pages", 2)
    return x.select("doc_id", c("triggered").alias("hit"), X.sha256("text").alias("text_sha256"))


@query("cache_misses", "SELECT page_id, sha256(url) AS key FROM pages WHERE url IS NOT NULL AND sha256(url) NOT IN (SELECT sha256(url) FROM pages WHERE url IS NOT NULL AND page_id % 3 <> 0 AND page_id % 5 <> 0)")
def cache_misses(spark: SparkSession, d: str) -> DataFrame:
    pages = B.pages(spark, d).where("url is not null")
    at = F.when(c("page_id") % 5 == 0, "2024-01-01 00:00:00").otherwise("2024-01-30 00:00:00").cast("timestamp_ntz")
    cache = pages.where("page_id % 3 != 0").select(store.cache_key("url").alias("key"), at.alias("cached_at"))
    return store.misses(pages, cache, F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"), days=7).select("page_id", "key")


@query("robots_allowed", "SELECT page_id, NOT coalesce((SELECT bool_or(starts_with(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), p)) FROM (VALUES ('/fr/'), ('/de/1')) AS r(p)), FALSE) AS allowed FROM pages WHERE url IS NOT NULL")
def robots_allowed(spark: SparkSession, d: str) -> DataFrame:
    pages = B.pages(spark, d).where("url is not null").select("page_id", "url")
    hosts = pages.select(X.authority("url").alias("host")).distinct()
    rules = hosts.select("host", F.explode(F.array(F.lit("/fr/"), F.lit("/de/1"))).alias("prefix"))
    return store.allowed(pages, rules).select("page_id", "allowed")


@query("wfs_features", "SELECT e AS feature, CASE WHEN e % 3 = 0 THEN 'b' ELSE 'a' END || CAST(e AS VARCHAR) AS name, CASE WHEN e % 2 = 0 THEN '' ELSE 'BP' END AS kind FROM (SELECT CAST(event_id AS INT) AS e FROM events)")
def wfs_features(spark: SparkSession, d: str) -> DataFrame:
    e = c("event_id").cast("int")
    num = e.cast("string")
    props = F.when(e % 3 == 0, F.concat(F.lit('{"name":"","bezeichnung":"b'), num, F.lit('"'))).otherwise(F.concat(F.lit('{"name":"a'), num, F.lit('"')))
    doc = F.concat(F.lit('{"features":[{"id":"'), num, F.lit('","properties":'), props, F.when(e % 2 == 0, "").otherwise(',"planArt":"BP"'), F.lit("}}]}"))
    return store.features(B.read(spark, d, "events").select(doc.alias("body"))).select(c("id").cast("int").alias("feature"), "name", c("planart").alias("kind"))


@query("wfs_members", "SELECT CASE WHEN e % 3 > 0 THEN 'a' || e WHEN i = 0 THEN 'a' || e || ' & b' ELSE 'b' || e END AS name, CASE WHEN i = 0 THEN 'BP' ELSE '' END AS kind, CASE WHEN e % 3 = 0 AND i = 1 THEN 'Seedorf' ELSE '' END AS gemeinde FROM (SELECT CAST(event_id AS INT) AS e FROM events), range(2) AS t(i) WHERE e % 3 = 0 OR i = 0")
def wfs_members(spark: SparkSession, d: str) -> DataFrame:
    """Answers in two formats: every third is XML with two members."""
    num = c("event_id").cast("string")
    part = lambda *x: F.concat(F.lit("<wfs:member><xp:BP gml:id='i'>"), *x, F.lit("</xp:BP></wfs:member>"))
    xml = F.concat(
        F.lit('<?xml version="1.0"?><wfs:FeatureCollection xmlns:wfs="http://www.opengis.net/wfs/2.0" xmlns:xp="http://www.xplanung.de/xplangml/6/0">'), part(F.lit("<xp:name>a"), num, F.lit(" &amp; b</xp:name><xp:planArt>BP</xp:planArt>")),
        part(F.lit("<xp:name/><xp:name></xp:name><xp:bezeichnung>b"), num, F.lit("</xp:bezeichnung><xp:ort><xp:gemeinde x='1'>Seedorf</xp:gemeinde></xp:ort>")), F.lit("</wfs:FeatureCollection>"),
    )
    json = F.concat(F.lit('{"features":[{"id":"'), num, F.lit('","properties":{"name":"a'), num, F.lit('","planart":"BP"}}]}'))
    body = F.when(c("event_id") % 3 == 0, xml).otherwise(json)
    return store.features(B.read(spark, d, "events").select(body.alias("body"))).select("name", c("planart").alias("kind"), "gemeinde")


@query("procedure_records")
def procedure_records(spark: SparkSession, d: str) -> DataFrame:
    """The whole record of each valid announcement: scores, tags, extracted fields."""
    x = C.classify(fx(spark, d))
    x = x.withColumn("v", C.validity(c("nn"), c("url"), c("discovery_source"), c("procedure_type"), c("text"))).where("v.ok")
    return x.select("doc_id", "municipality_key", c("nn").alias("title_norm"), S.storage_score_plain(c("text")).alias("storage"), S.grid_score(c("text")).alias("grid"), "procedure_type", "legal_basis", "project_components", "confidence_score", "review_recommended",
        G.capacity(c("text")).alias("capacity_mw"), G.capacity(c("text"), "MWh").alias("capacity_mwh"), G.area(c("text")).alias("area_hectares"), G.decision_date("text").alias("decision_date"), G.developer(G.companies(c("text"))).alias("developer_company"), G.location(c("text")).alias("site_location_raw"), "evidence_snippets")


@query("stream_candidates", f"WITH {_SCORED} SELECT doc_id AS candidate_id, CASE WHEN score >= {S.threshold_sql()} THEN 'ENQUEUED' ELSE 'SKIPPED' END AS status FROM s")
def stream_candidates(spark: SparkSession, d: str) -> DataFrame:
    return jobs.run_candidates(spark, fx(spark, d))


@query("window_counts", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def window_counts(spark: SparkSession, d: str) -> DataFrame:
    """Jobs by day and type through an event-time stream with a watermark."""
    return jobs.daily_counts(spark, f"{d}/events.parquet")



@query("page_text", r"SELECT page_id, sha256(trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', '', 'g'), '<[^>]*>', chr(10), 'g'), '&quot;', chr(34)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s*\n\s*', chr(10), 'g'), chr(10) || ' ')) AS text_sha256 FROM pages WHERE html IS NOT NULL")
def page_text(spark: SparkSession, d: str) -> DataFrame:
    return B.pages(spark, d).where("html is not null").select("page_id", X.sha256(store.page_text("html")).alias("text_sha256"))


@query("page_heads", "SELECT page_id, replace(replace(replace(replace(coalesce(nullif(trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')), ''), nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '')), '&quot;', chr(34)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS title FROM pages WHERE html IS NOT NULL")
def page_heads(spark: SparkSession, d: str) -> DataFrame:
    return B.pages(spark, d).where("html is not null").select("page_id", L.heading("html").alias("title"))


@query("url_patterns", "SELECT n_nationkey, k AS kind, replace(p, '{}', s) AS url FROM (SELECT n_nationkey, " + X.slug_sql("n_name", "D") + " AS s FROM nation), (VALUES " + ", ".join(f"('{k}', '{p}')" for k, ps in L.URL_PATTERNS.items() for p in ps) + ") AS t(k, p)")
def url_patterns(spark: SparkSession, d: str) -> DataFrame:
    return L.guessed_urls(B.read(spark, d, "nation").select("n_nationkey", X.slug("n_name", "D").alias("slug")), "slug").select("n_nationkey", "kind", "url")


@query("path_fallback", "SELECT n_nationkey, 'https://www.' || lower(n_name) || '.de' || p AS url FROM nation, (VALUES " + ", ".join(f"('{p}')" for p in L.SECTION_PATHS) + ") AS t(p) WHERE length(n_name || p) % 3 = 0")
def path_fallback(spark: SparkSession, d: str) -> DataFrame:
    n = B.read(spark, d, "nation").select("n_nationkey", "n_name", F.concat(F.lit("https://www."), F.lower("n_name"), F.lit(".de")).alias("base"))
    tried = n.select("n_nationkey", "n_name", "base", F.explode(F.array(*[F.lit(p) for p in L.SECTION_PATHS])).alias("p"))
    good = tried.where(F.length(F.concat("n_name", "p")) % 3 == 0).select(F.concat("base", "p").alias("url"))
    return L.section_paths(n, good).select("n_nationkey", "url")


@query("point_lookup", f"WITH {B.SEED_SQL} SELECT e.event_id, s.name FROM events e JOIN seed s ON s.municipality_key = e.user_id % 25")
def point_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Lookups by key as one join with the small side."""
    e = B.read(spark, d, "events").select("event_id", (c("user_id") % 25).alias("municipality_key"))
    return e.join(B.seed(spark, d).select("municipality_key", "name"), "municipality_key").select("event_id", "name")


@query("reset_counts", "SELECT 'documents' AS name, count(*) AS rows_before, 0 AS rows_after FROM documents UNION ALL SELECT 'events', count(*), 0 FROM events UNION ALL SELECT 'orders', count(*), count(*) FILTER (o_orderkey = 999) FROM orders")
def reset_counts(spark: SparkSession, d: str) -> DataFrame:
    """What clearing the tables removes and leaves: of the procedures' table the row of one fixed key stays."""
    out = None
    for t, stays in (("documents", F.lit(False)), ("events", F.lit(False)), ("orders", c("o_orderkey") == 999)):
        one = B.read(spark, d, t).agg(F.count("*").alias("rows_before"), F.count_if(stays).alias("rows_after")).select(F.lit(t).alias("name"), "rows_before", "rows_after")
        out = one if out is None else out.unionByName(one)
    return out


@query("link_upsert", f"WITH {B.PROCEDURES_SQL}, b AS (SELECT procedure_id % 500 AS project_id, procedure_id % 7 AS procedure_id, max(bess_score) AS c FROM procedures WHERE procedure_id % 2 = 0 GROUP BY 1, 2), n AS (SELECT procedure_id % 500 AS project_id, procedure_id % 7 AS procedure_id, arg_max(grid_score, procedure_id) AS c FROM procedures WHERE procedure_id % 2 = 1 OR procedure_id % 3 = 0 GROUP BY 1, 2) SELECT coalesce(n.project_id, b.project_id) AS project_id, coalesce(n.procedure_id, b.procedure_id) AS procedure_id, coalesce(n.c, b.c) AS link_confidence FROM b FULL JOIN n ON b.project_id = n.project_id AND b.procedure_id = n.procedure_id")
def link_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Links merged by their two keys; the last of the delta wins."""
    p = B.procedures(spark, d)
    keys = [(c("procedure_id") % 500).alias("project_id"), (c("procedure_id") % 7).alias("link"), "procedure_id"]
    base = p.where("procedure_id % 2 = 0").select(*keys, c("bess_score").alias("v")).groupBy("project_id", "link").agg(F.max("v").alias("v"), F.max("procedure_id").alias("at"))
    delta = p.where("procedure_id % 2 = 1 or procedure_id % 3 = 0").select(*keys, c("grid_score").alias("v")).select("project_id", "link", "v", c("procedure_id").alias("at"))
    return M.last_wins(base, delta, ["project_id", "link"], "at").select("project_id", c("link").alias("procedure_id"), c("v").alias("link_confidence"))


@query("number_labels", "SELECT o_orderkey, replace(format('{:,}', o_orderkey * 1000), ',', '.') AS grouped, substr(o_orderpriority, 1, 3) AS short FROM orders")
def number_labels(spark: SparkSession, d: str) -> DataFrame:
    return B.read(spark, d, "orders").select("o_orderkey", X.grouped(c("o_orderkey") * 1000).alias("grouped"), F.substring("o_orderpriority", 1, 3).alias("short"))


@query("diagnostics_maps", "SELECT user_id, max(CASE WHEN event_id % 2 = 1 THEN event_type END) AS last_odd, count(*) FILTER (event_id % 2 = 1) AS odd FROM events GROUP BY 1")
def diagnostics_maps(spark: SparkSession, d: str) -> DataFrame:
    """Two maps merged, the right one's values winning, then read."""
    odd = c("event_id") % 2 == 1
    per = B.read(spark, d, "events").groupBy("user_id").agg(F.max(F.when(odd, c("event_type"))).alias("t"), F.count_if(odd).cast("string").alias("n"))
    left, right = F.create_map(F.lit("last_odd"), F.lit("none"), F.lit("odd"), c("n")), F.create_map(F.lit("last_odd"), c("t"))
    return per.select("user_id", merged(left, right).alias("m")).select("user_id", F.element_at("m", F.lit("last_odd")).alias("last_odd"), F.element_at("m", F.lit("odd")).cast("long").alias("odd"))


def merged(left, right):
    """A map with all entries of both; the right side's value stands where both have a key."""
    return F.map_concat(F.map_filter(left, lambda k, v: ~F.array_contains(F.map_keys(right), k)), right)


@query("review_flags", f"WITH {_REVIEWS} SELECT project_id, needs_review OR coalesce(asked, FALSE) AS needs_review FROM p LEFT JOIN r USING (project_id)")
def review_flags(spark: SparkSession, d: str) -> DataFrame:
    procs = B.procedures(spark, d)
    return M.flag_reviews(B.projects(procs).select("project_id", "needs_review"), B.project_links(procs), procs.select("procedure_id", "review_recommended")).select("project_id", "needs_review")
