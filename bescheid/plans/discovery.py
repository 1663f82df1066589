"""Queries over recorded pages and answers. The tables below are built from the driver's; the SQL states what must come
out of them from the same numbers, without reading a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import discovery as D
from ..operators import links as L
from ..operators import merge as M
from ..sources import answers as A
from ..sources import pdf
from ..sources.store import dealt
from . import bindings as B
from .base import Book

BOOK = Book()
query = BOOK.query
c = F.col


def _text(x: Column) -> Column:
    return x.cast("string")


def _joined(order: str, x: str) -> Column:
    """Texts of a group, one after another."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, x))), lambda r: r[x]), "")


def _events(spark: SparkSession, d: str) -> DataFrame:
    return B.read(spark, d, "events").select(c("event_id").alias("e"), c("user_id").alias("u"))


# council systems: 60 of them, with four committees each, a session for each event, two items a session
_DAY = "DATE '2022-11-15' + CAST((e * 37) % 90 AS INT)"


def _council(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    day = F.date_add(F.lit("2022-11-15").cast("date"), ((c("e") * 37) % 90).cast("int"))
    label = F.when(c("e") % 11 == 0, "Protokoll").when(c("e") % 9 == 0, "Sitzung ohne Termin").otherwise(F.concat(F.lit("Sitzung am "), F.date_format(day, "dd.MM.yyyy")))
    e = _events(spark, d).select("e", (c("u") % 60).alias("k"), (c("e") % 4).alias("j"), label.alias("label"))
    e = e.withColumn("base", F.concat(F.lit("https://rat"), _text(c("k")), F.lit(".example")))
    named = c("k") % 10 < 7
    link = lambda label: F.concat(F.lit("<li><a class=s href='/s?id="), _text(c("e")), F.lit("'>"), label, F.lit("</a>"))
    answer = lambda url, ok, html: (url.alias("url"), F.when(ok, 200).otherwise(404).alias("status"), html.alias("html"))
    committees = "".join(f'<a href="/g?c={i}">{n}</a>' for i, n in enumerate(("Bauausschuss", "Kulturverein", "Hauptausschuss der Stadt", "Ortsbeirat <b>Mitte</b>")))
    lists = e.select("base", "k").distinct().select(*answer(F.concat("base", F.lit("/gremien")), named, F.lit(committees)))
    pages = e.where(named).withColumn("a", link(c("label"))).groupBy("base", "j").agg(_joined("e", "a").alias("html")).select(*answer(F.concat("base", F.lit("/g?c="), _text(c("j"))), F.lit(True), c("html")))
    direct = e.where(~named & (c("j") == 0)).withColumn("a", link(F.concat(F.lit("Tagesordnung "), _text(c("e"))))).groupBy("base").agg(_joined("e", "a").alias("html"))
    direct = direct.select(*answer(F.concat("base", F.lit("/")), F.lit(True), F.concat(F.lit("<a href=/impressum>Kontakt</a>"), c("html"))))
    item = F.concat(F.lit("<a href=v?id="), _text(c("e")), F.lit(">Bauantrag &quot;Photovoltaik&quot; "), _text(c("e")), F.lit('</a><a href="/f">Feuerwehr</a>'))
    sessions = e.select(*answer(F.concat("base", F.lit("/s?id="), _text(c("e"))), c("e") % 5 != 0, item))
    roots = e.select(_text(c("k")).alias("key"), F.concat("base", F.lit("/")).alias("url")).distinct()
    return roots, lists.unionByName(pages).unionByName(direct).unionByName(sessions)


@query("council_items", f"""WITH e AS (SELECT event_id AS e, user_id % 60 AS k, event_id % 4 AS j, CASE WHEN event_id % 9 > 0 THEN {_DAY.replace('e *', 'event_id *')} END AS day FROM events),
s AS (SELECT *, coalesce(day < DATE '2023-01-01', FALSE) AS old FROM e WHERE k % 10 < 7 AND j IN (0, 2, 3) AND e % 11 > 0),
r AS (SELECT *, CAST(old AS INT) + coalesce(CAST(lag(old) OVER w AS INT), 0) + coalesce(CAST(lag(old, 2) OVER w AS INT), 0) AS run FROM s WINDOW w AS (PARTITION BY k, j ORDER BY e)),
t AS (SELECT *, min(CASE WHEN run = 3 THEN e END) OVER (PARTITION BY k, j) AS stop FROM r),
x AS (SELECT k, e, day, '/g?c=' || j AS path, 'committees' AS method FROM t WHERE stop IS NULL OR e < stop UNION ALL SELECT k, e, NULL, '/', 'direct_fallback' FROM e WHERE k % 10 >= 7 AND j = 0)
SELECT CAST(k AS VARCHAR) AS key, 'https://rat' || k || '.example/v?id=' || e AS url, 'Bauantrag "Photovoltaik" ' || e AS title, day, 'https://rat' || k || '.example' || path AS path, method FROM x WHERE e % 5 > 0""")
def council_items(spark: SparkSession, d: str) -> DataFrame:
    return D.council_items(*_council(spark, d))


@query("council_fallback", """WITH e AS (SELECT event_id AS e, user_id % 50 AS k, 'https://ort' || (user_id % 50) || '.example/' AS base FROM events)
SELECT CAST(k AS VARCHAR) AS key, base || 'Vorlage.asp?id=' || e AS url, 'Antrag ' || e AS title, CAST(NULL AS DATE) AS day, base AS path, 'pattern_fallback' AS method FROM e WHERE e % 2 = 0 AND k % 3 > 0 AND k % 5 > 0""")
def council_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Municipalities without a council system: the fixed pages of valid addresses are searched for items."""
    e = _events(spark, d).select("e", (c("u") % 50).alias("k")).withColumn("base", F.concat(F.when(c("k") % 5 == 0, "ftp").otherwise("https"), F.lit("://ort"), _text(c("k")), F.lit(".example/")))
    link = F.when(c("e") % 2 == 0, F.concat(F.lit("<a href='Vorlage.asp?id="), _text(c("e")), F.lit("'>Antrag "), _text(c("e")), F.lit("</a>"))).otherwise("<a href='/kontakt'>Kontakt</a>")
    pages = e.withColumn("a", link).groupBy("base", "k").agg(_joined("e", "a").alias("html")).select(F.concat("base", F.lit("si0100.php")).alias("url"), F.when(c("k") % 3 > 0, 200).otherwise(404).alias("status"), "html")
    sites = e.select(_text(c("k")).alias("key"), c("base").alias("url")).distinct()
    return D.council_items(sites.where("false"), pages, sites)


# gazettes: 40 feeds with seven issues each; every third issue has files, tells without files, or has an embedded file
def _gazette(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = _events(spark, d).select("e", (c("u") % 40).alias("k"), (c("e") % 7).alias("m"))
    e = e.withColumn("base", F.concat(F.lit("https://blatt"), _text(c("k")), F.lit(".example")))
    issue = F.concat(F.lit("<a href='/i"), _text(c("m")), F.lit("'>"), F.when(c("k") % 5 == 0, "Amtsblatt ").otherwise("Ausgabe "), _text(c("m")), F.lit("</a>"))
    feeds = e.select("base", "k", "m").distinct().withColumn("a", issue).groupBy("base").agg(_joined("m", "a").alias("html"))
    file = F.when(c("m") % 3 == 0, F.concat(F.lit("<a href='/d"), _text(c("e")), F.lit(".PDF'>Plan "), _text(c("e")), F.lit("</a>"))).when(c("m") % 3 == 2, F.concat(F.lit('<a href="x'), _text(c("e")), F.lit('.docx">Anlage</a>'))).otherwise("")
    body = e.withColumn("a", file).groupBy("base", "m").agg(_joined("e", "a").alias("html"))
    head = F.when(c("m") % 3 == 2, F.concat(F.lit("<p>Feste</p><iframe class=v src='/e"), _text(c("m")), F.lit(".pdf#1'></iframe>"))).otherwise(F.concat(F.lit("<title>Blatt "), _text(c("m")), F.lit("</title><p>Aufstellungsbeschluss</p>")))
    pages = body.select(F.concat("base", F.lit("/i"), _text(c("m"))).alias("url"), F.concat(head, c("html")).alias("html"))
    answers = feeds.select(F.concat("base", F.lit("/")).alias("url"), "html").unionByName(pages).withColumn("status", F.lit(200))
    return e.select(_text(c("k")).alias("key"), F.concat("base", F.lit("/")).alias("url")).distinct(), answers


@query("gazette_walk", """WITH e AS (SELECT event_id AS e, user_id % 40 AS k, event_id % 7 AS m, 'https://blatt' || (user_id % 40) || '.example' AS base FROM events)
SELECT CAST(k AS VARCHAR) AS key, base || '/d' || e || '.PDF' AS url, 'Plan ' || e AS title, 'document' AS kind, base || '/i' || m AS path FROM e WHERE m % 3 = 0
UNION ALL SELECT DISTINCT CAST(k AS VARCHAR), base || '/i' || m, 'Blatt ' || m, 'issue', base || '/i' || m FROM e WHERE m % 3 = 1
UNION ALL SELECT CAST(k AS VARCHAR), base || '/x' || e || '.docx', 'Anlage', 'document', base || '/i' || m FROM e WHERE m % 3 = 2
UNION ALL SELECT DISTINCT CAST(k AS VARCHAR), base || '/e' || m || '.pdf#1', 'Embedded PDF', 'document', base || '/i' || m FROM e WHERE m % 3 = 2""")
def gazette_walk(spark: SparkSession, d: str) -> DataFrame:
    return D.gazette_items(*_gazette(spark, d))


# entry pages: a seed for each user; of the official site's addresses, and those guessed, some answer
def _entries(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    seeds = _events(spark, d).select(c("u").alias("key")).distinct()
    address = lambda kind: F.concat(F.lit(f"https://{kind}"), _text(c("n")), F.lit(".u"), _text(c("key")), F.lit(".example/"))
    tried = seeds.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(2))))
    official = tried.where(c("key") % 3 == 0).withColumn("url", address("a"))
    guessed = tried.where(c("key") % 3 < 2).withColumn("url", address("g"))
    x = official.select("key", "n", "url").unionByName(guessed.select("key", "n", "url")).withColumn("e", F.explode(F.sequence(F.lit(0), F.lit(3))))
    h = (c("key") * 7 + c("n") * 3 + c("e")) % 16
    body = F.when(h == 0, "Sitzungskalender").when(h == 1, "Startseite")
    error = F.when(c("key") % 5 == 0, "404 Not Found").when(c("key") % 5 == 1, "SSL: certificate").otherwise("timeout")
    answers = x.select(F.concat(F.regexp_replace("url", "/$", ""), F.element_at(F.array(*[F.lit(p) for p in D.COUNCIL_ENTRIES]), c("e") + 1)).alias("url"), F.when(h < 2, 200).alias("status"), F.when(h >= 2, error).alias("error"), body.alias("body"))
    return official, guessed, seeds, answers


@query("entry_pages", """WITH s AS (SELECT DISTINCT user_id AS key FROM events), t AS (SELECT key, n, e, CASE WHEN key % 3 = 0 THEN 'a' ELSE 'g' END AS kind, (key * 7 + n * 3 + e) % 16 AS h FROM s, range(3) AS a(n), range(4) AS b(e) WHERE key % 3 < 2),
g AS (SELECT key, min(CASE WHEN h = 0 THEN n * 4 + e END) AS best, bool_or(h >= 2) AS failed FROM t GROUP BY key)
SELECT s.key, CASE WHEN best IS NOT NULL THEN 'https://' || CASE WHEN s.key % 3 = 0 THEN 'a' ELSE 'g' END || (best // 4) || '.u' || s.key || '.example' || ['', '/si0100.asp', '/si0100.php', '/index.php'][best % 4 + 1] END AS url,
CASE WHEN s.key % 3 = 0 THEN 'site_driven' ELSE 'pattern_guessing' END AS method,
CASE WHEN s.key % 3 = 2 THEN 'NO_SEED_URL' WHEN best IS NOT NULL THEN 'FOUND' WHEN s.key % 5 = 0 OR NOT failed THEN 'ALL_URLS_404' WHEN s.key % 5 = 1 THEN 'SSL_BLOCKED' ELSE 'NO_MARKERS_FOUND' END AS reason FROM s LEFT JOIN g USING (key)""")
def entry_pages(spark: SparkSession, d: str) -> DataFrame:
    official, guessed, seeds, answers = _entries(spark, d)
    return D.entry_page(official, guessed, seeds, answers, D.COUNCIL_ENTRIES, D.COUNCIL_SIGNS)


@query("site_sections", """SELECT DISTINCT CAST(user_id AS VARCHAR) AS key, 'https://stadt' || user_id || '.example' || CASE WHEN user_id % 3 = 0 THEN '/amt?x=1' ELSE p END AS url, CASE WHEN user_id % 3 = 0 THEN 'links' ELSE 'paths' END AS method FROM events, (VALUES ('/bauleitplanung'), ('/verfahren')) AS t(p) WHERE user_id % 3 = 0 OR user_id % 3 = 1""")
def site_sections(spark: SparkSession, d: str) -> DataFrame:
    k = _events(spark, d).select("u").distinct().select("u", F.concat(F.lit("https://stadt"), _text(c("u")), F.lit(".example")).alias("base"))
    homes = k.select(_text(c("u")).alias("key"), F.concat("base", F.lit("/")).alias("url"))
    page = k.select(F.concat("base", F.lit("/")).alias("url"), F.when(c("u") % 3 == 0, '<a href="amt?x=1">&Ouml;ffentliche Auslegung</a><a href=/a>Kultur</a>').otherwise("<a href=/a>Kultur</a>").alias("html"))
    more = k.where("u % 3 = 1").select(F.explode(F.array(*[F.concat("base", F.lit(p)) for p in ("/bauleitplanung", "/verfahren", "/kultur")])).alias("url"), F.lit("").alias("html"))
    return D.sections(homes, page.unionByName(more).withColumn("status", F.lit(200)))


@query("portal_links", """SELECT DISTINCT CAST(user_id AS VARCHAR) AS key, 'https://plan.example/verfahren/' || user_id AS source_url, 'Plan Nr. ' || user_id AS title_raw FROM events""")
def portal_links(spark: SparkSession, d: str) -> DataFrame:
    k = _events(spark, d).select("u").distinct()
    url = F.concat(F.lit("https://plan.example/liste?u="), _text(c("u")))
    entries = k.select(_text(c("u")).alias("key"), url.alias("url"))
    html = F.concat(F.lit("<a href='/verfahren/"), _text(c("u")), F.lit("'> Plan&nbsp;Nr. "), _text(c("u")), F.lit(" </a><a href='/hilfe'>Verfahren</a>"))
    return D.portal_procedures(entries, k.select(url.alias("url"), F.lit(200).alias("status"), html.alias("html"))).select("key", "source_url", "title_raw")


@query("job_addresses", """SELECT n_nationkey, s AS source, u AS url FROM (SELECT n_nationkey, replace(replace(lower(n_name), ' ', ''), '-', '') AS a, replace(lower(n_name), ' ', '-') AS b FROM nation),
LATERAL (VALUES ('ris', 'https://' || a || '.sessionnet.de'), ('ris', 'https://ris.' || a || '.de'), ('ris', 'https://' || b || '.sessionnet.de'), ('gazette', 'https://' || a || '.de/amtsblatt'), ('gazette', 'https://' || b || '.de/bekanntmachungen'), ('gazette', 'https://www.' || b || '.de/amtsblatt')) AS t(s, u)""")
def job_addresses(spark: SparkSession, d: str) -> DataFrame:
    return D.job_addresses(B.read(spark, d, "nation").select("n_nationkey", "n_name"), "n_name").select("n_nationkey", "source", "url")


# answers: one address for each event
_HOSTS = ["h0.example", "h3.example"]


def _answers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = _events(spark, d).select("e", F.concat(F.lit("://H"), _text(c("u") % 11), F.lit(".example:8080/"), _text(c("e"))).alias("rest"))
    e = e.withColumn("url", F.concat(F.when(c("e") % 13 == 0, "http").otherwise("https"), "rest"))
    row = lambda way, url, status, error, body: e.select(url.alias("url"), F.lit(way).alias("way"), status.cast("int").alias("status"), error.alias("error"), body.alias("body"))
    no, q = F.lit(None).cast("string"), c("e") % 4
    v = row("verified", c("url"), F.when(q == 0, 200).when(q == 1, 404), F.when(q == 2, "ssl").when(q == 3, "timeout"), F.when(q < 2, F.concat(F.lit("v"), _text(c("e")))))
    u = row("unverified", c("url"), F.when(c("e") % 3 == 0, 200).when(c("e") % 3 == 1, 500), F.when(c("e") % 3 == 2, "ssl"), F.when(c("e") % 3 < 2, F.concat(F.lit("u"), _text(c("e")))))
    p = row("plain", F.concat(F.lit("http"), "rest"), F.when(c("e") % 5 < 2, 200).when(c("e") % 5 == 2, 404), no, F.when(c("e") % 5 == 0, F.concat(F.lit("Ratsinformationssystem "), _text(c("e")))).when(c("e") % 5 == 1, "leere Seite"))
    return e.select("url"), v.unionByName(u).unionByName(p)


_ASKED = "a AS (SELECT event_id AS e, user_id % 11 AS h, CASE WHEN event_id % 13 = 0 THEN 'http' ELSE 'https' END || '://H' || (user_id % 11) || '.example:8080/' || event_id AS url FROM events)"
_FETCHED = "CASE WHEN e % 4 < 2 THEN 'verified' WHEN e % 4 = 2 AND h IN (0, 3) AND e % 3 < 2 THEN 'unverified' END"


@query("fetched_answers", f"WITH {_ASKED}, w AS (SELECT *, {_FETCHED} AS way FROM a) SELECT url, way, CASE WHEN way = 'verified' THEN CASE WHEN e % 4 = 0 THEN 200 ELSE 404 END WHEN way = 'unverified' THEN CASE WHEN e % 3 = 0 THEN 200 ELSE 500 END END AS status, CASE way WHEN 'verified' THEN 'v' || e WHEN 'unverified' THEN 'u' || e END AS body FROM w")
def fetched_answers(spark: SparkSession, d: str) -> DataFrame:
    return A.fetched(*_answers(spark, d), _HOSTS)


@query("council_answers", f"""WITH {_ASKED}, w AS (SELECT *, CASE WHEN e % 13 = 0 THEN {_FETCHED} WHEN e % 4 = 0 THEN 'verified' WHEN e % 4 = 2 AND e % 5 = 0 THEN 'plain' END AS way FROM a)
SELECT url, way, CASE WHEN way = 'plain' THEN 200 WHEN way = 'verified' THEN CASE WHEN e % 4 = 0 THEN 200 ELSE 404 END WHEN way = 'unverified' THEN CASE WHEN e % 3 = 0 THEN 200 ELSE 500 END END AS status, CASE way WHEN 'verified' THEN 'v' || e WHEN 'unverified' THEN 'u' || e WHEN 'plain' THEN 'Ratsinformationssystem ' || e END AS body FROM w""")
def council_answers(spark: SparkSession, d: str) -> DataFrame:
    return A.council_fetched(*_answers(spark, d), _HOSTS)


# repeated attempts: four for each address
def _attempts(spark: SparkSession, d: str) -> DataFrame:
    h = (c("e") * 31) % 7
    return _events(spark, d).select(F.concat(F.lit("https://d.example/"), _text(F.expr("e div 4"))).alias("url"), (c("e") % 4 + 1).cast("int").alias("attempt"), F.when(h == 0, 200).when(h == 1, 404).when(h == 2, 500).when(h == 3, 304).alias("status"), F.when(h == 0, F.concat(F.lit("b"), _text(c("e")))).alias("body"))


_TRIED = "t AS (SELECT event_id AS e, event_id // 4 AS g, event_id % 4 + 1 AS n, CASE (event_id * 31) % 7 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 500 WHEN 3 THEN 304 END AS status FROM events WHERE event_id % 4 < 3)"


@query("retried_downloads", f"WITH {_TRIED}, f AS (SELECT g, min(n) FILTER (status IN (200, 404)) AS stop, max(n) AS most FROM t GROUP BY g) SELECT 'https://d.example/' || f.g AS url, CASE WHEN t.status = 200 THEN 'b' || t.e END AS body, CAST(coalesce(stop, most) AS INT) AS attempts, CAST(CASE WHEN stop IS NOT NULL THEN 2 ** (stop - 1) - 1 ELSE 2 ** least(most, 2) - 1 END AS BIGINT) AS waited FROM f LEFT JOIN t ON t.g = f.g AND t.n = f.stop")
def retried_downloads(spark: SparkSession, d: str) -> DataFrame:
    return A.downloaded(_attempts(spark, d))


def _cache(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Requests for all addresses of the attempts, and a cache of every third, each second entry of which is old."""
    urls = _events(spark, d).select(F.expr("e div 4").alias("g")).distinct().withColumn("url", F.concat(F.lit("https://d.example/"), _text(c("g"))))
    at = F.when(c("g") % 2 == 0, "2024-01-30 23:00:00").otherwise("2024-01-01 00:00:00").cast("timestamp")
    entry = urls.where("g % 3 = 0").select("url", at.alias("cached_at"), F.when(c("g") % 4 > 0, F.concat(F.lit("e"), _text(c("g")))).alias("etag"), F.when(c("g") % 5 > 0, "Mon, 01 Jan 2024 00:00:00 GMT").alias("last_modified"), F.concat(F.lit("c"), _text(c("g"))).alias("body"))
    return urls.select("url"), entry


@query("cached_downloads", f"""WITH {_TRIED}, q AS (SELECT DISTINCT event_id // 4 AS g FROM events), m AS (SELECT *, CASE WHEN status = 304 AND g % 6 = 3 THEN 200 ELSE status END AS s FROM t), f AS (SELECT g, min(n) FILTER (s IN (200, 404)) AS stop FROM m GROUP BY g)
SELECT 'https://d.example/' || q.g AS url, CASE WHEN q.g % 6 = 0 THEN 'c' || q.g WHEN m.s = 200 THEN CASE WHEN m.status = 304 THEN 'c' || q.g ELSE 'b' || m.e END END AS body, q.g % 6 = 0 AS hit FROM q LEFT JOIN f USING (g) LEFT JOIN m ON m.g = q.g AND m.n = f.stop""")
def cached_downloads(spark: SparkSession, d: str) -> DataFrame:
    requests, cache = _cache(spark, d)
    return A.cached(requests, cache, _attempts(spark, d), F.lit("2024-01-31 00:00:00").cast("timestamp"), 7 * 86400)


@query("conditional_headers", """SELECT DISTINCT 'https://d.example/' || g AS url, CASE WHEN g % 3 = 0 AND g % 4 > 0 THEN 'e' || g END AS tag, g % 3 = 0 AND g % 5 > 0 AS dated FROM (SELECT event_id // 4 AS g FROM events)""")
def conditional_headers(spark: SparkSession, d: str) -> DataFrame:
    return A.conditional(*_cache(spark, d)).select("url", F.try_element_at("headers", F.lit("If-None-Match")).alias("tag"), F.map_contains_key("headers", F.lit("If-Modified-Since")).alias("dated"))


@query("probed_lengths", "SELECT event_id AS e, CASE WHEN event_id % 3 > 0 AND event_id % 4 = 0 THEN CAST(user_id * 1000 AS BIGINT) END AS length FROM events")
def probed_lengths(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    heads = e.select(_text(c("e")).alias("url"), F.when(c("e") % 4 == 0, 200).otherwise(403).alias("status"), (c("u") * 1000).alias("length"))
    return A.probed(e.select("e", _text(c("e")).alias("url"), (c("e") % 3 > 0).alias("allowed")), heads).select("e", "length")


@query("service_layers", "SELECT n_nationkey, CAST(i AS INT) AS pos, n_name || ':plan' || i AS layer FROM nation, range(3) AS t(i)")
def service_layers(spark: SparkSession, d: str) -> DataFrame:
    kinds = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.concat(F.lit("<wfs:FeatureType><ows:Name>"), c("n_name"), F.lit(":plan"), _text(i), F.lit("</ows:Name><ows:Title>x</ows:Title></wfs:FeatureType>"))), "")
    body = F.concat(F.lit('<?xml version="1.0"?><wfs:WFS_Capabilities xmlns:wfs="http://www.opengis.net/wfs/2.0" xmlns:ows="http://www.opengis.net/ows/1.1"><ows:Name>service</ows:Name><wfs:FeatureTypeList>'), kinds, F.lit("</wfs:FeatureTypeList></wfs:WFS_Capabilities>"))
    return A.layers(B.read(spark, d, "nation").select("n_nationkey", "n_name").select(c("n_nationkey").alias("url"), body.alias("body"))).withColumnRenamed("url", "n_nationkey")


@query("paged_features", """WITH p AS (SELECT n_nationkey AS k, i, CASE WHEN (n_nationkey + i) % 7 = 0 THEN 60 ELSE 100 END AS n FROM nation, range(12) AS t(i)),
g AS (SELECT k, least(1000, CAST(coalesce(sum(n) FILTER (i < CASE WHEN k % 4 = 0 THEN 5 ELSE 12 END AND (k % 15 >= 12 OR i < k % 15)), 0) AS INT)) AS total FROM p GROUP BY k)
SELECT CAST(k AS VARCHAR) AS layer, place, k * 10000 + place AS feature FROM (SELECT k, unnest(range(total)) AS place FROM g)""")
def paged_features(spark: SparkSession, d: str) -> DataFrame:
    """Twelve pages a layer; some layers' pages have a gap from the fifth on, some an empty page."""
    p = B.read(spark, d, "nation").select(c("n_nationkey").cast("long").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("i")).withColumn("n", F.when((c("k") + c("i")) % 7 == 0, 60).otherwise(100))
    before = F.expr("aggregate(sequence(0, i), 0, (s, x) -> s + if(x < i, if((k + x) % 7 = 0, 60, 100), 0))").cast("long")
    rows = p.withColumn("from", before)
    features = F.when(c("i") == c("k") % 15, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(1).cast("long"), c("n").cast("long")), lambda x: c("k") * 10000 + c("from") + x - 1))
    batches = rows.select(_text(c("k")).alias("layer"), (c("from") + F.when((c("k") % 4 == 0) & (c("i") >= 5), 1).otherwise(0)).alias("start"), features.alias("features"))
    return A.paged(batches)


@query("pdf_texts", "SELECT p_partkey, CAST(4 AS INT) AS pages, replace(p_name, '(', '') || chr(10) || p_brand || chr(10) || chr(10) || p_type AS first_two, replace(p_name, '(', '') || chr(10) || p_brand || chr(10) || chr(10) || p_type || chr(10) || chr(10) || '(' || p_size || ')' AS text FROM part")
def pdf_texts(spark: SparkSession, d: str) -> DataFrame:
    """Files of four pages, the third empty, made from parts."""
    show = lambda *xs: F.concat(*[F.concat(F.lit("0 -12 Td ("), x, F.lit(") Tj ")) for x in xs])
    name = F.replace("p_name", F.lit("("), F.lit(""))
    texts = [show(name, c("p_brand")), show(c("p_type")), F.lit(""), show(F.concat(F.lit("\\("), _text(c("p_size")), F.lit("\\)")))]
    kids = " ".join(f"{10 + i} 0 R" for i in range(4))
    pages = [F.concat(F.lit(f"{10 + i} 0 obj <</Type /Page /Parent 2 0 R /Contents {20 + i} 0 R>> endobj\n{20 + i} 0 obj <<>>\nstream\nBT /F1 12 Tf "), t, F.lit("ET\nendstream endobj\n")) for i, t in enumerate(texts)]
    file = F.concat(F.lit(f"%PDF-1.4\n1 0 obj <</Type /Catalog /Pages 2 0 R>> endobj\n2 0 obj <</Type /Pages /Kids [{kids}] /Count 4>> endobj\n"), *pages[::-1], F.lit("trailer <</Root 1 0 R>>\n%%EOF"))
    x = dealt(B.read(spark, d, "part")).select("p_partkey", pdf.page_texts(F.encode(file, "ISO-8859-1")).alias("p"))
    return x.select("p_partkey", F.size("p").alias("pages"), pdf.text("p", 2).alias("first_two"), pdf.text("p").alias("text"))


@query("same_host_links", "SELECT e AS event_id, h = 0 AS same FROM (SELECT event_id AS e, event_id % 3 AS h FROM events)")
def same_host_links(spark: SparkSession, d: str) -> DataFrame:
    host = F.concat(F.lit("https://H"), _text(c("e") % 3), F.lit(".example/x"))
    return _events(spark, d).select(c("e").alias("event_id"), L.same_host(F.lit("http://h0.example/a?b"), host).alias("same"))


# the procedure upsert with its 26 columns, and the statistics'
_SIDE = "SELECT {key} AS key, {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY o_orderkey DESC) AS n FROM orders WHERE o_orderkey % 2 = {side}) WHERE n = 1"
_MADE = ", ".join(f"'{x}' || o_orderkey AS {x}" for x in (*M.PROCEDURE_REPLACED, *M.PROCEDURE_KEPT))


@query("procedure_upsert", f"WITH o AS ({_SIDE.format(key='o_orderkey % 3000', columns=_MADE, side=0)}), n AS ({_SIDE.format(key='o_orderkey % 3100', columns=_MADE, side=1)}) SELECT coalesce(n.key, o.key) AS procedure_id, " + ", ".join([f"coalesce(n.{x}, o.{x}) AS {x}" for x in M.PROCEDURE_REPLACED] + [f"coalesce(o.{x}, n.{x}) AS {x}" for x in M.PROCEDURE_KEPT]) + " FROM o FULL JOIN n ON o.key = n.key")
def procedure_upsert(spark: SparkSession, d: str) -> DataFrame:
    o = B.read(spark, d, "orders").select("o_orderkey")
    made = [F.concat(F.lit(x), _text(c("o_orderkey"))).alias(x) for x in (*M.PROCEDURE_REPLACED, *M.PROCEDURE_KEPT)]
    side = lambda n, m: o.where(c("o_orderkey") % 2 == n).select((c("o_orderkey") % m).alias("procedure_id"), "o_orderkey", *made)
    base = side(0, 3000).groupBy("procedure_id").agg(*[F.max_by(x, "o_orderkey").alias(x) for x in (*M.PROCEDURE_REPLACED, *M.PROCEDURE_KEPT)])
    return M.upsert(base, side(1, 3100), ["procedure_id"], "o_orderkey", M.PROCEDURE_REPLACED)


@query("stats_upsert", """WITH x AS (SELECT user_id % 5 AS run_id, user_id % 700 AS job_id, 'h' || event_id AS domain, event_id AS counts, value AS timings, event_id % 3 = 0 AS old, event_id FROM events),
o AS (SELECT run_id, job_id, arg_max(domain, event_id) AS domain, max(counts) AS counts, arg_max(timings, event_id) AS timings FROM x WHERE old GROUP BY ALL), n AS (SELECT run_id, job_id, arg_max(domain, event_id) AS domain, max(counts) AS counts, arg_max(timings, event_id) AS timings FROM x WHERE NOT old GROUP BY ALL)
SELECT coalesce(n.run_id, o.run_id) AS run_id, coalesce(n.job_id, o.job_id) AS job_id, coalesce(o.domain, n.domain) AS domain, coalesce(n.counts, o.counts) AS counts, CASE WHEN n.run_id IS NULL THEN o.timings ELSE n.timings END AS timings FROM o FULL JOIN n ON o.run_id = n.run_id AND o.job_id = n.job_id""")
def stats_upsert(spark: SparkSession, d: str) -> DataFrame:
    x = B.read(spark, d, "events").select((c("user_id") % 5).alias("run_id"), (c("user_id") % 700).alias("job_id"), F.concat(F.lit("h"), _text(c("event_id"))).alias("domain"), c("event_id").alias("counts"), c("value").alias("timings"), (c("event_id") % 3 == 0).alias("old"), "event_id")
    base = x.where("old").groupBy("run_id", "job_id").agg(*[F.max_by(y, "event_id").alias(y) for y in ("domain", "counts", "timings")])
    return M.upsert(base, x.where("not old").drop("old"), ["run_id", "job_id"], "event_id", ["counts", "timings"])


@query("request_schedule", "SELECT event_id AS e, CAST(CASE WHEN user_id % 3 = 0 THEN 10 ELSE 1 END * (row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1) AS DOUBLE) AS starts FROM events")
def request_schedule(spark: SparkSession, d: str) -> DataFrame:
    host = F.when(c("u") % 3 == 0, "geobasis-bb.de").when(c("u") % 3 == 1, "a.example").otherwise("b.example")
    return A.paced(_events(spark, d).select("e", F.concat(F.lit("https://"), host, F.lit("/"), _text(c("e"))).alias("url")), "e").select("e", "starts")
