"""Discovery over recorded pages: where a municipality's systems are, and the walk from there to announcements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..functions import text as X
from ..sources.shared import cut
from . import links as L

# Entry points and markers of council systems and gazettes, the age limit of sessions, words of issues and portals.
COUNCIL_ENTRIES = ["", "/si0100.asp", "/si0100.php", "/index.php"]
COUNCIL_SIGNS = ["sitzung", "gremium", "tagesordnung", "beschluss"]
GAZETTE_SIGNS = ["amtsblatt", "bekanntmachung", "veröffentlichung", "ausgabe"]
CUTOFF, OLD_RUN = "2023-01-01", 3
FALLBACK_PATHS = ["si0100.asp", "si0100.php", "index.php"]
OLD_ISSUE_TERMS = ["amtsblatt", "bekanntmachung", "ausgabe", "nummer"]
PORTAL_TERMS = ["verfahren", "participation"]
JOB_PATTERNS = {
    "ris": [("joined", "https://{}.sessionnet.de"), ("joined", "https://ris.{}.de"), ("hyphened", "https://{}.sessionnet.de")],
    "gazette": [("joined", "https://{}.de/amtsblatt"), ("hyphened", "https://{}.de/bekanntmachungen"), ("hyphened", "https://www.{}.de/amtsblatt")],
}


def entry_page(official: DataFrame, guessed: DataFrame, seeds: DataFrame, answers: DataFrame, entries: list[str], signs: list[str]) -> DataFrame:
    """For each seed (key) its first page, if any: key, url, method, reason.

    Addresses (key, n, url) of the official site are tried in order, those guessed only where it gives none; each with
    every entry point. The first answer (url, status, error, body) with status 200 and a sign of the system wins.
    Without one the reason follows from the failures.
    """
    tried = official.select("key", "n", "url", F.lit("site_driven").alias("method")).unionByName(
        guessed.join(official.select("key").distinct(), "key", "left_anti").select("key", "n", "url", F.lit("pattern_guessing").alias("method"))
    )
    x = tried.select("key", "method", "n", F.posexplode(F.array(*[F.concat(F.regexp_replace("url", "/+$", ""), F.lit(e)) for e in entries])).alias("e", "url"))
    x = x.join(answers.select("url", "status", "error", "body"), "url", "left")
    good = (F.col("status") == 200) & L.any_term(F.lower("body"), signs)
    per = x.groupBy("key").agg(
        F.min_by("url", F.when(good, F.struct("n", "e"))).alias("url"), F.min("method").alias("method"),
        F.coalesce(F.bool_and(F.contains("error", F.lit("404")) | F.contains("error", F.lit("Not Found"))), F.lit(True)).alias("missing"),
        F.coalesce(F.bool_or(F.contains("error", F.lit("SSL")) | F.contains("error", F.lit("certificate"))), F.lit(False)).alias("ssl"),
    )
    reason = F.when(F.col("method").isNull(), "NO_SEED_URL").when(F.col("url").isNotNull(), "FOUND").when(F.col("missing"), "ALL_URLS_404").when(F.col("ssl"), "SSL_BLOCKED").otherwise("NO_MARKERS_FOUND")
    return seeds.select("key").join(per, "key", "left").select("key", "url", F.coalesce("method", F.lit("pattern_guessing")).alias("method"), reason.alias("reason"))


def _from(pages: DataFrame, answers: DataFrame) -> DataFrame:
    """Links of the good answers to `pages` (any columns, url): those columns, url, pos, href, text, address.

    Addresses are joined to the answer's own, a plain column.
    """
    own = [x for x in pages.columns if x != "url"]
    asked = pages.select(F.struct(*own).alias("_row"), F.col("url").alias("_asked"))
    html = answers.where("status = 200").select("url", "html")
    found = L.links(asked.join(html, F.col("_asked") == F.col("url")).select("_row", "url", "html"), "_row")
    return found.select("_row.*", "url", "pos", "href", "text", L.absolute("url", "href").alias("address"))


def council_items(roots: DataFrame, answers: DataFrame, unfound: DataFrame | None = None) -> DataFrame:
    """Items of council systems: key, url, title, day, path, method, by way of committees and their sessions.

    From a root (key, url) the pages of committees follow, of those the sessions in order until OLD_RUN in a row are
    older than CUTOFF, of those the items with a telling word. Where a root names no committee its sessions are taken
    directly. `answers` (url, status, html) are the recorded pages. Municipalities of which no system was found
    (`unfound`: key, url of the site) give the links with an item's marker on the fixed pages below a valid address.

    What each step finds is written once, so the recorded pages are read once for each step: the fixed pages, the
    committees' and lone roots', the sessions'.
    """
    below = F.transform(F.array(*[F.lit(p) for p in L.COMMITTEE_PATHS]), lambda p: F.struct(p.alias("path"), F.lit(False).alias("lost")))
    first = roots.select("key", F.col("url").alias("root"), F.explode(below).alias("p"))
    if unfound is not None:
        valid = unfound.where("url like 'http://%' or url like 'https://%'")
        first = first.unionByName(valid.select("key", F.col("url").alias("root"), F.explode(F.transform(F.array(*[F.lit(p) for p in FALLBACK_PATHS]), lambda p: F.struct(p.alias("path"), F.lit(True).alias("lost")))).alias("p")))
    first = first.select("key", "root", F.col("p.lost").alias("lost"), L.absolute("root", "p.path").alias("url")).distinct()
    found = _from(first, answers).where(F.when(F.col("lost"), L.any_term(F.lower("href"), L.ITEM_MARKERS)).otherwise(L.any_term(F.lower("text"), L.COMMITTEES)))
    found = cut(found.select("key", "root", "lost", "pos", "text", "address"))
    committees = found.where("not lost").select("key", F.col("address").alias("url"), F.lit("committees").alias("method")).distinct()
    lone = roots.join(committees.select("key").distinct(), "key", "left_anti").select("key", "url", F.lit("direct_fallback").alias("method"))
    named = _from(committees.unionByName(lone), answers)
    named = named.where(F.when(F.col("method") == "committees", L.any_term(F.lower("text"), L.SESSION_TERMS)).otherwise(L.any_term(F.lower("text"), L.DIRECT_SESSION_TERMS)))
    named = cut(named.select("key", "url", "method", "pos", "address", F.when(F.col("method") == "committees", L.dated(F.col("text"))).alias("day")))
    kept = L.until_old(named.where("method = 'committees'"), ["key", "url"], "pos", "day", CUTOFF, OLD_RUN).unionByName(named.where("method != 'committees'"))
    items = L.by_term(_from(kept.select("key", F.col("url").alias("path"), F.col("address").alias("url"), "day", "method"), answers), L.ITEM_TERMS, "text")
    out = items.select("key", F.col("address").alias("url"), F.col("text").alias("title"), "day", "path", "method")
    lost = found.where("lost").select("key", F.col("address").alias("url"), F.col("text").alias("title"), F.lit(None).cast("date").alias("day"), F.col("root").alias("path"), F.lit("pattern_fallback").alias("method"))
    return out if unfound is None else out.unionByName(lost)


def gazette_items(feeds: DataFrame, answers: DataFrame) -> DataFrame:
    """Items of gazettes: key, url, title, kind, path. From a feed (key, url) the issues follow, of those with a planning
    word the PDF files, or the issue itself without any; other issues give their files and embedded PDFs.

    A feed without issue links is read by the older, wider words. The issues found are written once; each issue's page
    gives all its items in one look.
    """
    telling = lambda x, terms: L.any_term(F.lower(x), terms)
    all_ = _from(feeds.select("key", "url"), answers).where(telling(F.col("text"), [*L.ISSUE_TERMS, *OLD_ISSUE_TERMS]))
    all_ = cut(all_.select("key", F.col("address").alias("url"), telling(F.col("text"), L.ISSUE_TERMS).alias("new")))
    newer = all_.where("new").select("key").distinct()
    issues = all_.where("new").unionByName(all_.where("not new").join(newer, "key", "left_anti")).select("key", F.col("url").alias("_asked")).distinct()
    pages = answers.where("status = 200").select("url", "html")
    read = issues.join(pages, F.col("_asked") == F.col("url")).select("key", "url", "html", telling(F.col("html"), L.GAZETTE_TERMS).alias("telling"))
    found = read.withColumn("links", L.read_links("html"))
    ends = lambda x: F.when(F.col("telling"), F.lower(x["href"]).endswith(".pdf")).otherwise(L.any_end(F.lower(x["href"]), L.DOCUMENT_ENDS))
    item = lambda href, title, kind: F.struct(href.alias("href"), title.alias("title"), F.lit(kind).alias("kind"))
    files = F.transform(F.filter("links", ends), lambda x: item(x["href"], F.when(F.col("telling") & (x["text"] == ""), "Amtsblatt PDF").otherwise(x["text"]), "document"))
    frames = F.transform(iframe_files("html"), lambda x: item(x, F.lit("Embedded PDF"), "document"))
    itself = F.array(item(F.lit(""), F.coalesce(L.heading_of("html", "title"), F.lit("Amtsblatt Issue")), "issue"))
    given = X.let(files, lambda f: F.when(~F.col("telling"), F.concat(f, frames)).when(F.size(f) > 0, f).otherwise(itself))
    out = found.select("key", F.col("url").alias("path"), F.explode(given).alias("x"))
    return out.select("key", L.absolute("path", "x.href").alias("url"), "x.title", "x.kind", "path")


def iframe_files(html: Column | str) -> Column:
    """Addresses of embedded PDFs, in order."""
    return F.filter(F.transform(markup.tags(html, "iframe", "src"), lambda x: x["value"]), lambda x: F.lower(x).contains(".pdf"))


def sections(homes: DataFrame, answers: DataFrame) -> DataFrame:
    """Addresses (key, url, method) of the sections of municipal sites (key, url): links with a telling word on the home
    page, else those of the fixed paths that answer with status 200."""
    linked = cut(L.by_term(_from(homes, answers), L.SECTION_TERMS, "both").select("key", F.col("address").alias("url"), F.lit("links").alias("method")).distinct())
    rest = homes.join(linked.select("key").distinct(), "key", "left_anti").select("key", F.regexp_replace("url", "/+$", "").alias("base"))
    fixed = L.section_paths(rest, answers.where("status = 200").select("url")).select("key", "url", F.lit("paths").alias("method"))
    return linked.unionByName(fixed)


def portal_procedures(entries: DataFrame, answers: DataFrame) -> DataFrame:
    """Normalized procedures of a planning portal (key, url): links whose address tells one, with title key and hash."""
    found = _from(entries, answers)
    hit = found.where(L.any_term(F.col("href"), PORTAL_TERMS))
    return hit.select("key", F.col("address").alias("source_url"), F.col("text").alias("title_raw"), X.normalize_title("text").alias("title_norm"), X.procedure_hash(F.col("text"), F.coalesce("key", F.lit(""))).alias("procedure_hash"))


def job_addresses(seeds: DataFrame, name: str) -> DataFrame:
    """One row for each address that a job tries for a municipality: its columns, source, url."""
    low = F.lower(name)
    forms = {"joined": F.replace(F.replace(low, F.lit(" "), F.lit("")), F.lit("-"), F.lit("")), "hyphened": F.replace(low, F.lit(" "), F.lit("-"))}
    made = [F.struct(F.lit(s).alias("source"), F.replace(F.lit(p), F.lit("{}"), forms[f]).alias("url")) for s, ps in JOB_PATTERNS.items() for f, p in ps]
    return seeds.withColumn("x", F.explode(F.array(*made))).select(*seeds.columns, "x.source", "x.url")
