"""Links of web pages and the rules that pick announcements among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import markup
from ..functions.text import decode_references
from ..sources.shared import cut
from .running import running

# Words in link texts and addresses that decide what is harvested, and guessed paths.
SECTION_TERMS = [
    "bauen", "planung", "bebauungsplan", "bauleitplanung", "b-plan", "stadtplanung", "flaechennutzungsplan", "fnp", "bekanntmachung", "bekanntmachungen", "amtliche", "öffentlich", "oeffentlich",
    "satzung", "satzungen", "verordnung", "verordnungen", "verfahren", "beteiligung", "auslegung", "aufstellung", "bauvorbescheid", "baugenehmigung", "bauantrag", "bauvorhaben",
    "bauausschuss", "planungsausschuss", "gemeindevertretung",
]
PLAN_TERMS = ["bebauungsplan", "b-plan", "bauleitplanung", "aufstellungsbeschluss", "auslegung", "satzung", "bauvorbescheid", "baugenehmigung", "einvernehmen", "verfahren", "beteiligung"]
COMMITTEES = ["bauausschuss", "hauptausschuss", "gemeindevertretung", "stadtverordnetenversammlung", "ortsbeirat", "bau- und planungsausschuss", "planungsausschuss"]
SESSION_TERMS = ["sitzung", "sitzungstag", "datum"]
DIRECT_SESSION_TERMS = ["sitzung", "tagesordnung", "beschluss"]
ITEM_TERMS = [
    "bebauungsplan", "b-plan", "bauleitplanung", "bauvorbescheid", "baugenehmigung", "einvernehmen", "§ 36", "§36", "§ 35", "§35", "§ 34", "§34", "bauantrag", "bauvoranfrage", "vorbescheid",
    "stellungnahme", "kenntnisnahme", "antrag auf errichtung", "batteriespeicher", "energiespeicher", "speicheranlage", "speicher", "photovoltaik", "umspannwerk", "energie", "containeranlage",
]
ITEM_MARKERS = ["si0200", "si0300", "dokument", "vorlage", "antrag"]
ISSUE_TERMS = ["ausgabe", "nummer", "jahr", "2023", "2024", "2025"]
GAZETTE_TERMS = [
    "bebauungsplan", "b-plan", "bauleitplanung", "aufstellungsbeschluss", "öffentliche auslegung", "satzungsbeschluss", "bauvorbescheid", "baugenehmigung", "§ 36", "§36", "gemeindliches einvernehmen",
    "batteriespeicher", "energiespeicher", "speicheranlage",
]
DOCUMENT_ENDS = [".pdf", ".doc", ".docx"]
SECTION_PATHS = [
    "/bekanntmachungen", "/amtliche-bekanntmachungen", "/oeffentliche-bekanntmachungen", "/öffentliche-bekanntmachungen", "/aktuelles/bekanntmachungen", "/bauleitplanung", "/stadtplanung",
    "/bebauungsplaene", "/bebauungspläne", "/bauleitplaene", "/bauleitpläne", "/planung-und-bauen", "/bauen-und-wohnen", "/b-plan", "/bebauungsplan", "/verfahren", "/beteiligung",
]
COMMITTEE_PATHS = ["/si0100.asp", "/si0100.php", "/index.php", "/sitzungen", "/gremien", "/tagesordnung", "/beschlussvorlagen", "/niederschriften", "/protokolle"]
GAZETTE_PATHS = ["/amtsblatt", "/amtliches-mitteilungsblatt", "/bekanntmachungen", "/amtliche-bekanntmachungen", "/veröffentlichungen", "/veroeffentlichungen"]
URL_PATTERNS = {
    "ris": ["https://{}.sessionnet.de", "https://ris.{}.de", "https://{}.allris.de", "https://allris.{}.de"],
    "gazette": ["https://{}.de/amtsblatt", "https://www.{}.de/amtsblatt"],
}


def links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per link of `pages` (key, url, html): key, url, pos (from 1), href, text without tags.

    Read before they are exploded: filters by many words then look at a column, not each at the whole expression.
    """
    own = list(dict.fromkeys((key, "url")))
    return pages.select(*own, F.posexplode(read_links("html")).alias("p", "a")).select(*own, (F.col("p") + 1).alias("pos"), "a.href", "a.text")


def read_links(html: Column | str) -> Column:
    """The links of a page in order, as structs of href and text: expressions only, in one pass over the page split at its
    anchors, with character references decoded."""
    text = lambda x: F.trim(F.regexp_replace(decode_references(markup.without_tags(F.get(F.split(x, "(?i)</a>", 2), 0), " ")), r"[\s\u00a0]+", " "))
    return F.transform(markup.tags(html, "a", "href"), lambda x: F.struct(decode_references(x["value"]).alias("href"), text(x["inside"]).alias("text")))


#: The same in DuckDB, by splitting at anchors; it decodes the references that the tables hold.
LINKS_SQL = r"""pieces AS (SELECT page_id, url, unnest(x) AS p, generate_subscripts(x, 1) AS n FROM (SELECT page_id, url, string_split_regex(html, '(?i)<a\s') AS x FROM pg)),
valued AS (SELECT page_id, url, n, p, regexp_extract(' ' || regexp_extract(p, '^[^>]*'), '(?i)\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s"'']+)', 1) AS v FROM pieces WHERE n > 1 AND contains(p, '>')),
l AS (SELECT page_id, url, row_number() OVER (PARTITION BY page_id, url ORDER BY n) AS pos, replace(CASE WHEN left(v, 1) IN ('"', '''') THEN v[2:-2] ELSE v END, '&amp;', '&') AS href,
  trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(string_split_regex(regexp_extract(p, '(?s)^[^>]*>(.*)$', 1), '(?i)</a>')[1], '<[^>]*>', ' ', 'g'), '&sect;', '§'), '&#167;', '§'), '&#xA7;', '§'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g')) AS text
  FROM valued WHERE v <> '')"""


def any_term(x: Column, terms: list[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | x.contains(t)
    return out


def any_end(x: Column, ends: list[str]) -> Column:
    out = F.lit(False)
    for e in ends:
        out = out | x.endswith(e)
    return out


def by_term(found: DataFrame, terms: list[str], where: str = "both") -> DataFrame:
    """Links whose text, address or either holds a term."""
    x = {"text": F.lower("text"), "href": F.lower("href"), "both": F.lower(F.concat_ws(" ", "text", "href"))}[where]
    return found.where(any_term(x, terms))


def documents(found: DataFrame) -> DataFrame:
    """Links to files, by the ending of their path."""
    return found.where(any_end(F.lower(F.regexp_replace("href", r"[?#].*$", "")), DOCUMENT_ENDS))


def first_per_address(found: DataFrame) -> DataFrame:
    """Links without query and fragment, the first of each page and address."""
    clean = found.withColumn("address", F.regexp_replace("href", r"[?#].*$", ""))
    w = W.partitionBy("page_id", "address").orderBy("pos")
    return clean.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def _plain(path: Column) -> Column:
    """A path without its dot segments."""
    segments = F.split(path, "/")
    drop = lambda acc: F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))
    step = lambda acc, s: F.when(s == "..", drop(acc)).when(s == ".", acc).otherwise(F.concat(acc, F.array(s)))
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    open_end = F.element_at(segments, -1).isin(".", "..")
    return F.when(path.contains("/."), F.array_join(F.when(open_end, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")).otherwise(path)


def absolute(base: Column | str, href: Column | str) -> Column:
    """Addresses made absolute against a page's own, without dot segments; null where either is null."""
    base, h = (F.col(x) if isinstance(x, str) else x for x in (base, href))
    scheme = r"[A-Za-z][A-Za-z0-9+.-]*:"
    origin = F.regexp_extract(base, f"^(?:{scheme})?(?://[^/?#]*)?", 0)
    path = F.regexp_extract(base, f"^(?:{scheme})?(?://[^/?#]*)?([^?#]*)", 1)
    own, rest = F.regexp_extract(h, "^[^?#]*", 0), F.regexp_extract(h, r"(?s)[?#].*$", 0)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, "(?s)^(?:.*/)?", 0))
    return (
        F.when(base.isNull() | h.isNull(), None).when(h == "", base).when(h.rlike(f"^{scheme}"), h)
        .when(h.startswith("//"), F.concat(F.regexp_extract(base, f"^{scheme}", 0), h))
        .when(h.startswith("/"), F.concat(origin, _plain(own), rest))
        .when(h.startswith("?"), F.concat(origin, path, h)).when(h.startswith("#"), F.concat(F.regexp_extract(base, "^[^#]*", 0), h))
        .otherwise(F.concat(origin, _plain(F.concat(folder, own)), rest))
    )


def same_host(a: Column, b: Column) -> Column:
    return F.lower(F.try_parse_url(a, F.lit("HOST"))) == F.lower(F.try_parse_url(b, F.lit("HOST")))


def council_rank(url: Column) -> Column:
    u = F.lower(url)
    return F.when(u.contains("allris") | u.contains("sessionnet"), 10).otherwise(0) + F.when(u.contains("si0100") | u.contains("ris"), 5).otherwise(0)


def gazette_rank(url: Column) -> Column:
    u = F.lower(url)
    return F.when(u.contains("amtsblatt"), 10).otherwise(0) + F.when(u.contains("bekanntmachung"), 5).otherwise(0)


def reach(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """Addresses that links (src, dst) lead to from `seeds` (url) in at most `depth` steps, with their distance.

    Each step's new addresses are written once and are all that the next step joins, so a step's work follows its
    frontier, plans do not grow with the depth, and visited addresses are left out, so cycles end. It ends early when a
    step finds nothing new.
    """
    front = cut(seeds.select("url", F.lit(0).alias("depth")).distinct())
    seen = front
    for d in range(1, depth + 1):
        new = edges.join(front.select(F.col("url").alias("src")), "src").select(F.col("dst").alias("url")).distinct()
        front = cut(new.join(seen.select("url"), "url", "left_anti").select("url", F.lit(d).alias("depth")))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def candidates(seeds: DataFrame, patterns: list[str], pages: DataFrame, marker: list[str]) -> DataFrame:
    """For each seed (key, base) the first pattern whose address is a page (url, body) with a marker, if any."""
    tried = seeds.select("key", F.posexplode(F.array(*[F.concat("base", F.lit(p)) for p in patterns])).alias("n", "url"))
    good = pages.where(any_term(F.lower("body"), marker)).select("url")
    return tried.join(good, "url").groupBy("key").agg(F.min_by("url", "n").alias("url"))


def until_old(rows: DataFrame, key: str | list[str], order: str, day: str, cutoff: str, run: int = 3) -> DataFrame:
    """Rows of each key in order, up to the row that completes `run` consecutive days before `cutoff`.

    That row and all later ones go; the first old rows stay; an undated row breaks the run. Numbers of rows and of old
    rows so far tell the runs: within one their difference stays. They run over ranges (`running`), so a key with most
    rows is no single task; a key's first stop is a pre-aggregated minimum.
    """
    keys = [key] if isinstance(key, str) else key
    old = F.coalesce(F.col(day) < F.lit(cutoff).cast("date"), F.lit(False))
    x = running(rows.withColumn("_old", old), keys, [order], {"_n": F.lit(1), "_c": F.col("_old").cast("int")})
    x = x.withColumns({"_key": F.xxhash64(*keys), "_more": F.xxhash64(F.lit(1), *keys)})
    runs = x.where("_old").groupBy("_key", "_more", F.expr("_n - _c").alias("_run")).agg(F.min("_n").alias("_first"), F.count("*").alias("_held")).where(F.col("_held") >= run)
    stop = runs.groupBy("_key", "_more").agg((F.min("_first") + (run - 1)).alias("_stop"))
    return x.join(stop, ["_key", "_more"], "left").where("_stop is null or _n < _stop").select(*rows.columns)


def typed_links(found: DataFrame) -> DataFrame:
    """Links with a planning word, typed document or procedure; links into council or gazette systems are left to those."""
    path = F.lower(F.regexp_replace("href", r"[?#].*$", ""))
    kind = F.when(path.endswith(".pdf"), "document").otherwise("procedure")
    mine = by_term(found, PLAN_TERMS).where(~any_term(F.lower("href"), ["sessionnet", "allris", "amtsblatt"]))
    return mine.withColumn("kind", kind)


def guessed_urls(names: DataFrame, slug: str) -> DataFrame:
    """One row per name, kind and pattern with its address."""
    made = [F.struct(F.lit(k).alias("kind"), F.replace(F.lit(p), F.lit("{}"), F.col(slug)).alias("url")) for k, ps in URL_PATTERNS.items() for p in ps]
    return names.withColumn("x", F.explode(F.array(*made))).select(*names.columns, "x.kind", "x.url")


def section_paths(bases: DataFrame, pages: DataFrame) -> DataFrame:
    """Addresses of the fixed section paths below each base that are among `pages` (url)."""
    tried = bases.withColumn("path", F.explode(F.array(*[F.lit(p) for p in SECTION_PATHS]))).withColumn("url", F.concat("base", "path"))
    return tried.join(pages.select("url").distinct(), "url", "left_semi")


def dated(text: Column) -> Column:
    """The first day that a session's name spells: d.m.y, else d-m-y, else y-m-d; null where none is valid."""
    made = lambda p, y, m, d: F.try_to_date(F.nullif(F.concat_ws("-", *[F.regexp_extract(text, p, g) for g in (y, m, d)]), F.lit("--")), "y-M-d")
    return F.coalesce(made(r"([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})", 3, 2, 1), made(r"([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})", 3, 2, 1), made(r"([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", 1, 2, 3))


def sessions(found: DataFrame) -> DataFrame:
    """Links that name a session, with its day."""
    return by_term(found, SESSION_TERMS, "text").withColumn("day", dated(F.col("text")))


def gazette_items(pages: DataFrame, found: DataFrame) -> DataFrame:
    """Of pages (page_id, url, html) with a planning word: their PDF links, or the page itself where it has none."""
    hit = pages.where(any_term(F.lower("html"), GAZETTE_TERMS)).select("page_id", "url")
    pdfs = found.where(F.lower("href").endswith(".pdf")).join(hit.select("page_id"), "page_id", "left_semi").select("page_id", F.col("href").alias("item"), F.lit("document").alias("kind"))
    own = hit.join(pdfs.select("page_id").distinct(), "page_id", "left_anti").select("page_id", F.col("url").alias("item"), F.lit("issue").alias("kind"))
    return pdfs.unionByName(own)


def heading_of(html: Column | str, tag: str) -> Column:
    """The text of a page's first element of a kind, references decoded; null if there is none or it is empty."""
    return F.nullif(F.trim(decode_references(markup.without_tags(markup.inside_first(html, tag), ""))), F.lit(""))


def heading(html: Column | str) -> Column:
    """A page's first heading, else its title."""
    return F.coalesce(heading_of(html, "h1"), heading_of(html, "title"))
