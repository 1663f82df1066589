"""Recorded answers in place of a network: which of them a request accepts, what is retried, and what is read page by page.

A table of answers (url, way, status, error, body) holds what came back: `way` is verified, unverified (the
certificate is not looked at) or plain (http); a null status comes with an error, `ssl` or another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import authority
from ..operators.running import running

# Words of which a council system's page holds one; the most features of a layer.
COUNCIL_MARKERS = ["sitzung", "gremium", "tagesordnung", "beschluss", "sessionnet", "ratsinformationssystem", "ris", "vorlage", "antrag"]
MOST_FEATURES = 1000
# Seconds between two requests to a host, and to those that ask for more.
DELAY, DELAYS = 1.0, {"geobasis-bb.de": 10.0, "www.geobasis-bb.de": 10.0}


def is_council_page(body: Column | str) -> Column:
    low, out = F.lower(body), F.lit(False)
    for m in COUNCIL_MARKERS:
        out = out | low.contains(m)
    return F.coalesce(out, F.lit(False))


def _of(answers: DataFrame, way: str) -> DataFrame:
    return answers.where(F.col("way") == way).select("url", F.struct("status", "error", "body").alias(way))


def fetched(requests: DataFrame, answers: DataFrame, hosts: list[str]) -> DataFrame:
    """Requests (url) with the answer that counts: url, way, status, body, all but url null without one.

    The verified answer, whatever its status; after a certificate error the unverified one, for listed hosts only.
    """
    x = requests.select("url").distinct().join(_of(answers, "verified"), "url", "left").join(_of(answers, "unverified"), "url", "left")
    host = F.lower(F.regexp_replace(authority("url"), ":.*$", ""))
    plain = F.col("verified.status").isNotNull()
    second = (F.col("verified.error") == "ssl") & host.isin(hosts) & F.col("unverified.status").isNotNull()
    pick = lambda c: F.when(plain, F.col(f"verified.{c}")).when(second, F.col(f"unverified.{c}"))
    return x.select("url", F.when(plain, "verified").when(second, "unverified").alias("way"), pick("status").alias("status"), pick("body").alias("body"))


def council_fetched(requests: DataFrame, answers: DataFrame, hosts: list[str], downgrade: bool = True) -> DataFrame:
    """As `fetched`, for council systems: an https address counts only with status 200; after a certificate error the
    plain answer does, where `downgrade` is allowed, if it has status 200 and looks like a council page."""
    secure = F.lower(F.substring_index("url", ":", 1)) == "https"
    others = fetched(requests.where(~secure), answers, hosts)
    x = requests.where(secure).select("url").distinct().withColumn("http", F.regexp_replace("url", "(?i)^https:", "http:"))
    x = x.join(_of(answers, "verified"), "url", "left").join(_of(answers, "plain").withColumnRenamed("url", "http"), "http", "left")
    good = F.coalesce(F.col("verified.status") == 200, F.lit(False))
    down = F.lit(downgrade) & (F.col("verified.error") == "ssl") & (F.col("plain.status") == 200) & is_council_page("plain.body")
    pick = lambda c: F.when(good, F.col(f"verified.{c}")).when(down, F.col(f"plain.{c}"))
    return x.select("url", F.when(good, "verified").when(down, "plain").alias("way"), pick("status").alias("status"), pick("body").alias("body")).unionByName(others)


def downloaded(attempts: DataFrame, retries: int = 3) -> DataFrame:
    """What repeated attempts (url, attempt from 1, status, body) give: url, body, attempts, waited.

    The first 200 within `retries` counts; a 404 before it ends the matter; any other status or error is tried again
    after 1, 2, 4.. seconds. `waited` sums those.
    """
    tried = attempts.where(F.col("attempt") <= retries)
    done = F.when(F.col("status").isin(200, 404), F.struct("attempt", "status", "body"))
    per = tried.groupBy("url").agg(F.min(done).alias("last"), F.max("attempt").alias("most"))
    failed = F.coalesce(F.col("last.attempt") - 1, F.least("most", F.lit(retries - 1)))
    return per.select("url", F.when(F.col("last.status") == 200, F.col("last.body")).alias("body"), F.coalesce("last.attempt", "most").alias("attempts"), (F.pow(F.lit(2), failed) - 1).cast("long").alias("waited"))


def cached(requests: DataFrame, cache: DataFrame, attempts: DataFrame, now: Column, most_seconds: int | None = None, retries: int = 3) -> DataFrame:
    """Requests (url) through a cache (url, cached_at, etag, last_modified, body): url, body, hit.

    A fresh entry is taken as it is. Else the entry's tags are sent along (`conditional`); an answer 304 gives the
    entry's body, any other counts as in `downloaded`.
    """
    kept = cache.select("url", F.struct("cached_at", F.col("body").alias("text")).alias("kept"))
    x = requests.select("url").distinct().join(kept, "url", "left")
    fresh = F.col("kept").isNotNull() if most_seconds is None else F.coalesce(F.unix_timestamp(now) - F.unix_timestamp("kept.cached_at") <= most_seconds, F.lit(False))
    x = x.withColumn("hit", fresh)
    again = attempts.join(x.where("not hit").select("url", F.col("kept.text").alias("old")), "url")
    unchanged = (F.col("status") == 304) & F.col("old").isNotNull()
    again = again.select("url", "attempt", F.when(unchanged, 200).otherwise(F.col("status")).alias("status"), F.when(unchanged, F.col("old")).otherwise(F.col("body")).alias("body"))
    got = downloaded(again, retries).select("url", F.col("body").alias("new"))
    return x.join(got, "url", "left").select("url", F.when(F.col("hit"), F.col("kept.text")).otherwise(F.col("new")).alias("body"), "hit")


def conditional(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests (url) with the headers that ask for changes only: a map, empty without a cached answer."""
    tags = cache.select("url", F.map_filter(F.create_map(F.lit("If-None-Match"), "etag", F.lit("If-Modified-Since"), "last_modified"), lambda k, v: v.isNotNull()).alias("headers"))
    none = F.create_map().cast("map<string,string>")
    return requests.select("url").join(tags, "url", "left").select("url", F.coalesce("headers", none).alias("headers"))


def probed(requests: DataFrame, heads: DataFrame) -> DataFrame:
    """Requests (url, allowed) with the length that a head answer (url, status, length) tells; null if barred or not 200."""
    good = heads.where("status = 200").select("url", F.col("length").cast("long").alias("length"))
    x = requests.join(good, "url", "left")
    return x.withColumn("length", F.when(F.col("allowed"), F.col("length")))


def layers(capabilities: DataFrame) -> DataFrame:
    """url, layer of map services' capabilities (url, body), in order of appearance (pos from 0)."""
    names = F.xpath("body", F.lit("//*[local-name()='FeatureType']/*[local-name()='Name']/text()"))
    return capabilities.select("url", F.posexplode(names).alias("pos", "layer"))


def paged(batches: DataFrame, most: int = MOST_FEATURES) -> DataFrame:
    """Features of layers read page by page: layer, place (from 0), feature, from answers (layer, start, features).

    Each page starts where the one before ended, the first at 0; reading ends at a missing or empty page, or with `most`.
    """
    w = W.partitionBy("layer").orderBy("start")
    n = F.size("features")
    x = batches.where(n >= 0).withColumn("end", F.sum(n).over(w)).withColumn("whole", F.min((F.col("start") == F.col("end") - n).cast("int") * (n > 0).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    # sums and minima run over a layer's pages, at most `most` of which are read
    rows = x.where("whole = 1").select("layer", "start", F.posexplode("features").alias("at", "feature"))
    return rows.select("layer", (F.col("start") + F.col("at")).alias("place"), "feature").where(F.col("place") < most)


def paced(requests: DataFrame, order: str = "url", lanes: int = 1) -> DataFrame:
    """Requests (url) with their host and the seconds after which each may start: `lanes` at once within a host, one after
    another in each lane. A host with most requests is numbered in ranges, not in one task."""
    x = requests.withColumn("host", F.coalesce(authority("url"), F.lit("")))
    delay = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in DELAYS.items() for v in kv]), F.col("host")), F.lit(DELAY))
    x = running(x, ["host"], [order], {"_place": F.lit(1)})
    return x.withColumn("starts", F.floor((F.col("_place") - 1) / lanes) * delay).drop("_place")
