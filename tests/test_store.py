"""Sources and sinks."""

import pandas as pd
from pyspark.sql import functions as F

from bescheid.functions import text
from bescheid.sources import store
from bescheid.streaming import jobs


def test_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    (tmp_path / "b.bin").write_bytes(b"x" * 100)
    rows = store.files(spark, f"file://{tmp_path}", 50).collect()
    assert [(r.length, r.sha256) for r in rows] == [(3, "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string").withColumn("t", F.lit("2024-01-31 10:00:00").cast("timestamp"))
    store.write_parquet(df, f"{tmp_path}/p", "k")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 1
    out = store.write_workbook({"all": df, "none": df.limit(0)}, f"{tmp_path}/book.xlsx")
    if out.endswith(".csv"):
        got = spark.read.option("header", True).csv(f"{out}/all").first()
        assert (got.k, got.v, got.t[:10]) == ("1", "a", "2024-01-31")
    assert dict(store.without_zone(df).dtypes)["t"] == "timestamp_ntz"


def test_cache_and_robots(spark):
    pages = spark.createDataFrame([("https://a.de/x",), ("https://a.de/y?z",), ("https://b.de/x",)], "url string")
    cache = spark.createDataFrame([("https://a.de/x",)], "url string").select(store.cache_key("url").alias("key"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("cached_at"))
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    assert store.misses(pages, cache, now).count() == 2 and store.misses(pages, cache, now, days=7).count() == 3
    rules = spark.createDataFrame([("a.de", "/y"), ("a.de", "/q")], "host string, prefix string")
    assert {r.url: r.allowed for r in store.allowed(pages, rules).collect()} == {"https://a.de/x": True, "https://a.de/y?z": False, "https://b.de/x": True}


def test_features(spark):
    body = '{"features":[{"id":"1","properties":{"name":"","bezeichnung":"B","planart":"X","gemeinde":null}},{"id":"2","properties":{}}]}'
    rows = store.features(spark.createDataFrame([(body,), ("no json",), (None,)], "body string")).collect()
    assert [tuple(r) for r in rows] == [("1", "B", "X", ""), ("2", "", "", "")]


def test_progressive(spark):
    df = spark.createDataFrame([(["Bebauungsplan", " ", "drei"],), (["eins", "", "drei"],), (None,)], "p array<string>")
    assert [(r.triggered, r.text) for r in store.progressive(df, "p", 2).collect()][:2] == [(True, "Bebauungsplan\n\ndrei"), (False, "eins")]


def test_page_text(spark):
    df = spark.createDataFrame([("<p>a<br>b</p><script>x</script><!-- c -->\n <i>d</i>",)], "html string")
    assert df.select(store.page_text("html")).first()[0] == "a\nb\nd"


def test_slugs(spark):
    df = spark.createDataFrame([("Frankfurt (Oder)",), ("Bad/Saarow",), ("St. Jürgen",), ("",), ("(x)",)], "n string")
    assert [tuple(r) for r in df.select(*[text.slug("n", v) for v in "ABCD"]).collect()] == [
        ("frankfurt", "frankfurt", "frankfurt", "frankfurt"), ("bad-saarow", "bad-saarow", "bad-saarow", "badsaarow"), ("st.-juergen", "st-juergen", "st-juergen", "st.juergen"), ("", "", "", ""), ("x", "x", "", ""),
    ]


def test_stream_restarts_repeat_nothing(spark, tmp_path):
    base = f"file://{tmp_path}"
    job = lambda i, t: spark.createDataFrame([("RIS", "m", i, "fast", t, "u", "RIS")], jobs.JOB)
    jobs.enqueue(job("1", "Energiespeicher"), f"{base}/q")
    stream = lambda: jobs.route(spark.readStream.schema(jobs.JOB).json(f"{base}/q"))[1]
    jobs.intake(stream(), f"{base}/t", f"{base}/c").awaitTermination()
    jobs.enqueue(job("2", "Sportplatz"), f"{base}/q")
    jobs.enqueue(job("1", "Sportplatz"), f"{base}/q")
    jobs.intake(stream(), f"{base}/t", f"{base}/c").awaitTermination()
    jobs.intake(stream(), f"{base}/t", f"{base}/c").awaitTermination()
    assert {(r.candidate_id, r.status) for r in jobs.current(spark, f"{base}/t").collect()} == {("1", "SKIPPED"), ("2", "SKIPPED")}
    assert spark.read.parquet(f"{base}/t").count() == 3
    d, e = jobs.route(spark.createDataFrame([("RIS", "m", None, "fast", "", "", ""), ("RIS", "m", "1", "fast", "", "", "")], jobs.JOB))
    assert d.count() == e.count() == 1


def test_counters(spark):
    df, seen = jobs.counted(spark.createDataFrame([("RIS", "m", None, "fast", "", "", ""), ("RIS", "m", "1", "fast", "", "", "")], jobs.JOB))
    df.write.format("noop").mode("overwrite").save()
    assert (seen.get["jobs"], seen.get["extractions"], seen.get["sources"]) == (2, 1, ["RIS"])
    assert jobs.by_host(spark.createDataFrame([("https://a.de/x",), ("https://a.de/y",), (None,)], "url string")).count() == 3


def test_exports(spark, sf, tmp_path):
    from bescheid.plans import exports

    out = exports.procedures_workbook(spark, sf, f"{tmp_path}/procedures.xlsx")
    other = exports.projects_workbook(spark, sf, f"{tmp_path}/projects.xlsx")
    exports.coverage_csv(spark, sf, f"{tmp_path}/coverage")
    assert spark.read.option("header", True).csv(f"{tmp_path}/coverage/by_county").count() == 5
    if out.endswith(".csv"):
        assert spark.read.option("header", True).csv(f"{out}/all").count() == 1500 and spark.read.option("header", True).csv(f"{other}/diagnostics").count() > 5


def test_seeds(spark, tmp_path):
    (tmp_path / "seeds.csv").write_text("municipality_key,name,county,state\n12051,Brandenburg,,BB\n12052,Cottbus,SPN,BB\n,Nowhere,,BB\n12052,Dorf,X,BB\n")
    got = sorted(tuple(r) for r in store.seeds(spark, f"file://{tmp_path}/seeds.csv").collect())
    assert got == [("12051", "Brandenburg", None, "BB"), ("12052", "Cottbus", "SPN", "BB")]


def test_console_report(spark, sf):
    from bescheid.plans import console

    text = console.recall(spark, sf)
    assert all(x in text for x in ("SKIPPED CANDIDATES BY SOURCE", "TOP SKIPPED TITLES", "PROCEDURES BY SOURCE", "PROJECTS", "SKIPPED SOURCES"))
    assert len(text.splitlines()) > 40 and max(map(len, text.splitlines())) <= 90


def test_batches_are_bounded_in_bytes(spark):
    """Python gets long texts in batches of about 2 MB, however many rows a table has."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    size = F.pandas_udf(lambda x: pd.Series([int(x.str.len().sum())] * len(x)), "long")
    texts = spark.range(6000).select(F.concat(F.repeat(F.lit("x"), 10_000), F.col("id").cast("string")).alias("x"))
    assert store.dealt(texts).select(size("x").alias("n")).agg(F.max("n")).first()[0] < 2 * store.BATCH_BYTES
