"""Rules on single texts, against values worked out by hand, and columns against plain Python."""

import datetime
import re
import time

import pytest
from pyspark.sql import functions as F

from bescheid.functions import matcher, text
from bescheid.operators import classify, entities, extract, links, merge, scoring
from bescheid.plans import fixture


def one(spark, value, *cols):
    return spark.createDataFrame([(value,)], "x string").select(*cols).first()


def announce(spark, title, body, day=None):
    rows = [(1, title, body, day, "u", "RIS")]
    df = spark.createDataFrame(rows, "doc_id long, title string, text string, date_hint date, url string, discovery_source string")
    return classify.classify(df).first()


def test_normalize(spark):
    assert one(spark, "  Öffentliche \n Straße Ä ", text.normalize("x"))[0] == "oeffentliche strasse ae"


def test_plan_set_up(spark):
    r = announce(spark, "Batteriespeicher Weststadt", "Die Gemeinde fasst den Aufstellungs-\nbeschluss: Beschluss zur\nAufstellung des Bebauungsplans.", datetime.date(2024, 1, 2))
    assert r.is_relevant and r.procedure_type == "BPLAN_AUFSTELLUNG" and r.confidence_score == pytest.approx(0.55)


def test_preliminary_permit(spark):
    r = announce(spark, "Stromspeicher", "Bauvorbescheides im Außenbereich, § 35 BauGB, am Umspannwerk", datetime.date(2024, 1, 2))
    assert r.is_relevant and r.procedure_type == "PERMIT_BAUVORBESCHEID" and r.legal_basis == "§35"


def test_solar_and_storage(spark):
    r = announce(spark, "Solarpark mit Energiespeicher", "Öffentliche Auslegung, 10 MW, 20 MWh, Netzanschluss", datetime.date(2024, 1, 2))
    assert r.project_components == "PV+BESS" and r.procedure_type == "BPLAN_AUSLEGUNG_3_2"


def test_negative_words(spark):
    r = announce(spark, "Regenrückhaltebecken", "Beschluss zur Aufstellung; kein Speicher für Wasser", datetime.date(2024, 1, 2))
    assert not r.is_relevant and r.confidence_score == 0 and r.procedure_type is None and r.evidence_snippets == []


def test_ambiguous_store(spark):
    r = announce(spark, "Speicheranlage", "Bauantrag, Trafostation, Wechselrichter, Netzanschluss", None)
    assert r.is_relevant and r.ambiguity_flag


def test_consent(spark):
    r = announce(spark, "Energiespeichers", "gemeindliches Einvernehmen nach § 36 BauGB", datetime.date(2024, 1, 2))
    assert r.procedure_type == "PERMIT_36_EINVERNEHMEN" and r.legal_basis == "§36"


def test_container(spark):
    f = lambda t: classify.is_container(F.col("x"), F.lit("http://a"))
    assert one(spark, "amtsblatt nr. 4", f(0))[0] and not one(spark, "amtsblatt nr. 4 bebauungsplan", f(0))[0]


def test_validity(spark):
    v = lambda kind: classify.validity(F.col("x"), F.lit(""), F.lit("AMTSBLATT"), F.lit(kind).cast("string"), F.lit(""))
    assert tuple(one(spark, "amtsblatt ausgabe 3", v(None))[0]) == (False, "SKIP_CONTAINER")
    assert tuple(one(spark, "plan", v("BPLAN_OTHER"))[0]) == (True, None)


def test_tokens(spark):
    assert one(spark, "Bebauungsplan Nr. 42 Nord", extract.plan_token(F.col("x")))[0] == "42"
    assert one(spark, "Gemarkung: Seedorf; Flur: 3; Flurstück: 12/4", extract.parcel_token(F.col("x")))[0] == "gemarkung=seedorf;flur=3;flurstueck=12"
    assert one(spark, "Nordlicht Energie  GmbH ", extract.company_name(F.col("x")))[0] == "nordlicht energie"
    assert "auslegung" not in one(spark, "Öffentliche Auslegung Solarpark über Mühle", extract.title_signature(F.col("x")))[0]


def test_stage(spark):
    for kinds, want in ((["BPLAN_SATZUNG", "PERMIT_BAUGENEHMIGUNG"], "BAUGENEHMIGUNG"), (["BPLAN_FRUEHZEITIG_3_1"], "BPLAN_AUFSTELLUNG"), ([], "DISCOVERED"), (["UNKNOWN"], "DISCOVERED")):
        assert spark.range(1).select(entities.stage(F.lit(kinds) if kinds else F.array().cast("array<string>"))).first()[0] == want


def test_hash_ignores_case():
    assert text.title_key("Bauplan NORD") == text.title_key("bauplan nord") and text.title_key("Ä!") == "a"


def test_quantities(spark):
    assert one(spark, "950 kW, 12,5 MW und 50 MWh", extract.capacity(F.col("x")))[0] == 50
    assert one(spark, "2 km² und 3,5 ha", extract.area(F.col("x")))[0] == 3.5 and one(spark, "2 km²", extract.area(F.col("x"), fix_km2=True))[0] == 200


def test_decision_date():
    assert extract.decided("Am 01.02.2023 Sitzung" + " x" * 200 + " Beschlossen am 3.4.2024") == datetime.date(2024, 4, 3)
    assert extract.decided("31.02.2024 und 5/6/2021") == datetime.date(2021, 6, 5) and extract.decided(None) is None and extract.decided("1.1.1999") is None


def test_companies(spark):
    s = "Die Nordlicht Energie GmbH plant.\nAuch Müller & Söhne KG hilft; AGX nicht"
    want = re.findall(extract.COMPANY, s)
    assert one(spark, s, extract.companies(F.col("x")))[0] == want and want


def test_matcher_equals_contains(spark, sf):
    df = fixture.announcements(spark, sf).select("doc_id", F.lower("text").alias("t"))
    for doc, t, h in df.withColumn("h", matcher.hits("t")).collect():
        assert h == [i for i, x in enumerate(matcher.TERMS) if x in t], doc
    assert spark.createDataFrame([(None,)], "x string").select(matcher.hits("x")).first()[0] is None


def test_fixture_covers_rules(spark, sf):
    c = classify.classify(fixture.announcements(spark, sf)).select("procedure_type", "legal_basis", "project_components", "ambiguity_flag", "review_recommended").collect()
    assert {"PERMIT_BAUVORBESCHEID", "PERMIT_BAUGENEHMIGUNG", "PERMIT_OTHER", "BPLAN_AUFSTELLUNG"} <= {r[0] for r in c} and {r[3] for r in c} == {True, False} == {r[4] for r in c}


def test_fold_order(spark):
    rows = [(1, "7", None, None, "a", "B-Plan 7", None, None, "BPLAN_OTHER"), (2, "7", None, None, "a", "t", None, None, "BPLAN_OTHER"), (3, None, "flur=3", None, "", "", None, None, "PERMIT_36_EINVERNEHMEN"), (4, None, "flur=3", None, "", "", None, None, None), (5, None, None, "x", "w", "t", None, "X AG", None), (6, None, None, "x", "w", "u", None, "X", None), (7, None, None, None, "", "", None, None, None)]
    got = list(entities.fold(rows))
    assert [g[1] for g in got] == ["project-1", "project-1", "project-3", "project-3", "project-5", "project-5", "project-7"]
    assert [g[3] for g in got] == ["NEW_PROJECT", "PLAN_TOKEN_MATCH", "PERMIT_36_NEW", "PARCEL_MATCH", "NEW_PROJECT", "DEV+TITLE_MATCH", "NEW_PROJECT"]


def test_merges_are_idempotent(spark):
    base = spark.createDataFrame([(1, "a", 0)], "k int, v string, n int")
    delta = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (2, "d", 1)], "k int, v string, n int")
    once = merge.last_wins(base, delta, ["k"], "n")
    twice = merge.last_wins(once, delta, ["k"], "n")
    assert sorted(once.collect()) == sorted(twice.collect()) and {(r.k, r.v) for r in once.collect()} == {(1, "c"), (2, "d")}
    assert {(r.k, r.v) for r in merge.first_wins(base, delta, ["k"], "n").collect()} == {(1, "a"), (2, "d")}


def test_early_stop(spark):
    rows = [(1, i, d) for i, d in enumerate(["2023-05-01", "2022-01-01", "2022-01-02", None, "2022-02-01", "2022-02-02", "2022-02-03", "2024-01-01"])]
    df = spark.createDataFrame(rows, "k int, i int, d string").withColumn("d", F.col("d").cast("date"))
    assert [r.i for r in links.until_old(df, "k", "i", "d", "2023-01-01").orderBy("i").collect()] == [0, 1, 2, 3, 4, 5]


def test_threshold_modes(spark):
    df = spark.createDataFrame([("RIS", 0.25), ("ris", 0.35), ("AMTSBLATT", 0.4), (None, 0.55)], "s string, x double")
    assert [r[0] for r in df.select(scoring.should_extract(F.col("x"), F.col("s"))).collect()] == [False, True, False, False]
    assert [r[0] for r in df.select(scoring.should_extract(F.col("x"), F.col("s"), "deep")).collect()] == [True, True, True, True]


def test_link_keys_equal_fold_without_overlaps(spark):
    rows = [("m", i, None, str(10 + i % 3), None, None, "w", f"B-Plan {10 + i % 3}", None, None, "BPLAN_OTHER") for i in range(9)]
    df = spark.createDataFrame(rows, "municipality_key string, doc_id long, seen date, plan_token string, parcel_token string, developer_token string, title_signature string, title string, location string, company string, procedure_type string")
    fold = {(r.procedure_id, r.project_id) for r in entities.link(df).collect()}
    assert fold == {(r.procedure_id, r.project_id) for r in entities.link_by_key(df).collect()}


def test_companies_equal_the_pattern(spark, sf):
    df = fixture.announcements(spark, sf).select("text").unionByName(spark.createDataFrame([("ÄHRE AG. BLAG!! Ümit UGX, Kern KG",), ("",), ("GmbH",)], "text string"))
    for t, got in df.select("text", extract.companies(F.col("text"))).collect():
        assert got == re.findall(extract.COMPANY, t)


def test_title_key_of_every_character(spark):
    """The built-in expression equals `title_key` for each code point, alone between letters and beside a mark."""
    points = [x for x in range(1, 0x110000) if not 0xD800 <= x < 0xE000]
    titles = ["A" + "b".join(map(chr, points[k : k + 64])) + "Z" for k in range(0, len(points), 64)]
    titles += [f"x{chr(x)}\u0323\u0307y" for x in range(0x80, 0x250)] + ["", "  ", None, "ß ẞ Äö ﬁ ½ 𝐁㎏ Ⅷ\u00a0\u2003Z"]
    rows = spark.createDataFrame(list(enumerate(titles)), "n int, title string").select("n", text.normalize_title("title").alias("key")).collect()
    assert {r.n: r.key for r in rows} == {n: text.title_key(t) for n, t in enumerate(titles)}
    plan = spark.range(1).select(text.normalize_title(F.col("id").cast("string")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_companies_beside_odd_stretches(spark):
    """Forms at the edges of what a name may hold, letters outside it, and stretches without a form."""
    import random

    rng, parts = random.Random(3), ["A", "a", "Ä", "é", "É", "_", " ", "\n", "&", ".", ":", "AG", "KG", "GmbH", "GmbH & Co. KG", "UG", "7", "$1", "\\", "\u0001", "x" * 5, "Nord", "日"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for t, got in df.select("x", extract.companies(F.col("x"))).collect():
        assert got == re.findall(extract.COMPANY, t), t


def test_companies_of_a_long_stretch_without_a_form(spark):
    """Each of 120,000 capitals would walk to the colon: half a minute and more where that is tried."""
    at = time.perf_counter()
    row = spark.range(1).select(F.concat(F.repeat(F.lit("Aa "), F.col("id").cast("int") + 120_000), F.lit(": Nord AG")).alias("x")).select(extract.companies(F.col("x")).alias("f")).first()
    assert row.f == ["Nord AG"] and time.perf_counter() - at < 10


def test_developers_look_at_each_company_once(spark):
    rows = [("p", 1, "A"), ("p", 2, "B"), ("p", 3, "B"), ("p", 4, None), ("q", 5, None), ("q", 6, ""), ("r", 7, "C"), ("r", 8, "D")]
    seen = spark.sparkContext.accumulator(0)

    def read(x):
        seen.add(1)
        return x

    df = spark.createDataFrame([(*r, None) for r in rows], "project_id string, doc_id long, c string, seen date").withColumn("company", F.udf(read)("c"))
    best = {r.project_id: r.developer_company_best for r in entities.developers(df).collect()}
    assert best == {"p": "B", "q": None, "r": "C"} and seen.value == len(rows)
