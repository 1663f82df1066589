"""Links of procedures to projects: settled in rounds, one by one, and as a stream."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bescheid.operators import containment, entities, founders
from bescheid.streaming import linking

SCHEMA = "municipality_key string, seen date, doc_id long, plan_token string, parcel_token string, developer_token string, title_signature string, title string, location string, company string, procedure_type string"


def procedures(n, seed, days=28):
    """Tokens that contain one another, empty and null ones, few and many developers."""
    r, out = random.Random(seed), []
    for i in range(n):
        dev = r.choice([None, None, "nord", "süd gmbh", ""] + [f"d{r.randrange(120)}"] * (4 if seed % 2 else 1))
        out.append((
            r.choice([None, "m1", "m1", "m1", "m2"]), r.choice([None] + [datetime.date(2024, 1, 1 + r.randrange(days))] * 9), i, r.choice([None, None, "1", "12", "5", "a", "süd", "", "Sondergebiet Energie Süd"]),
            r.choice([None, None, "flur=3", "flur=30", "g=x;flur=3", "g=x", ""]), dev, r.choice([None, "", "w x"]), r.choice([None, "", "Antrag 12", "Plan a", "xx süd", f"t{r.randrange(40)}"]),
            r.choice([None, "", "flur=3 ort", "g=x und mehr", "z"]), r.choice([None, "", "C", "C", "C"]) if dev else None, r.choice([None, "PERMIT_36_EINVERNEHMEN", "X"]),
        ))
    return out


def one_by_one(rows):
    """The links by the fold, municipality by municipality."""
    out, by = [], {}
    for x in rows:
        by.setdefault(x[0], []).append(x)
    for key, own in by.items():
        own.sort(key=lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, x[2] or 0))
        out += [(key, *link) for link in entities.fold([(x[2], *x[3:7], x[7], x[8], x[9], x[10]) for x in own])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("n", "seed"), [(30, 1), (300, 2), (900, 3)])
def test_rounds_equal_the_fold(spark, n, seed):
    rows = procedures(n, seed)
    random.Random(seed).shuffle(rows)
    got = founders.linked(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["municipality_key", "procedure_id", "project_id", "link_confidence", "link_reason"]
    want = one_by_one(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want and len({x[4] for x in want}) >= 4


def test_many_developers(spark):
    """More than fifty founders with a developer: later developers are not looked at, whoever is still open before them."""
    rows = [("m", None, i, str(100 + i) if i % 3 else None, None, f"d{i % 70}", "w", None, None, "C", None) for i in range(400)]
    got = sorted(map(tuple, founders.linked(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == one_by_one(rows) and {x[4] for x in got} == {"NEW_PROJECT", "DEV+TITLE_MATCH"}


def test_chain(spark):
    """Each plan's name holds the next one's token, so every decision waits for the one before."""
    rows = [("m", None, i, "x" * (12 - i), None, None, None, None, None, None, None) for i in range(12)]
    rows += [("m", None, 50 + i, "x" * (i + 1), f"p{i}", None, None, None, f"p{i + 1}", None, None) for i in range(12)]
    got = sorted(map(tuple, founders.linked(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == one_by_one(rows)


def test_odd_rows(spark):
    assert founders.linked(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, None, None, "7", None, None, None, None, None, None, None)] * 3 + [("m", None, 2**62, None, None, None, None, None, None, None, "PERMIT_36_EINVERNEHMEN")] * 2
    got = sorted(tuple(x)[1:] for x in founders.linked(spark.createDataFrame(rows, SCHEMA)).collect() if x.municipality_key)
    assert got == [(2**62, f"project-{2**62}", 0.85, "PERMIT_36_NEW")] * 2
    none = sorted(tuple(x)[2:] for x in founders.linked(spark.createDataFrame(rows, SCHEMA)).collect() if not x.municipality_key)
    assert none == [("project-None", 0.9, "PLAN_TOKEN_MATCH")] * 2 + [("project-None", 1.0, "NEW_PROJECT")]


def test_hot_municipality_is_spread(spark):
    """Most rows in one municipality: no task of the last join gets more than twice the mean."""
    n = 40_000
    df = spark.range(n).selectExpr("if(id % 10 = 0, 'other', 'hot') as municipality_key", "cast(null as date) as seen", "id as doc_id", "cast(id % 4000 as string) as plan_token", "cast(null as string) as parcel_token", "cast(null as string) as developer_token", "'w' as title_signature", "'t' as title", "cast(null as string) as location", "cast(null as string) as company", "'X' as procedure_type")
    rows = founders.slim(df)
    sizes = [r["count"] for r in rows.repartition(8, "unit").selectExpr("spark_partition_id() as p").groupBy("p").count().collect()]
    assert max(sizes) <= 2 * n / 8
    links = founders.linked(df)
    assert links.count() == n and links.select("project_id").distinct().count() == links.where("link_reason = 'NEW_PROJECT'").count()


def test_containment(spark):
    r = random.Random(4)
    word = lambda n: "".join(r.choice("ab=;ü") for _ in range(n))
    tokens = [(k, word(r.randint(0, 40))) for k in "xy" for _ in range(120)] + [("x", None)]
    texts = [(k, word(r.randint(0, 60))) for k in "xy" for _ in range(60)] + [(k, word(3) + t + word(2)) for k, t in tokens if t] + [("y", None)]
    got = containment.contained(spark.createDataFrame(tokens, "k string, token string"), spark.createDataFrame(texts, "k string, text string"), ["k"])
    want = {(k, t, v) for k, t in tokens for j, v in texts if k == j and t and v and t in v}
    found = [tuple(x) for x in got.collect()]
    assert set(found) == want and len(found) == len(want)


def test_stream_with_restarts_equals_batch(spark, tmp_path):
    """Four files, each read by a new query over the same checkpoint."""
    rows = procedures(400, 7)
    got = linking.run(spark.createDataFrame(rows, SCHEMA), f"file://{tmp_path}", 4)
    assert sorted(map(tuple, got.collect()), key=str) == one_by_one(rows)
    # every query went on from the state of the one before, and a further one finds nothing to do
    again = linking.start(spark.readStream.schema(linking.ARRIVAL).parquet(f"file://{tmp_path}/arrivals"), f"file://{tmp_path}/links", f"file://{tmp_path}/checkpoint")
    again.awaitTermination()
    assert again.lastProgress is None or again.lastProgress["numInputRows"] == 0
    assert spark.read.schema(linking.LINK_SCHEMA).option("recursiveFileLookup", "true").parquet(f"file://{tmp_path}/links").count() == 400


def test_stream_computes_procedures_once(spark, tmp_path):
    """Bounds and parts are taken from what was written, also where filters do not pass what gives the procedures."""
    seen = spark.sparkContext.accumulator(0)

    def read(x):
        seen.add(1)
        return x

    rows = [("m", datetime.date(2024, 1, 1 + i % 20), i, f"{i % 7}", None, None, "w", "t", None, None, "X") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("plan_token", F.udf(read).asNondeterministic()("plan_token"))
    assert linking.run(df, f"file://{tmp_path}", 3).count() == 60 and seen.value == 60


def rolled(rows):
    """The best values of each project in plain Python, from rows (project, seen, doc_id, ..)."""
    by, out = {}, []
    for x in rows:
        by.setdefault(x[0], []).append(x)
    for key, own in by.items():
        own.sort(key=lambda x: (x[1] or datetime.date(1900, 1, 1), x[2]))
        plans, parcels, titles, places, companies, bases = ([x[i] for x in own if x[i]] for i in (3, 4, 5, 6, 7, 8))
        planned = [t for t in titles if "plan" in t.lower()]
        of = lambda values, best: best(values) if values else None
        longest = lambda values: of(values, lambda v: max(v, key=len))
        days, mw, types = [x[1] for x in own if x[1]], [x[10] for x in own if x[10] is not None], {x[9] for x in own}
        stage = next((s for t, s in (("PERMIT_BAUGENEHMIGUNG", "BAUGENEHMIGUNG"), ("PERMIT_36_EINVERNEHMEN", "PERMIT_36")) if t in types), "DISCOVERED")
        out.append((
            key, f"B-Plan {plans[0]}" if plans else longest(planned or titles), parcels[0] if parcels else longest(places), of(companies, lambda v: Counter(v).most_common(1)[0][0]),
            next((b for b in ("§35", "§34", "§36") if b in bases), bases[0] if bases else None), of(mw, max), of(days, min), of(days, max), stage, any(x[11] for x in own), max([0.0, *[x[12] for x in own if x[12]]]), len(own),
        ))
    return sorted(out, key=str)


ROLLED = "project_id string, seen date, doc_id long, plan_token string, parcel_token string, title string, location string, company string, legal_basis string, procedure_type string, capacity_mw double, review_recommended boolean, confidence_score double, capacity_mwh double, area_hectares double"
BEST = "project_id canonical_project_name site_location_best developer_company_best legal_basis_best capacity_mw_best first_seen_date last_seen_date maturity_stage needs_review max_confidence procedures".split()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rollup_equals_plain_python(spark, seed):
    """Values of all companies meet again, those without a project keep theirs, and each row is computed once."""
    r, rows = random.Random(seed), []
    for i in range(500):
        few = i % 60
        rows.append((
            r.choice([None, *(f"p{k}" for k in range(40))]), r.choice([None, *(datetime.date(2024, 1, d) for d in range(1, 20))]), i, r.choice([None, "", "", "12"] if few < 9 else [None, ""]), r.choice([None, "", "flur=3", "g=x"] if few < 9 else [None, ""]),
            r.choice([None, "", "Antrag", "Lage", "Plan a", "B-Plan", "Halle 7"]), r.choice([None, "", "Seedorf", "Altfeld", "am Markt"]), r.choice([None, "", "A GmbH", "B AG", "C KG", "D UG"]), r.choice([None, "", "§9", "§8", *["§34", "§36", "§35"][: seed - 1]]),
            r.choice([None, "X", "Y", "PERMIT_36_EINVERNEHMEN"] + ["PERMIT_BAUGENEHMIGUNG"] * (few < 5)), r.choice([None, 1.5, float(i)]), r.choice([None, False, False, i % 7 == 0]), r.choice([None, 0.25, 0.5, i / 1000]), None, None,
        ))
    rows += [("none", None, 500 + i, None, None, "", None, (None, "")[i % 2], None, None, None, None, None, None, None) for i in range(4)]
    seen = spark.sparkContext.accumulator(0)

    def read(x):
        seen.add(1)
        return x

    df = spark.createDataFrame(rows, ROLLED).repartition(3).withColumn("company", F.udf(read).asNondeterministic()("company"))
    got = sorted(map(tuple, entities.rollup(df).select(*BEST).collect()), key=str)
    assert got == rolled(rows) and len({x[3] for x in got}) == 5 and any(x[0] is None and x[3] for x in got)
    assert seen.value == len(rows)
    assert entities.rollup(spark.createDataFrame([], ROLLED)).count() == 0


def test_project_rollup_keeps_the_developers(spark, sf):
    from bescheid.plans import registry

    got, want = (registry.QUERIES[n](spark, sf).select("project_id", "developer_company_best").collect() for n in ("project_rollup", "project_developers"))
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and any(x[1] for x in got)
