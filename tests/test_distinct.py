"""Distinct counts by bitmaps and running sums over ranges, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from bescheid.operators import distinct, links, running
from bescheid.plans import registry
from bescheid.sources import answers, store

NAMES = {"all": lambda r: r[2], "big": lambda r: r[2] if r[3] else None}


def test_levels_and_delta(spark):
    """Repeated rows, null groups and ids, negative ids, ids across buckets; a delta merges and may come twice."""
    r = random.Random(1)
    rows = [(r.choice([None, "a", "b"]), r.choice(["x", "y", None]), r.choice([None, -5, 0, 7, 32_768, 2**40]) if r.random() < 0.5 else r.randrange(100_000), r.random() < 0.4) for _ in range(3000)]
    df = spark.createDataFrame(rows + rows[:500], "county string, town string, id long, big boolean")
    counted = {"all": F.col("id"), "big": F.when(F.col("big"), F.col("id"))}
    old, new = (distinct.states(df.where(f"coalesce(id, 0) % 2 {op} 0"), ["county", "town"], counted) for op in ("=", "!="))
    held = distinct.merged(old, new, new)
    got = {(x.level, x.county, x.town): (x["all"], x.big) for x in distinct.counts(held, [[], ["county"], ["county", "town"]], ["all", "big"]).collect()}
    want = {}
    for level in range(3):
        for x in rows:
            if x[2] is not None:
                one = want.setdefault((level, x[0] if level else None, x[1] if level == 2 else None), (set(), set()))
                one[0].add(x[2])
                if x[3]:
                    one[1].add(x[2])
    assert got == {k: tuple(map(len, v)) for k, v in want.items()}
    assert distinct.counts(distinct.states(df.where("false"), ["county"], counted), [["county"]], ["all", "big"]).count() == 0


def test_running_sums_of_a_hot_key(spark):
    r = random.Random(2)
    rows = [("hot" if r.random() < 0.9 else r.choice([None, "k"]), i, r.randrange(5)) for i in range(4000)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i long, v long").repartition(5)
    got = {x.i: (x.n, x.s) for x in running.running(df, ["k"], ["i"], {"n": F.lit(1), "s": F.col("v")}).collect()}
    seen, want = {}, {}
    for k, i, v in sorted(rows, key=lambda x: x[1]):
        n, s = seen.get(k, (0, 0))
        seen[k] = want[i] = (n + 1, s + v)
    assert got == want
    assert running.running(df.where("false"), ["k"], ["i"], {"n": F.lit(1)}).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_stop_of_old_sessions(spark, hot):
    r = random.Random(4)
    rows = [(None if r.random() < 0.1 else "hot" if hot else f"k{r.randrange(40)}", i, r.choice([None, "2022-05-01", "2022-06-01", "2024-01-01"]) if not hot else "2024-01-01" if i < 1500 else "2020-01-01") for i in range(1600)]
    df = spark.createDataFrame(rows, "k string, i int, d string").withColumn("d", F.col("d").cast("date"))
    got = sorted((x.k or "", x.i) for x in links.until_old(df, "k", "i", "d", "2023-01-01").collect())
    want, run, over = [], {}, set()
    for k, i, d in rows:
        run[k] = run.get(k, 0) + 1 if d and d < "2023" else 0
        if run[k] == 3:
            over.add(k)
        if k not in over:
            want.append((k or "", i))
    assert got == sorted(want)


def test_lanes_of_a_host(spark):
    df = spark.createDataFrame([(f"https://h.example/{i:03}",) for i in range(50)] + [("https://o.example/a",), (None,)], "url string")
    one, two = ({x.url: x.starts for x in answers.paced(df, lanes=k).collect()} for k in (1, 2))
    assert [one[f"https://h.example/{i:03}"] for i in (0, 1, 49)] == [0, 1, 49] and [two[f"https://h.example/{i:03}"] for i in (0, 1, 2, 49)] == [0, 0, 1, 24]
    assert one["https://o.example/a"] == 0 and len(one) == 52


def test_members_of_answers(spark):
    xml = "<c xmlns:w='http://www.opengis.net/wfs/2.0'><w:member><x:a><x:name>one &lt; two</x:name><x:name>last</x:name><x:planArt/></x:a></w:member><w:memberless/><w:member><n:gemeindename t='1'>Ort</n:gemeindename></w:member></c>"
    rows = [(xml,), ('{"features":[{"id":"i","properties":{"name":"j"}}]}',), (None,), ("",), ("<a/>",), ("{}",)]
    got = sorted(tuple(x) for x in store.features(spark.createDataFrame(rows, "body string")).fillna("").collect())
    assert got == [("", "", "", "Ort"), ("", "last", "", ""), ("i", "j", "", "")]


def test_export_counts_without_doubling_rows(spark, sf):
    """Two distinct counts in one aggregate hold each row twice; projects that are not listed are not counted at all."""
    plan = registry.QUERIES["projects_export"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "LeftSemi" in plan
