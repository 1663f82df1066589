"""Tables by key: only the delta's buckets are written, replays change nothing, failures leave the old table."""

import pytest
from pyspark.sql import functions as F

from bescheid.operators import merge
from bescheid.sources.keyed import KeyedTable


def files(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def last(base, delta):
    return merge.last_wins(base, delta, ["id"], "at")


def content(spark, table):
    return sorted(map(tuple, table.read(spark).collect()), key=str)


@pytest.fixture
def stored(spark, tmp_path):
    path = tmp_path / "kept"
    table = KeyedTable(f"file://{path}", ("id",), 8)
    rows = [(k, k % 5, f"v{k}") for k in range(200)] + [(None, 1, "none")]
    table.merge(spark.createDataFrame(rows, "id long, at long, `odd.name` string"), last)
    return table, path, rows


def test_only_touched_buckets_change(spark, stored):
    table, path, rows = stored
    before = files(path)
    assert len({p.parent for p in before}) == 8 and content(spark, table) == sorted(rows, key=str)
    delta = spark.createDataFrame([(3, 9, "new"), (3, 8, "older"), (1000, 1, "added")], "id long, at long, `odd.name` string")
    touched = table.merge(delta, last)
    assert 1 <= len(touched) <= 2
    want = sorted([r for r in rows if r[0] != 3] + [(3, 9, "new"), (1000, 1, "added")], key=str)
    after = files(path)
    assert content(spark, table) == want
    same = {p for p in before if int(p.parent.name.split("=")[1]) not in touched}
    assert len({p.parent for p in same}) == 8 - len(touched) and all(after[p] == before[p] for p in same)
    assert not {p for p in before if p not in same} & after.keys()
    # a replay repeats nothing
    assert table.merge(delta, last) == touched and content(spark, table) == want


def test_failed_write_leaves_the_table(spark, stored):
    table, path, rows = stored
    before = files(path)
    delta = spark.createDataFrame([(k, 9, "new") for k in range(50)], "id long, at long, `odd.name` string")

    def broken(base, new):
        return last(base, new).withColumn("at", F.when(F.col("id") == 49, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("at")))

    with pytest.raises(Exception, match="lost"):
        table.merge(delta, broken)
    assert files(path) == before and content(spark, table) == sorted(rows, key=str)
    table.merge(delta, last)
    assert {r[0] for r in content(spark, table) if r[2] == "new"} == set(range(50))


def test_empty_deltas_and_lookup(spark, stored, tmp_path):
    table, path, rows = stored
    before = files(path)
    nothing = spark.createDataFrame([], "id long, at long, `odd.name` string")
    assert table.merge(nothing, last) == [] and files(path) == before
    found = table.lookup(spark.createDataFrame([(7,), (7,), (5000,)], "id long"))
    assert [tuple(r) for r in found.collect()] == [rows[7]]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan
