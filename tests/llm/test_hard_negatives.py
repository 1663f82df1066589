"""Hard negatives against brute force in plain Python and DuckDB."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from bescheid.llm import hard_negatives as hn

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, anchor, scale=256, positives=5, negatives=3):
    """(vec_id, label, vector) rows -> sorted rows of the contract."""
    fine = [(i, y, [math.floor(scale * float(x)) for x in v]) for i, y, v in rows if None not in (i, y, v) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, y, v in fine:
        if not anchor(i):
            continue
        others = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for j, z, w in fine if j != i and len(w) == len(v))
        for p, j, _ in [x for x in others if x[2] == y][:positives]:
            hard = [x for x in others if x[2] != y and 50 * -p <= 100 * -x[0] <= 95 * -p][:negatives]
            out += [(i, j, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(hard)]
    return sorted(out)


def moved(rows):
    return [(i, y if i is None or y is None or i % 7 else (y + 1) % 10, v) for i, y, v in rows]


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_query_against_sql(spark, size):
    sf = f"/root/testdata/{size}"
    got = hn.op11_hard_negatives(spark, sf)
    assert got.columns == COLUMNS and dict(got.dtypes)["rank"] == "int"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = sorted(con.sql(hn.SQL).fetchall())
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    if size == "sf0.001":
        rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
        assert want == plain(moved(rows), lambda i: i % 50 == 0)


def clustered(n, seed=1, dim=6):
    """Clusters of several labels, a vector on a third of all rows, ties, zero vectors, nulls, odd components, repeated rows."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(7, dim))
    rows = []
    for i in range(n):
        v = centres[i % 7] + 0.2 * r.normal(size=dim) if i % 3 else centres[0]
        rows.append((i, int(r.integers(0, 4)), [float(x) for x in v]))
    rows += [(n, None, rows[1][2]), (n + 1, 1, None), (n + 2, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (n + 3, 1, [float("nan")] * dim), (n + 4, 1, [float("-inf")] + [0.0] * (dim - 1)), (None, 1, rows[2][2]), (n + 5, 2, [0.0] * dim), (n + 6, 2, [1.0, 2.0]), (n + 7, 3, [1.0, 2.0]), (n + 8, 2, []), (n + 9, 3, []), (n + 10, 2, [])]
    return rows + [rows[5], rows[10], rows[10]]


@pytest.mark.parametrize(("pivots", "group", "share"), [(256, 4096, 100_000), (3, 2, 20), (1, 4096, 7)])
def test_odd_rows(spark, pivots, group, share):
    rows = clustered(260)
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame([(*x, "clash", 0.5) for x in rows], "vec_id long, label int, embedding array<double>, score string, row double").repartition(3)
    got = hn.mine(df, F.col("vec_id") % 5 == 0, pivots=pivots, group=group, share=share)
    want = plain(rows, lambda i: i % 5 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 200


def test_no_rows(spark):
    none = hn.mine(spark.createDataFrame([], "vec_id long, label int, embedding array<float>"), F.col("vec_id") % 5 == 0)
    assert none.columns == COLUMNS and none.count() == 0
    lone = spark.createDataFrame([(0, 1, [1.0, 0.5]), (1, None, None)], "vec_id long, label int, embedding array<float>")
    assert hn.mine(lone, F.col("vec_id") % 5 == 0).count() == 0
    # no anchor, and labels that are words
    words = spark.createDataFrame([(1, "a", [1.0]), (2, "b", [0.8]), (3, "a", [0.9])], "vec_id long, label string, embedding array<float>")
    assert hn.mine(words, F.col("vec_id") == 7).count() == 0
    assert [tuple(r)[:4] for r in hn.mine(words, F.col("vec_id") == 1).collect()] == [(1, 3, 1, 2)]


def test_scores_stay_exact(spark):
    """Components far beyond those of unit vectors: products past 2^53 as whole numbers, past 2^63 at the bound."""
    big = [[2.0**22 + 1, 1.0], [2.0**22, 0.0], [2.0**21 + 1, 3.0], [2.0**21, 0.0]]
    rows = [(i, i // 2, v) for i, v in enumerate(big)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert sorted(map(tuple, hn.mine(df, F.col("vec_id") >= 0).collect())) == plain(rows, lambda i: True)
    a = np.array([[2**61, 3], [-(2**61), 1]])
    assert hn.products(a, a).tolist() == [[hn.MOST, hn.LEAST], [hn.LEAST, hn.MOST]]
    assert hn.quantized(np.array([1e300, -1e300, 0.1, -0.1])).tolist() == [2**62, -(2**62), 25, -26]


def test_bounds_rule_rows_out(spark):
    """On clusters far apart most rows are ruled out, and none that counts."""
    r = np.random.default_rng(4)
    centres = 20 * r.normal(size=(12, 8))
    rows = [(i, i % 24 // 12, [float(x) for x in centres[i % 12] + 0.3 * r.normal(size=8)]) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    seen = []
    kept = hn._joined

    def counted(blocks, anchors, routes, same, keep, share):
        met = blocks.join(routes, ["cell", "label"] if same else ["cell"]).where("farthest >= near and nearest <= far")
        seen.append((met.agg(F.sum("held")).first()[0], anchors.select("group").distinct().count() * len(rows)))
        return kept(blocks, anchors, routes, same, keep, share)

    hn._joined = counted
    try:
        got = hn.mine(df, F.col("vec_id") % 10 == 0, group=8)
        assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 10 == 0)
    finally:
        hn._joined = kept
    assert all(few < 0.6 * all_ for few, all_ in seen)
