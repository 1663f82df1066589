"""The manifest against plain Python and DuckDB; ranks under hot ids, small buckets and repeated rows."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from bescheid.llm import merkle

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, row double, g int"


def part(x):
    s = str(x)
    return "-" if x is None else f"{len(s.encode())}:{s}"


def up(nodes):
    rows = [nodes]
    while len(nodes) > 1:
        nodes = [H("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        rows.append(nodes)
    return rows


def climb(rows, i):
    for r in rows[:-1]:
        yield i % 2, (r[i ^ 1] if i ^ 1 < len(r) else "")
        i //= 2


def plain(docs, bad=lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 0):
    """(doc_id, source, lang, n_chars, text, ..) rows -> rows of the manifest."""
    leaf = lambda d, more=0: H("".join(part(x) for x in (d[0], d[1], d[2], d[3] if d[3] is None else d[3] + more, d[4])))
    by = {}
    for d in docs:
        by.setdefault(d[2], []).append((d, leaf(d)))
    names = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for n in names:
        by[n].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees.append(up([x[1] for x in by[n]]))
    top = up([t[-1][0] for t in trees])
    out = []
    for k, (n, t) in enumerate(zip(names, trees, strict=True)):
        for i, (d, own) in enumerate(by[n]):
            way = [*climb(t, i), *climb(top, k)]
            x = leaf(d, 1) if bad(d[0]) else own
            for right, other in way:
                x = H(other + x if right else x + other)
            out.append((d[0], own, t[-1][0], top[-1][0], H("".join(o for _, o in way)), x, x == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_against_plain(spark, size):
    sf = f"/root/testdata/{size}"
    got = merkle.op13_merkle(spark, sf)
    assert got.columns == COLUMNS
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    want = plain(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.sql(merkle.SQL).fetchall(), key=str) == want
    assert {r[-1] for r in want} == {True, False}


def odd_rows(n, seed=3):
    r = random.Random(seed)
    ids = [None, 0, -5, 7, 7, 2**62, -(2**63), 2**63 - 1, 14]
    rows = [(r.choice(ids) if r.random() < 0.6 else r.randrange(-9999, 9999), r.choice([None, "", "a:b"]), r.choice([None, "", "de", "ä", "z" * 50, "en", "en", "en"]), r.choice([None, 0, 5, 2**63 - 1]), r.choice([None, "", "é😀", "x" * 30_000]), "clash", 1.5, 3) for _ in range(n)]
    return rows + rows[: n // 3] + [rows[0]] * (n // 3)


@pytest.mark.parametrize("bucket", [1, 16, 1024])
def test_odd_rows(spark, bucket):
    """Nulls, extreme and repeated ids, rows repeated many times, clashing columns; buckets divided to the last digit."""
    rows = odd_rows(120)
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3), bad, bucket)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_few_rows(spark):
    one = [(5, "s", None, 3, "t", "l", 0.0, 1)]
    got = merkle.manifest(spark.createDataFrame(one, SCHEMA)).collect()
    assert [tuple(r) for r in got] == plain(one, lambda d: False) and got[0].root == got[0].leaf and got[0].proof_sha256 == H("")
    none = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert none.columns == COLUMNS and none.count() == 0


def test_many_prefixes(spark):
    """More than one round of prefixes in the groups and over the langs."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("l"), "id")).otherwise("en").alias("lang"), F.col("id").alias("n_chars"), F.lit("t").alias("text"))
    rows = [tuple(r) for r in docs.collect()]
    got = merkle.manifest(docs, F.lit(False))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, lambda d: False)


def test_ranks_exact(spark):
    """Ranks equal a sort of the whole group, whatever the distribution of ids."""
    r = random.Random(5)
    rows = [("g", r.choice([r.randrange(10), r.randrange(2**40), 77]), H(str(i)), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, doc_id long, leaf string, row long")
    want = {x[3]: i for i, x in enumerate(sorted(rows, key=lambda x: (x[1], x[2])))}
    for bucket in (2, 64):
        got = merkle.ranks(df, bucket).collect()
        assert {x.row: x.rank for x in got} == want and {x.n for x in got} == {2000}
