import numpy as np
from pyspark.sql import functions as F

from bescheid.llm import embeddings as K


def brute(vectors):
    """{id: (links, component)} of (id, vector) by all cosines."""
    ok = {i: np.array(v, np.float64) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = sorted(ok)
    root, links = {i: i for i in ids}, dict.fromkeys(ids, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            x, y = ok[i], ok[j]
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: (links.get(i, 0), find(i) if i in root else i) for i, _ in vectors}


def clouds(seed, groups, each, dim=16, noise=0.1):
    r = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        core = r.normal(size=dim)
        out += [(core + r.normal(size=dim) * noise * r.random()).astype(np.float32).tolist() for _ in range(each)]
    return list(enumerate(out))


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_against_all_pairs(spark):
    rows = clouds(1, 12, 15) + [(1000 + i, v) for i, (_, v) in enumerate(clouds(2, 60, 1))]
    rows += [(2000, rows[3][1]), (2001, rows[3][1]), (2002, [2 * x for x in rows[3][1]])]
    rows = [(i, frame_v) for i, frame_v in rows]
    want = brute(rows)
    for block in (512, 8):  # small blocks deal full buckets out as pairs of blocks
        got = {r.vec_id: (r.n_links, r.component_id) for r in K.near_vectors(frame(spark, rows), block=block).collect()}
        missed = sum(want[i][0] - got[i][0] for i in want)
        assert all(got[i][0] <= want[i][0] for i in want) and missed <= 0.01 * sum(n for n, _ in want.values())
        if not missed:
            assert got == want


def test_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = K.op10_embedding_dedup(spark, sf).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_odd_rows(spark):
    v, nan = [1.0, 2.0, 3.0], float("nan")
    rows = [(1, v), (2, v), (2, v), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]), (7, [nan, 1.0, 2.0]), (8, [float("inf"), 1.0, 2.0]), (None, v), (9, [1.0, 2.0]), (10, [2.0, 4.0]), (11, [1e30, 2e30, 3e30]), (12, [-0.0, 1.0, 0.0]), (13, [0.0, 1.0, 0.0])]
    df = frame(spark, rows).withColumn("node", F.lit("x")).withColumn("key", F.lit(1)).withColumn("copies", F.lit(1))
    got = {}
    for r in K.near_vectors(df).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert sum(map(len, got.values())) == len(rows)
    assert got[1] == [(3, 1, True)] and got[2] == [(3, 1, False)] * 2 and got[11] == [(3, 1, False)]
    assert all(got[i] == [(0, i, True)] for i in (3, 4, 5, 6, 7, 8)) and got[None] == [(0, None, False)]
    assert got[9] == [(1, 9, True)] and got[10] == [(1, 9, False)] and got[13] == [(1, 12, False)]
    assert K.near_vectors(df.limit(0)).count() == 0


def test_one_id_with_two_vectors_is_one_member(spark):
    got = K.near_vectors(frame(spark, [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, [-1.0, -1.0])])).collect()
    assert {(r.vec_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 3)}


def test_recall_beside_the_large_table(spark):
    """The table's vectors with planted neighbours just above the cosine, all links by brute force."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    v = np.array([x for _, x in rows[:1500]], np.float64)
    v /= np.sqrt(np.square(v).sum(axis=1, keepdims=True))
    r = np.random.default_rng(3)
    w = r.normal(size=v.shape)
    w -= (v * w).sum(axis=1, keepdims=True) * v
    c = 0.9001 + 0.05 * r.random((len(v), 1)) ** 2
    near = c * v + np.sqrt(1 - c * c) * w / np.sqrt(np.square(w).sum(axis=1, keepdims=True))
    rows += [(10**6 + i, x) for i, x in enumerate(near.astype(np.float32).tolist())]
    all_ = np.array([x for _, x in rows], np.float64)
    all_ /= np.sqrt(np.square(all_).sum(axis=1, keepdims=True))
    links = (all_ @ all_.T >= 0.9).sum(axis=1) - 1
    want = {i: int(n) for (i, _), n in zip(rows, links, strict=True)}
    got = {x.vec_id: x.n_links for x in K.near_vectors(frame(spark, rows)).collect()}
    assert got.keys() == want.keys() and all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.995 * sum(want.values()) > 2000


def test_plan_follows_the_number_of_vectors():
    for n, cosine in ((10, 0.9), (50_000, 0.9), (10**9, 0.9), (10**6, 0.8)):
        bits, tables = K.plan(n, cosine)
        p = (1 - np.arccos(cosine) / np.pi) ** bits
        assert (1 - p) ** tables <= K.MISS and (bits == 6 or n / 2**bits <= K.STRANGERS)


def test_sketches_keep_partners():
    r = np.random.default_rng(4)
    a = r.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = r.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    g = K.planes(64, 6, 14)[:, : K.SKETCH]
    far = ((a @ g > 0) != (b @ g > 0)).sum(axis=1)
    assert (far > K.sketch_limit()).sum() <= 2 and (((a @ g > 0) != (a[::-1] @ g > 0)).sum(axis=1) <= K.sketch_limit()).sum() == 0
