"""The pipeline's near-duplicate stage against brute-force Jaccard."""

import importlib
import random

import numpy as np

from bescheid.llm import similar

pipe = importlib.import_module("corpus_pipeline")


def plain(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode("utf-8", "surrogatepass").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def closed(texts):
    sets = sorted((d, plain(t)) for d, t in texts)
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in root}


def test_stage_against_brute_force(spark):
    stage = dict(pipe.STAGES)["near_duplicates"]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = stage(spark, docs, "")
    assert kept.columns == docs.columns
    want = closed([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_groups_in_blocks(spark):
    """A long chain of edits and a tight group, compared in blocks of 4."""
    r = random.Random(1)
    w, texts = [f"w{i}" for i in range(300)], []
    for _ in range(60):
        w = [x if r.random() > 0.012 else f"v{r.random()}" for x in w]
        texts.append(" ".join(w))
    texts += [" ".join(x if r.random() > 0.01 else "z" for x in w) for _ in range(40)] + ["", None, "a b", "A  b"]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (4, 256):
        assert {x.doc_id: x.component_id for x in similar.near_duplicates(df, block=block).collect()} == closed(rows)


def test_pairs():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 12, r.integers(0, 12)).astype(np.uint64)) for _ in range(60)]
    like = lambda a, b: len(a | b) and 5 * len(a & b) >= 4 * len(a | b)
    s = [set(x.tolist()) for x in sets]
    assert set(zip(*(x.tolist() for x in similar.similar_pairs(sets)), strict=True)) == {(i, j) for i in range(60) for j in range(i + 1, 60) if like(s[i], s[j])}
    assert set(zip(*(x.tolist() for x in similar.similar_pairs(sets[:20], sets[20:])), strict=True)) == {(i, j - 20) for i in range(20) for j in range(20, 60) if like(s[i], s[j])}


def test_stage_odd_rows(spark, odd, none):
    stage = dict(pipe.STAGES)["near_duplicates"]
    kept = stage(spark, odd, "")
    assert kept.columns == odd.columns and stage(spark, none, "").count() == 0
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect())[:2] == [1, 2] and kept.where("doc_id is null").count() == 1
    two = spark.createDataFrame([(1, "a b c"), (1, "x y z"), (2, "x y z"), (3, "q")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in similar.near_duplicates(two).collect()} == {1: 1, 2: 1, 3: 3}


def test_rows_of_one_id(spark):
    """Different texts under one doc_id are documents of their own; of rows alike in id and text one stays, always the same."""
    rows = [(1, "a b c", "p"), (1, "x y z", "q"), (2, "x y z", "r"), (2, "x y z", "s"), (3, "only here", "t"), (3, "only here", "t"), (3, "only here", "u"), (None, "a b c", "v")]
    stage = dict(pipe.STAGES)["near_duplicates"]
    seen = set()
    for k in range(3):
        df = spark.createDataFrame(random.Random(k).sample(rows, len(rows)), "doc_id long, text string, `odd.name` string").repartition(k + 1)
        kept = sorted(map(tuple, stage(spark, df, "").collect()), key=str)
        assert [x[:2] for x in kept] == [(1, "a b c"), (1, "x y z"), (3, "only here"), (None, "a b c")]
        seen.add(str(kept))
    assert len(seen) == 1


def test_repeated_rows_count_once(spark):
    """A candidate group in which one row is repeated many times."""
    w = [f"w{i}" for i in range(200)]
    texts = [" ".join(w), " ".join(w[:-1]), " ".join(w[:-2] + ["new"])]
    df = spark.createDataFrame([(5, texts[0])] * 300 + [(6, texts[1]), (7, texts[2]), (8, "other")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in similar.near_duplicates(df, block=2).collect()} == {5: 5, 6: 5, 7: 5, 8: 8}
    assert sorted(r.doc_id for r in similar.one_of_each(df).collect()) == [5, 8]


def shared_half(n, r):
    """`n` texts of 400 shared and 400 own words each, of any two a similarity of 0.33; the last two are near copies."""
    common = " ".join(f"c{r.randrange(10**6)}" for _ in range(400))
    texts = [f"{common} " + " ".join(f"w{r.randrange(10**6)}" for _ in range(400)) for _ in range(n - 1)]
    return list(enumerate([*texts, texts[-1].replace(" ", " new ", 1)]))


def coded(spark, rows):
    sets = [similar.shingles(t) for _, t in rows]
    least = [similar.least_hashes(s) for s in sets]
    data = [(d, similar.majority(s) - (1 << 63), similar.bands(m), bytearray(similar.sketch(m))) for (d, _), s, m in zip(rows, sets, least, strict=True)]
    return spark.createDataFrame(data, "node long, fp long, bands array<long>, sketch binary")


def test_shared_passages_form_no_group(spark):
    """Many texts meet in a band by their shared half, yet only the near copies become candidates, however blocks are cut."""
    rows = shared_half(300, random.Random(5))
    nodes = coded(spark, rows).cache()
    met = nodes.selectExpr("explode(bands) as value").groupBy("value").count().where("count > 3").count()
    assert met
    for cell in (4, 2048):
        assert {tuple(sorted(r)) for r in similar._candidates(nodes, cell=cell).collect()} == {(298, 299)}


def test_hot_bucket_keeps_pairs_beside_its_head(spark):
    """Pairs far from the head of their only bucket, and pairs of one far and one near node, are found in small blocks."""
    r = np.random.default_rng(2)
    base = [r.integers(0, 1 << 63, similar.BANDS * similar.ROWS).astype(np.uint64) for _ in range(3)]

    def mixed(k, other, part):
        out = base[k].copy()
        out[: int(part * len(out))] = base[other][: int(part * len(out))]
        return similar.sketch(out)

    # 0-9 near the first, 10-19 near the second, 20 between both, 30-34 near the third
    rows = [(i, mixed(0, 2, 0.01 * i)) for i in range(10)] + [(10 + i, mixed(1, 2, 0.01 * i)) for i in range(10)] + [(20, mixed(1, 0, 0.25))] + [(30 + i, mixed(2, 0, 0.02 * i)) for i in range(5)]
    nodes = spark.createDataFrame([(i, [7], bytearray(s)) for i, s in rows], "node long, bands array<long>, sketch binary")
    words = np.array([np.frombuffer(s, np.uint64) for _, s in rows])
    limit = similar.sketch_limit()
    close = similar.differing(words[:, None], words[None]) <= limit
    want = similar.forest(*([rows[i][0] for i in x.tolist()] for x in np.nonzero(np.triu(close, 1))))
    assert len({b for _, b in want}) == 3
    for cell in (2, 3, 2048):
        got = [tuple(x) for x in similar._banded(nodes, limit, cell).collect()]
        assert sorted(similar.forest(*zip(*got, strict=True))) == sorted(want)


def test_sketch_limit():
    """Pairs at the least similarity differ less often than the limit; pairs with a shared third hardly ever do."""
    r = random.Random(3)
    limit = similar.sketch_limit()
    for own, like in ((50, True), (400, False)):
        for _ in range(20):
            common = [f"c{r.random()}" for _ in range(400)]
            a, b = (similar.least_hashes(similar.shingles(" ".join(common + [f"{x}{r.random()}" for _ in range(own)]))) for x in "ab")
            d = similar.differing(*(np.frombuffer(similar.sketch(x), np.uint64) for x in (a, b)))
            assert (d <= limit) == like
