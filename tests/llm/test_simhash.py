import itertools
import random
import re

import numpy as np
import xxhash

from bescheid.llm import simhash as K
from bescheid.llm.common import components


def plain(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    sh = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closed(nodes, radius=3):
    """Smallest reachable id of each (id, fingerprint)."""
    root = {i: i for i, _ in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations(nodes, 2):
        if (a ^ b).bit_count() <= radius:
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in nodes}


def test_fingerprints(odd, sf, spark):
    texts = [r.text or "" for r in odd.collect()] + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + ["one", "one two", "ÄÖ x y\x0bz", "x " * 300]
    for t in texts:
        assert K.simhash(t) == plain(t)


def test_covering():
    masks = K.covering(list(range(64)))
    assert len(masks) == 15
    r = random.Random(2)
    for _ in range(3000):
        bits = sum(1 << b for b in r.sample(range(64), r.randint(0, 3)))
        assert any(not bits & m for m in masks)
    for level, masks in enumerate(K._masks(3)):
        assert len(masks) == 15 ** (level + 1)


def test_table_against_brute_force(spark, sf):
    rows = K.op9_simhash(spark, sf).collect()
    want = closed([(r.doc_id, int(r.fingerprint, 16)) for r in rows])
    assert {r.doc_id: r.component_id for r in rows} == want


def test_full_buckets_lose_nothing(spark):
    """Fingerprints in tight clusters, with a bucket size that divides them to the third level."""
    r = random.Random(3)
    cores, fps = [r.getrandbits(64) for _ in range(3)], set()
    for _ in range(250):
        fps.add(r.choice(cores) ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))))
    nodes = list(enumerate(sorted(fps)))
    df = spark.createDataFrame([(i, K._signed(f)) for i, f in nodes], "node long, fp long")
    for bucket in (2, 8, 1000):
        found = {x.node: x.root for x in components(K.near_links(df.select("fp", "node"), bucket=bucket)).collect()}
        assert {i: found.get(i, i) for i, _ in nodes} == closed(nodes)


def test_odd_rows(spark, odd, none):
    rows = K.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    at = {r.doc_id: r for r in rows}
    assert at[2].fp == at[3].fp == 0 and at[2].component_id == at[3].component_id == 2
    assert at[1].component_id == at[7].component_id == at[None].component_id == 1
    assert K.near_duplicates(none).count() == 0


def test_doc_id_with_two_texts_is_one_member(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "x y z"), (2, "x y z"), (3, "q")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in K.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3}


def test_majority_counters():
    h = np.random.default_rng(1).integers(0, 1 << 63, 1000, np.uint64)
    assert K.majority(h) == sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > 1000)


def test_components_of_a_long_path(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400)], "a long, b long")
    got = {r.node: r.root for r in components(e).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and got[500] == 400
