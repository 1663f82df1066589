"""Lines of a document have labels of their own; scores against all paths."""

import itertools

import numpy as np
import pytest

from bescheid.llm import quality as Q

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    return docs, [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.doc_id in docs]


@pytest.fixture(scope="module")
def model(spark):
    return Q.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def held(rows, want):
    import zlib

    docs, labels = rows
    return [docs[d] for d, q in labels if q == want and zlib.crc32(str(d).encode()) % 3 == 1 and docs[d].strip()]


def test_half_good_documents(rows, model):
    """Documents joined from a good and a bad held-out one: lines come apart, and transitions help with it."""
    right = {True: 0, False: 0}
    loss = {True: 0.0, False: 0.0}
    n = 0
    flat = Q.Model(model.weights, model.trans * 0, model.slope, model.offset)
    for k, (good, bad) in enumerate(zip(held(rows, 1), held(rows, 0), strict=False)):
        a, b = (good, bad) if k % 2 else (bad, good)
        x, lines, _ = Q.line_features([a + "\n" + b])
        want = np.arange(lines[0]) <= a.count("\n")
        want = want if k % 2 else ~want
        for m in (model, flat):
            p = m.lines(x, lines)
            right[m is model] += int(((p >= 0.5) == want).sum())
            loss[m is model] -= float(np.log(np.clip(np.where(want, p, 1 - p), 1e-6, 1)).sum())
        n += len(want)
    assert n > 100 and right[True] / n >= 0.9 and loss[True] < loss[False]


def test_scores_against_all_paths(spark, rows, model):
    """The query's scores of short documents, summed over every labelling of their lines."""
    got = {r.doc_id: r.score for r in Q.op7_quality(spark, SF).collect()}
    short = {d: t for d, t in rows[0].items() if t.count("\n") < 8}
    for d, t in itertools.islice(sorted(short.items()), 60):
        x, _, weight = Q.line_features([t])
        unary, total, good = x @ model.weights, 0.0, 0.0
        top = unary.max(axis=1).sum()
        for path in itertools.product((0, 1), repeat=len(x)):
            e = np.exp(sum(unary[i, k] for i, k in enumerate(path)) + sum(model.trans[a, b] for a, b in itertools.pairwise(path)) - top)
            total += e
            good += e * (weight * np.array(path)).sum() / weight.sum()
        assert got[d] == pytest.approx(1 / (1 + np.exp(-(model.slope * good / total + model.offset))), abs=1e-6)
    assert len(got) == len(rows[0])


def test_belief_meets_the_label():
    r = np.random.default_rng(0)
    lines, y = np.array([5, 1, 40, 3]), np.array([1, 0, 0, 1])
    weight, unary, trans = r.integers(1, 50, lines.sum()).astype(float), r.normal(size=(lines.sum(), 2)), np.array([[1.0, -1], [-1, 1]])
    share = Q._shares(Q.crf.marginals(Q._believed(unary, trans, lines, weight, y), trans, lines)[:, 1], lines, weight)
    assert (share[y == 1] >= Q.GOOD - 1e-9).all() and (share[y == 0] <= Q.BAD + 1e-9).all()


def test_spliced_lines_see_their_new_neighbours():
    texts = ["a b\nc!!\nd", "| x |\n| y |"]
    x, lines, _ = Q.line_features(texts)
    out, many, at = Q._spliced(x, lines, np.array([0, 1]))
    whole = Q.line_features(["\n".join(texts)])[0]
    assert many.tolist() == [5] and at.tolist() == [0, 1, 2, 3, 4] and np.allclose(out[:, :13], whole[:, :13]) and np.allclose(out[:, 14:], whole[:, 14:])
