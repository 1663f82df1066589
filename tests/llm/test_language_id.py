"""Language profiles: encoding against plain Python, accuracy on the held-out fold, odd rows."""

import random
import zlib

import numpy as np
import pytest

from bescheid.llm import language_id as lid


def plain(text):
    """The sum of a text's trigram vectors, one letter after another."""
    out, word = np.zeros(lid.DIMS), [0]
    for c in [*text.lower(), " "]:
        if c.isalpha():
            word.append(ord(c))
            continue
        word.append(0)
        for a, b, d in zip(word, word[1:], word[2:], strict=False):
            out += np.roll(lid.letter(a), 2) * np.roll(lid.letter(b), 1).astype(int) * lid.letter(d)
        word = [0]
    return out


TEXTS = ["", "a", "Straße und É́a", "one two\n\nthree 4five6 x", "--- 123 !!", "日本語 テキスト mixed Ünï", "\x00 a\ud800b İ", "x" * 50 + " y"]


def test_bundles_against_plain():
    got = lid.bundles(TEXTS, np.arange(len(TEXTS)), len(TEXTS))
    assert (got == np.array([plain(t) for t in TEXTS])).all()
    # groups add up, and nothing depends on what else is encoded
    assert (lid.bundles(TEXTS, np.zeros(len(TEXTS), int), 1)[0] == got.sum(axis=0)).all()
    assert (lid.bundles(TEXTS[2:3], np.zeros(1, int), 1)[0] == got[2]).all()
    many = "".join(chr(0x4E00 + i % 3000) + (" " if i % 7 == 0 else "") for i in range(9000))
    assert (lid.bundles([many], np.zeros(1, int), 1)[0] == plain(many)).all()


def test_letters_are_near_orthogonal():
    v = np.array([lid.letter(c) for c in range(97, 123)], int)
    cos = v @ v.T / lid.DIMS
    assert (np.diag(cos) == 1).all() and np.abs(cos - np.eye(26)).max() < 0.2


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_held_out_accuracy(spark, size):
    sf = f"/root/testdata/{size}"
    got = lid.op12_language_id(spark, sf)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = {r.doc_id: r for r in got.collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    out = [rows[d.doc_id].lang_pred == d.lang for d in docs if rows[d.doc_id].held_out]
    assert sum(out) >= 0.985 * len(out)


def test_query_against_plain(spark):
    """Profiles and cosines computed in one loop over plain Python sums."""
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect() if len(r.text) < 4000]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    model = lid.train(df)
    sums = {}
    for _, t, lang in docs:
        sums[lang] = sums.get(lang, 0) + plain(t)
    assert model.langs == sorted(sums)
    unit = np.array([sums[k] / np.linalg.norm(sums[k]) for k in model.langs])
    assert np.allclose(model.vectors, unit, atol=1e-12)
    for r in lid.identify(df.limit(40), model).collect():
        v = plain(next(t for d, t, _ in docs if d == r.doc_id))
        cos = unit @ v / np.linalg.norm(v)
        assert r.lang_pred == model.langs[int(cos.argmax())] and abs(r.score - max(cos.max(), 0)) < 1e-9


def test_odd_rows(spark, odd, none):
    """Nulls, empty and long texts, repeated rows, clashing columns; empty tables; no labels."""
    docs = [(1, "the house of the dog", "en", 1), (2, "das haus und der hund", "de", 2), (3, None, "fr", 3), (4, "le chat noir", None, 4), (5, "12 34 --", "xx", 5), (6, "der hund und das haus " * 20_000, "de", 6), (7, "the the dog", "en", 7), (7, "the the dog", "en", 7), (None, "das der und", "de", 8)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, score int")
    model = lid.train(df)
    assert model.langs == ["de", "en"]
    got = sorted(map(tuple, lid.identify(df, model).collect()), key=str)
    assert [x[:2] for x in got] == [(1, "en"), (2, "de"), (3, "und"), (4, got[3][1]), (5, "und"), (6, "de"), (7, "en"), (7, "en"), (None, "de")]
    assert got[2][2] == got[4][2] == 0 and got[6] == got[7]
    assert lid.identify(odd, model).count() == odd.count() and lid.identify(none, model).count() == 0
    blank = lid.train(df.where("doc_id > 100"))
    assert blank.langs == [] and {(r.lang_pred, r.score) for r in lid.identify(df, blank).collect()} == {("und", 0.0)}
    # a bound on languages keeps those with most trigrams
    assert lid.train(df, most=1).langs == ["de"]


def test_partitions_do_not_matter(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()]
    seen = set()
    for k in (1, 5):
        random.Random(k).shuffle(docs)
        df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(k)
        model = lid.train(df)
        seen.add((model.vectors.tobytes(), str(sorted(map(tuple, lid.identify(df, model).collect())))))
    assert len(seen) == 1
