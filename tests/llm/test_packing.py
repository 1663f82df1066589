import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bescheid.llm import packing as K

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def test_encoder_equals_library(tok):
    r = random.Random(1)
    wide, latin = [chr(i) for i in range(0x250)] + list("''ssttmd<|> \n日Σé😀"), [chr(i) for i in range(256)] + list("'''ssttmmdrvl  \n")
    texts = ["".join(r.choice(a) for _ in range(r.randint(0, 30))) for a in (wide, latin) for _ in range(3000)] + ["<|endoftext|> A <|ENDOFTEXT|>", ""]
    for t, ids in zip(texts, K.encoder(PATH)(texts), strict=True):
        assert tok.encode(t, add_special_tokens=False).ids == np.frombuffer(ids, "<u4").tolist(), repr(t)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_vocabulary_is_encoded_as_the_library_does(spark, name):
    path = public_tokenizers.path(name)
    own, texts = Tokenizer.from_file(path), ["Hello, World! It's 42 x", "", "  two  spaces\n\n", "Ünïcode é😀 <|endoftext|> don't", "a" * 5000]
    got = K.encoder(path)(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [own.encode(t, add_special_tokens=False).ids for t in texts]
    rows = K.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, end=7).collect()
    assert {r.doc_id: r.doc_tokens for r in rows} == {i: len(own.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def check(rows, docs, tok):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for rs in by.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    want = {}
    for doc, text in docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(doc, []).extend((s, n, zlib.crc32(ids[s : s + n].tobytes()), len(ids)) for s, n in K.pieces(len(ids)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    return by


def test_table(spark, sf, tok):
    rows = K.op5_packing(spark, sf).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    by = check(rows, docs, tok)
    assert sum(r.length for r in rows) / (4096 * len(by)) > 0.95


def test_odd_rows(spark, odd, none, tok):
    check(K.pack(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()], tok)
    assert K.pack(none).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_differencing(seed):
    r = random.Random(seed)
    sizes = [r.randint(1, 60) for _ in range(40)]
    for k in (1, 2, 7, 50):
        bins = K.difference(sizes, k)
        assert len(bins) == k and sorted(i for b in bins for i in b) == list(range(40))
    sums = [sum(sizes[i] for i in b) for b in K.difference(sizes, 5)]
    assert max(sums) - min(sums) <= max(sizes)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in b) for b in K.difference([8, 7, 6, 5, 4], 2)) == [14, 16]  # the classic example
    assert all(sum(sizes[i] for i in b) <= 64 for b in K.windows(sizes, 64))
    assert K.windows([50] * 5, 64) == [[i] for i in [0, 1, 2, 3, 4]] or len(K.windows([50] * 5, 64)) == 5  # the count rises


def test_pieces_cover():
    for n in (1, 1023, 1024, 1025, 4095, 4096, 4097, 12_345):
        ps = K.pieces(n)
        assert [s for s, _ in ps] == [sum(m for _, m in ps[:i]) for i in range(len(ps))] and sum(m for _, m in ps) == n
