"""Fingerprints, training order, pieces, chat."""

import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from bescheid.llm import chat
from bescheid.llm import fingerprint as K
from bescheid.llm import pieces as P
from bescheid.llm import training_order as T


def test_fingerprint_table(spark, sf):
    rows = {r.doc_id: r for r in K.op1_fingerprints(spark, sf).collect()}
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    texts = [t for _, t in docs]
    edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(texts, texts[1:] + texts[:1], strict=True)]
    own, changed = K.sketches(texts), K.sketches(edited)
    for i, (d, t) in enumerate(docs):
        r = rows[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited[i].encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (K.as_text(own)[i], K.as_text(changed)[i])
        assert r.near_edited == K.likeness(own[i], changed[i]) and r.near_next == K.likeness(own[i], own[(i + 1) % len(own)])
    long = [r for r in rows.values() if r.n_chars > 400]
    assert np.median([r.near_edited for r in long]) > 0.4 > 0.1 > np.median([r.near_next for r in long])


def test_fingerprint_is_local_and_alone():
    r = random.Random(4)
    text = " ".join("".join(r.choice("abcdeü") for _ in range(r.randint(1, 9))) for _ in range(800))
    batch = K.sketches([text, "", "aaaa", "zz" + text, text[:2000] + "X" + text[2000:], text[::-1]])
    assert (batch[0] == K.sketches([text])[0]).all() and not batch[1].any()
    assert K.likeness(batch[0], batch[3]) > 0.9 and K.likeness(batch[0], batch[4]) > 0.85 and K.likeness(batch[0], batch[5]) < 0.2
    assert K.likeness(batch[1], batch[1]) == 1 and K.likeness(batch[1], batch[2]) == 0
    inner = "the same interior of both texts, long enough to hold many whole phrases. " * 3
    a, b = (dict.fromkeys(n.tolist()) for n in (K.names([x + inner + y])[0][1] for x, y in (("prefix one ", " tail"), ("q", " another ending"))))
    assert len(a.keys() & b.keys()) > 0.5 * min(len(a), len(b))


def test_fingerprint_odd_rows(spark, odd, none):
    for ranges in (1, 4, 9):
        rows = K.fingerprints(odd, ranges).collect()
        assert len(rows) == odd.count()
        texts = [r.text or "" for r in sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))]
        want = sorted(hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode("utf-8", "surrogatepass")).hexdigest() for t, n in zip(texts, texts[1:] + texts[:1], strict=True))
        assert sorted(r.edited_sha256 for r in rows) == want
    assert K.fingerprints(none).count() == 0
    assert K.fingerprints(odd.where("doc_id = 3")).first().near_next == 1


def test_a_hot_id_and_nulls_are_dealt_to_many_tasks(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text number {i} " * (1 + i % 5)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = {r.text: r.h for r in df.selectExpr("text", "xxhash64(text) as h").collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]], r[1]))
    texts = [t for _, t in order]
    want = sorted((str(d), len(t), hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode()).hexdigest()) for (d, t), n in zip(order, texts[1:] + texts[:1], strict=True))
    made = K.fingerprints(df, 16)
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in made.collect()) == want
    tasks = df.withColumn("hash", T.F.xxhash64("text")).select(K._range_of([7] * 20 + [100, 400], 20).alias("range"), "doc_id", "hash").collect()
    for hot in (None, 7):
        assert len({r["range"] for r in tasks if r.doc_id == hot}) >= 15
    ends = [r["range"] for r in sorted(tasks, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.hash))]
    assert ends == sorted(ends)


def test_permutation():
    for n in (1, 2, 3, 5, 17, 1000, 4097):
        x = T.permute(np.arange(n), n)
        assert sorted(x.tolist()) == list(range(n)) and (T.permute(x, n, back=True) == np.arange(n)).all()
    assert (T.permute(np.arange(1000), 1000, 1) != T.permute(np.arange(1000), 1000, 2)).mean() > 0.9


def test_shards(spark, odd, none, tmp_path):
    shards = T.write(odd, f"file://{tmp_path}/s", length=64, shard_bytes=50_000)
    rows, starts = shards.read(spark).collect(), shards.starts(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tok, end = T._tokenizer(path), T.end_id(path)
    assert end == 50256
    want = sorted((r.doc_id or -1, n, ids[n * 64 : n * 64 + 64]) for r in odd.collect() for ids in [[*tok.encode_ordinary(r.text or ""), end]] for n in range(-(-len(ids) // 64)))
    got = sorted((r.doc_id or -1, r.seq_no, np.frombuffer(r.ids, "<u2").tolist()) for r in rows)
    assert got == want and len(starts) > 1
    assert sorted(starts[r.shard] + r.row for r in rows) == list(range(len(rows)))
    assert all(r.byte_offset == r.row * T.stride(64) for r in rows)
    # a record is where its slot says, in the file itself
    r = rows[len(rows) // 2]
    name = next(f for f in (tmp_path / "s").glob(f"part-{r.shard:05d}*"))
    data = name.read_bytes()[r.byte_offset + T.HEAD_SIZE :][: 2 * r.n_tokens]
    assert data == r.ids
    again = T.write(odd, f"file://{tmp_path}/t", length=64, shard_bytes=50_000)
    key = lambda x: (x.shard, x.row)
    assert [bytes(x.ids) for x in sorted(again.read(spark).collect(), key=key)] == [bytes(x.ids) for x in sorted(rows, key=key)]
    assert T.write(none, f"file://{tmp_path}/n").read(spark).count() == 0


def test_shards_depend_on_data_and_key_alone(spark, odd, tmp_path):
    docs = odd.union(spark.createDataFrame([(None, f"null {i}", None, None) for i in range(40)] + [(i, f"text {i} " * (i % 90), None, None) for i in range(300)], odd.schema))
    made = []
    for n, key in ((1, 1), (7, 1), (1, 2)):
        s = T.write(docs.repartition(n, "text"), f"file://{tmp_path}/{n}-{key}", length=32, shard_bytes=20_000, key=key)
        starts = s.starts(spark)
        made.append([tuple(r)[:5] + (bytes(r.ids),) for r in sorted(s.read(spark).collect(), key=lambda r: starts[r.shard] + r.row)])
    assert len(starts) > 3 and made[0] == made[1] != made[2] and sorted(map(repr, made[0])) != made[0]
    # slots follow the permutation of the indexes
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tok, end = T._tokenizer(path), T.end_id(path)
    rows = docs.selectExpr("doc_id", "coalesce(text, '') as text", "xxhash64(doc_id, coalesce(text, '')) as number").collect()
    rooms = max(len(r.text.encode()) for r in rows) // 32 + 1
    numbers, want = T.SPACE // rooms, []
    for r in rows:
        ids = [*tok.encode_ordinary(r.text), end]
        for n in range(-(-len(ids) // 32)):
            part = np.array(ids[32 * n : 32 * n + 32], "<u2").tobytes()
            place = int(T.permute(np.array([r.number % numbers * rooms + n]), numbers * rooms, 1)[0])
            want.append((place, T.struct.pack(T.HEAD, T.NO_ID if r.doc_id is None else r.doc_id, n, len(part) // 2) + part.ljust(64, b"\0"), (r.doc_id, n, part)))
    assert [x[2] for x in sorted(want, key=lambda x: x[:2])] == [(x[0], x[1], x[5]) for x in made[0]]
    from_there = T.Shards(f"file://{tmp_path}/7-1", 32).resume(spark, 100).collect()
    assert [(r.doc_id, r.seq_no, bytes(r.ids)) for r in sorted(from_there, key=lambda r: r.slot)] == [(x[0], x[1], x[5]) for x in made[0][100:]]


def test_training_order_query(spark, sf):
    rows = T.op2_training_order(spark, sf).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tok, end = T._tokenizer(path), T.end_id(path)
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = [*tok.encode_ordinary(r.text or ""), end]
        for n in range(-(-len(ids) // T.LENGTH)):
            part = ids[T.LENGTH * n : T.LENGTH * (n + 1)]
            want[r.doc_id, n] = len(part), zlib.crc32(np.array(part, "<u2").tobytes())
    assert {(r.doc_id, r.seq_no): (r.n_tokens, r.ids_crc32) for r in rows} == want and len(rows) == len(want)


def best(text, vocab):
    """Highest score over all segmentations."""
    top = [0.0] + [float("-inf")] * len(text)
    for e in range(1, len(text) + 1):
        for s in range(e):
            if text[s:e] in vocab:
                top[e] = max(top[e], top[s] + vocab[text[s:e]])
    return top[-1]


def test_viterbi_against_all_segmentations():
    r = random.Random(5)
    for _ in range(60):
        words = {"".join(r.choice("ab▁") for _ in range(r.randint(1, 4))): -r.random() * 9 for _ in range(12)} | {c: -8 - r.random() for c in "ab▁"}
        k = P.Pieces(["<unk>", *words], [0.0, *words.values()], ["unknown"] + ["normal"] * len(words))
        text = "".join(r.choice("ab ") for _ in range(r.randint(0, 25)))
        ids, _, score = k.encode(text)
        used = np.frombuffer(ids, "<u4").tolist()
        assert "".join(k.pieces[i] for i in used) == ("▁" + text.replace(" ", "▁") if text else "")
        want = best("▁" + text.replace(" ", "▁"), words) if text else 0
        assert score == pytest.approx(want) and sum(words[k.pieces[i]] for i in used) == pytest.approx(want)
        assert k.decode(used) == text


def test_pieces_round_trip(spark, odd, none, sf):
    path = public_tokenizers.path("piece_bpe_32k.model")
    k = P.Pieces.load(path)
    assert k.cuts
    for t in ("", " ", "  a b\n\tc ", "日本語 é😀́\u0000", "<s> </s> <unk>", "a" * 300, "\n\n", "word�"):
        ids = np.frombuffer(k.encode(t)[0], "<u4").tolist()
        assert k.decode(ids) == t, repr(t)
        whole = k.viterbi("▁" + t.replace(" ", "▁")) if t else ([], 0)
        assert ids == whole[0]  # cutting at words changes nothing
    back = P.decode(P.encode(odd)).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((r.doc_id or -1, (r.text or "").replace("▁", " ")) for r in odd.collect())
    assert P.encode(none).count() == 0
    assert P.op4_sentencepiece(spark, sf).where("not round_trip").count() == 0


def test_library_finds_no_better_pieces(spark, sf):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = public_tokenizers.path("piece_bpe_32k.model")
    m, k = sentencepiece.SentencePieceProcessor(model_file=path), P.Pieces.load(path)
    for r in spark.read.parquet(f"{sf}/documents.parquet").limit(50).collect():
        for w in r.text.split()[:40]:
            if k.single.issuperset(w) and w:
                assert k.encode(w)[2] >= sum(m.get_score(i) for i in m.encode(w)) - 1e-6


def test_models_of_another_format_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        raw = f.read()
    P.check_format(raw)
    for name, value in (("remove_extra_whitespaces", True), ("add_dummy_prefix", False), ("precompiled_charsmap", b"x")):
        m = sentencepiece_model_pb2.ModelProto.FromString(raw)
        setattr(m.normalizer_spec, name, value)
        with pytest.raises(ValueError):
            P.check_format(m.SerializeToString())


def test_pieces_query(spark, sf):
    k = P.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = P.op4_sentencepiece(spark, sf).collect()
    assert {r.doc_id for r in rows} == docs.keys() and len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id]
        assert r.decoded_crc32 == zlib.crc32(text.replace("▁", " ").encode())
        if len(text) < 1500:  # the whole text at once, not cut at words
            ids, score = k.viterbi("▁" + text.replace(" ", "▁")) if text else ([], 0.0)
            assert (r.n_pieces, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) and r.score == pytest.approx(score)


def plain(rows):
    out = {}
    for key, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")), key=lambda r: r[0]):
        turns = [(r[2] or "", r[3] or "") for r in group]
        loss = "".join(t for role, t in turns if role == "assistant")
        out[key] = (len(turns), hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


HARD = [(1, 0, "user", "a </turn>\n### assistant: x"), (1, 1, "assistant", "\\h \\b \\\\e #### </turn></turn>"), (1, 2, "user", "trailing"), (2, 0, "assistant", ""), (2, 1, "assistant", None), (3, 0, None, "x"), (None, None, "a: b\\c", "y"), (4, 0, "user", "tie"), (4, 0, "user", "tie"), (4, 0, "assistant", "tie"), (5, 1, "system", "### : "), (5, 2, "assistant", "😀é\n")]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*r, "extra", 1) for r in HARD], "conv_id long, turn long, role string, text string, turns string, loss int")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.expand(df)).collect()}
    assert got == plain(HARD)
    ex = chat.expand(df).collect()
    assert sum(r.loss_end > r.loss_start or r.conv_id in (2,) for r in ex) >= 5
    first = next(r for r in ex if r.conv_id == 1 and r.position == 1)
    assert first.formatted.count(chat.END) == 2 and first.formatted[first.loss_start : first.loss_end] == "\\bh \\bb \\b\\be \\h# \\e\\e"
    assert chat.expand(df.limit(0)).count() == 0 and chat.read_back(chat.expand(df.limit(0))).count() == 0


def test_chat_table(spark, sf):
    got = chat.op6_chat(spark, sf).toPandas().sort_values("conv_id").reset_index(drop=True)
    c = duckdb.connect()
    c.sql(f"create view conversations as select * from '{sf}/conversations.parquet'")
    want = c.sql(chat.SQL).df().sort_values("conv_id").reset_index(drop=True)
    assert (got[want.columns] == want).all().all()
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()] + [(-7, 0, "user", chat.PROBE), (-7, 1, "assistant", chat.PROBE)]
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got.itertuples()} == plain(rows)


def test_chat_plan_is_native(spark, sf):
    plan = chat.op6_chat(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_crc_is_unsigned():
    assert zlib.crc32(b"abc") == 891568578
