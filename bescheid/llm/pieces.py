"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a one-pass Viterbi."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .common import mapped, ship, strings, table

MARK = "▁"
#: A character that is no piece costs this much more than the worst piece.
UNKNOWN = 10.0
CACHE = 800_000
_held: dict[str, Pieces] = {}


def check_format(model: bytes) -> None:
    """Refuse a model whose texts are prepared otherwise than here: not as they are, with spaces as marks and one before."""
    from sentencepiece import sentencepiece_model_pb2

    m = sentencepiece_model_pb2.ModelProto.FromString(model)
    n = m.normalizer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix or not n.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix or any(p.type == p.USER_DEFINED for p in m.pieces):
        raise ValueError("the model normalizes texts, treats spaces in another way, or has pieces of the user's")


class Pieces:
    """A vocabulary with scores. Encoding takes the segmentation of the highest total score."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        """kinds: "normal", "byte", or another for control and unknown pieces, which texts never match."""
        self.pieces, self.kinds = pieces, kinds
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == "byte"}
        self.unknown = kinds.index("unknown") if "unknown" in kinds else 0
        normal = [i for i, k in enumerate(kinds) if k == "normal"]
        self.automaton = ahocorasick.Automaton()
        for i in normal:
            self.automaton.add_word(pieces[i], (len(pieces[i]), scores[i], i))
        self.automaton.make_automaton()
        self.penalty = min((scores[i] for i in normal), default=0.0) - UNKNOWN
        # a text may be cut before each mark that follows another character if no piece joins the two
        self.cuts = not any(MARK in pieces[i].lstrip(MARK) for i in normal)
        self.single = frozenset(pieces[i] for i in normal if len(pieces[i]) == 1)
        self.sizes = [len(p) for p in pieces]
        # so is a line end that no piece holds
        line = "" if any("\n" in pieces[i] for i in normal) else "\n"
        self.runs = re.compile(f"{MARK}*[^{MARK}{line}]+|{MARK}+" + (f"|{line}" if line else ""))
        self.words: dict[str, tuple[bytes, int, float]] = {}
        self.plain = [p.replace(MARK, " ") if k == "normal" else "" for p, k in zip(pieces, kinds, strict=True)]
        self.value = {i: b for b, i in self.bytes.items()}

    @classmethod
    def load(cls, path: str) -> Pieces:
        if path not in _held:
            import sentencepiece

            m = sentencepiece.SentencePieceProcessor(model_file=path)
            check_format(m.serialized_model_proto())
            n = m.vocab_size()
            kind = lambda i: "unknown" if m.is_unknown(i) else "byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unused(i) else "normal"
            _held[path] = cls([m.id_to_piece(i) for i in range(n)], [m.get_score(i) for i in range(n)], [kind(i) for i in range(n)])
        return _held[path]

    def viterbi(self, text: str) -> tuple[list[int], float]:
        """Ids and score of the best segmentation; among equals the one whose last piece is longest."""
        n = len(text)
        best: list[float] = [0.0] + [float("-inf")] * n
        back = [-1] * (n + 1)
        if self.single.issuperset(text):
            for last, (size, score, i) in self.automaton.iter(text):
                if (s := best[last + 1 - size] + score) > best[last + 1]:
                    best[last + 1], back[last + 1] = s, i
        else:
            hits = self.automaton.iter(text)
            hit = next(hits, None)
            for end in range(1, n + 1):
                while hit is not None and hit[0] + 1 == end:
                    size, score, i = hit[1]
                    if (s := best[end - size] + score) > best[end]:
                        best[end], back[end] = s, i
                    hit = next(hits, None)
                if text[end - 1] not in self.single and (s := best[end - 1] + self.penalty) > best[end]:
                    best[end], back[end] = s, -1
        ids: list[int] = []
        at = n
        while at:
            i = back[at]
            if i >= 0:
                ids.append(i)
                at -= self.sizes[i]
            else:
                at -= 1
                ids += reversed(self._fallback(text[at]))
        return ids[::-1], best[n]

    def _fallback(self, c: str) -> list[int]:
        raw = c.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in raw] if self.bytes else [self.unknown]

    def encode(self, text: str) -> tuple[bytes, int, float]:
        """(ids as little-endian uint32, byte pieces among them, score). A space is put before the text.

        Texts are cut where no piece can cross; the best paths of the parts make the best path of the whole.
        """
        if not text:
            return b"", 0, 0.0
        marked = MARK + text.replace(" ", MARK)
        words, out = self.words, []
        for w in self.runs.findall(marked) if self.cuts else [marked]:
            got = words.get(w)
            if got is None:
                ids, score = self.viterbi(w)
                got = np.array(ids, "<u4").tobytes(), sum(i in self.value for i in ids), score
                if len(words) >= CACHE:
                    words.clear()
                if len(w) < 64:
                    words[w] = got
            out.append(got)
        return b"".join([g[0] for g in out]), sum([g[1] for g in out]), float(sum([g[2] for g in out]))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks become spaces, runs of byte pieces their UTF-8, the first space goes."""
        if not self.value.keys() & set(ids):
            text = "".join([self.plain[i] for i in ids])
        else:
            out, raw = [], bytearray()
            for i in ids:
                b = self.value.get(i)
                if b is not None:
                    raw.append(b)
                    continue
                if raw:
                    out.append(raw.decode("utf-8", "surrogatepass" if self._whole(raw) else "replace"))
                    raw.clear()
                out.append(self.plain[i])
            if raw:
                out.append(raw.decode("utf-8", "surrogatepass" if self._whole(raw) else "replace"))
            text = "".join(out)
        return text[1:] if text[:1] == " " else text

    @staticmethod
    def _whole(raw: bytearray) -> bool:
        try:
            raw.decode("utf-8", "surrogatepass")
        except UnicodeDecodeError:
            return False
        return True


def _encoder(path: str):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces.load(path)
        for b in batches:
            texts = strings(b["text"])
            got = [pieces.encode(t) for t in texts]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "ids": [g[0] for g in got], "n_bytes": [g[1] for g in got], "score": [g[2] for g in got]})

    return encode


def _decoder(path: str):
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces.load(path)
        for b in batches:
            yield b.assign(text=[None if x is None else pieces.decode(np.frombuffer(x, "<u4").tolist()) for x in b["ids"]])

    return decode


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian uint32), n_bytes (ids of the byte fallback), score of `docs` (doc_id, text).

    A narrow stage over whole texts. Null and empty texts have no ids. Characters that are no piece become the
    bytes of their UTF-8. A null doc_id and repeated rows stay. A very long text takes time and memory in
    proportion. Empty table: no rows. Other columns are not read. A model that normalizes texts is refused.
    """
    ship(docs.sparkSession)
    return mapped(docs.select("doc_id", "text"), _encoder(path or public_tokenizers.path("piece_bpe_32k.model")), "doc_id long, ids binary, n_bytes long, score double")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """`encoded` (doc_id, ids) with its text. Decoding what `encode` gave returns the text, but for U+2581,
    which stands for a space in this format, and null, which returns empty. Null ids give a null text, no ids an
    empty one; null doc_ids, repeated rows and very long lists stay. Empty table: no rows. Other columns are not read.
    """
    ship(encoded.sparkSession)
    return mapped(encoded.select("doc_id", "ids"), _decoder(path or public_tokenizers.path("piece_bpe_32k.model")), "doc_id long, ids binary, text string")


def _both(path: str):
    def both(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces.load(path)
        for b in batches:
            texts = strings(b["text"])
            got = [pieces.encode(t) for t in texts]
            back = [pieces.decode(np.frombuffer(g[0], "<u4").tolist()) for g in got]
            yield pd.DataFrame({
                "doc_id": b["doc_id"].astype("Int64"), "n_pieces": [len(g[0]) // 4 for g in got], "n_bytes": [g[1] for g in got], "score": [g[2] for g in got],
                "ids_crc32": [zlib.crc32(g[0]) for g in got], "decoded_crc32": [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in back], "round_trip": [t == x.replace(MARK, " ") for t, x in zip(back, texts, strict=True)],
            })

    return both


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding of all documents in one pass: counts, digests of ids and of the decoded text."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", deal=True)
    return mapped(docs, _both(public_tokenizers.path("piece_bpe_32k.model")), "doc_id long, n_pieces long, n_bytes long, score double, ids_crc32 long, decoded_crc32 long, round_trip boolean")
