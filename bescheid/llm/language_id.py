"""Language identification by hyperdimensional profiles: letters are random vectors, bound to trigrams, bundled to texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, ship, strings, table
from .quality import held_out

#: Components of a vector.
DIMS = 1024
#: Languages of a model at most: those with most trigrams. It bounds what every task gets to 8 KB times this.
MOST_LANGS = 4096
#: Texts, and characters unless one text has more, that are encoded at once.
TEXTS, CHARS = 128, 1_000_000
SEED = 11
UNKNOWN = "und"


@lru_cache(maxsize=65_536)
def letter(code: int) -> np.ndarray:
    """The random vector of -1 and 1 of a letter; code 0 is the edge of a word."""
    return (np.random.default_rng([SEED, code]).integers(0, 2, DIMS) * 2 - 1).astype(np.int8)


#: For each code point: 0 not looked at yet, 1 no letter, 2 a letter.
_KIND = np.zeros(0x110000, np.uint8)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigrams as rows of three code points, place of each occurrence's trigram among them, its text).

    Letters count in lower case; what stands between them is one edge (0). A trigram lies within a word and its edges.
    """
    low = [t.lower() for t in texts]
    cp = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    seen = np.zeros(0x110000, bool)
    seen[cp] = True
    codes = np.flatnonzero(seen)
    for c in codes[_KIND[codes] == 0].tolist():
        _KIND[c] = 2 if chr(c).isalpha() else 1
    codes = codes[_KIND[codes] == 2]
    name = np.zeros(0x110000, np.int32)
    name[codes] = np.arange(1, len(codes) + 1)
    ids = name[cp]
    is_letter = ids > 0
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[:-1] |= is_letter[1:]
    owner = np.repeat(np.arange(len(low)), np.fromiter(map(len, low), np.int64, len(low)) + 1)
    x, of = ids[keep].astype(np.int64), np.concatenate(([0], owner))[keep]
    n = len(codes) + 1
    mid = np.flatnonzero(x[1:-1] > 0) + 1 if len(x) > 2 else np.zeros(0, np.int64)
    gram = (x[mid - 1] * n + x[mid]) * n + x[mid + 1]
    if n**3 <= 1 << 22:
        there = np.zeros(n**3, bool)
        there[gram] = True
        kinds = np.flatnonzero(there)
        place = np.zeros(n**3, np.int32)
        place[kinds] = np.arange(len(kinds))
        at = place[gram]
    else:
        kinds, at = np.unique(gram, return_inverse=True)
    real = np.concatenate(([0], codes))
    return np.stack([real[kinds // (n * n)], real[kinds // n % n], real[kinds % n]], axis=1), at, of[mid]


def bound(kinds: np.ndarray) -> np.ndarray:
    """The vectors of trigrams: the first letter's rotated by two, the second's by one, times the third's."""
    codes, at = np.unique(kinds, return_inverse=True)
    own = np.stack([letter(c) for c in codes.tolist()]) if len(codes) else np.zeros((0, DIMS), np.int8)
    at = at.reshape(kinds.shape)
    return np.roll(own, 2, axis=1)[at[:, 0]] * np.roll(own, 1, axis=1)[at[:, 1]] * own[at[:, 2]]


def bundles(texts: list[str], group: np.ndarray, groups: int) -> np.ndarray:
    """For each group of texts the sum of the vectors of all their trigrams: whole numbers, exact."""
    kinds, at, of = trigrams(texts)
    out = np.zeros((groups, DIMS), np.float64)
    mine = group[of] if len(of) else of
    exact = np.float32 if len(at) < 1 << 24 else np.float64
    for k in range(0, len(kinds), 8192):
        some = kinds[k : k + 8192]
        here = (at >= k) & (at < k + 8192)
        counts = np.bincount(mine[here] * len(some) + (at[here] - k), minlength=groups * len(some)).reshape(groups, len(some))
        out += counts.astype(exact) @ bound(some).astype(exact)
    return out


def _pieces(texts: list[str]) -> Iterator[slice]:
    """Slices of at most TEXTS texts and CHARS characters; a longer text comes alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and (i - start == TEXTS or size + len(t) > CHARS):
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, np.ndarray] = {}
    for b in batches:
        texts, langs = strings(b["text"]), b["lang"].tolist()
        for s in _pieces(texts):
            names, group = np.unique(np.array(langs[s], dtype=object).astype(str), return_inverse=True)
            for lang, v in zip(names.tolist(), bundles(texts[s], group, len(names)), strict=True):
                held[lang] = held[lang] + v if lang in held else v
    if held:
        yield pd.DataFrame({"lang": list(held), "v": pd.Series([x.astype(np.int64) for x in held.values()], dtype=object)})


@dataclass
class Profiles:
    """Prototypes of languages: names in order and unit vectors."""

    langs: list[str]
    vectors: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text and its prototype's cosine, 0 for less."""
        v = bundles(texts, np.arange(len(texts)), len(texts))
        size = np.sqrt(np.square(v).sum(axis=1))
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cos = (v @ self.vectors.T) / np.maximum(size, 1)[:, None]
        best = cos.argmax(axis=1)
        score = np.where(size > 0, np.clip(cos[np.arange(len(texts)), best], 0, 1), 0)
        return [self.langs[k] if s else UNKNOWN for k, s in zip(best.tolist(), size.tolist(), strict=True)], score


def train(docs: DataFrame, most: int = MOST_LANGS) -> Profiles:
    """The profiles of all texts of `docs` (text, lang) with both: each language's is the sum over all its trigrams.

    Tasks add up their own texts and give one vector for each language; sums are of whole numbers, so neither order nor
    partitions matter. Of more than `most` languages those with the most trigrams are learned, of equals the first by
    name. Empty table: no languages.
    """
    ship(docs.sparkSession)
    known = docs.where("lang is not null and text is not null").select("text", "lang")
    sums = mapped(known, _sums, "lang string, v array<long>").select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    whole = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).select("lang", F.col("v.x").alias("v"), F.aggregate("v", F.lit(0.0), lambda a, y: a + F.pow(y["x"].cast("double"), 2)).alias("size"))
    found = sorted((r.lang, np.array(r.v, np.float64)) for r in whole.where("size > 0").orderBy(F.desc("size"), "lang").limit(most).collect())
    vectors = np.array([v for _, v in found]).reshape(len(found), DIMS)
    return Profiles([lang for lang, _ in found], vectors / np.sqrt(np.square(vectors).sum(axis=1, keepdims=True)))


def identify(docs: DataFrame, model: Profiles) -> DataFrame:
    """`docs` (doc_id, text) with lang_pred and score, one row per row: doc_id, lang_pred, score.

    The whole text counts. `und` and 0 for a text that is null or has no letter, and where the model is empty. Ties go
    to the first language by name. A null doc_id keeps its row; rows that repeat are scored alike. Empty table: no
    rows. Other columns are not read.
    """
    ship(docs.sparkSession)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = strings(b["text"])
            got = [model.predict(texts[s]) for s in _pieces(texts)]
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": [x for g in got for x in g[0]], "score": np.concatenate([g[1] for g in got]) if got else np.zeros(0)})

    return mapped(docs.select("doc_id", "text"), predict, "doc_id long, lang_pred string, score double")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned outside the held-out fold; see `train` and `identify`."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", deal=True)
    found = identify(docs, train(docs.where(~held_out("doc_id"))))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
