"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crf
from .common import chunks, mapped, ship, strings, table

#: Labelled documents that the field is fitted on at most: a bounded sample by hash of the id.
TRAIN_DOCS = 3000
#: Lines of one document that the fit reads at most, evenly spread in runs; so the sample is bounded in bytes. Scoring reads all.
TRAIN_LINES = 400
#: What the label says of a document's lines: a good one's share of good text is at least, a bad one's at most this.
GOOD, BAD = 0.9, 0.4
#: Documents spliced from a good and a bad one, and rounds of estimating the lines' labels.
SPLICES, ROUNDS = 500, 3
_KINDS = ("lower", "upper", "digit", "space", "punct", "excl", "pipe", "symbol", "other", "newline")
_TOP = 0x300


def _kind(c: str) -> int:
    if c == "\n":
        return 9
    if c.isspace():
        return 3
    if c.islower():
        return 0
    if c.isupper():
        return 1
    if c.isdigit():
        return 2
    if c in ".,;:?'\"()-":
        return 4
    return {"!": 5, "|": 6}.get(c, 8 if c.isalpha() else 7)


_TABLE = np.array([_kind(chr(i)) for i in range(_TOP)] + [8], np.uint8)
_MIX = (np.arange(1, 17, dtype=np.uint32) * np.uint32(2654435761)) | np.uint32(1)
#: Features of one line, then those of them that are also read from the line before and the line after.
OWN = ("bias", "upper", "digit", "symbol", "pipe", "excl", "punct", "space", "other", "repeat", "word_len", "log_len", "short", "twin")
NEAR = (1, 3, 4, 5, 9)
WIDTH = len(OWN) + 2 * len(NEAR)


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line of all texts, lines of each text, weight of each line), by whole-array steps.

    A weight is the line's length plus one. An empty text is one empty line.
    """
    cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _TABLE[np.minimum(cp, _TOP)]
    ends = np.flatnonzero(cp == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(ends)
    lines = np.array([t.count("\n") + 1 for t in texts], np.int64)
    span = ends - starts + 1
    line = np.repeat(np.arange(n, dtype=np.int64), span)
    counts = np.bincount(line * 10 + kind, minlength=10 * n).reshape(n, 10)
    size = (span - 1).astype(np.float64)
    black = (kind != 3) & (kind != 9)
    begin = black.copy()
    begin[1:] &= ~black[:-1]
    ws = np.flatnonzero(begin)
    x = np.zeros((n, WIDTH), np.float32)
    if len(ws):
        inside = np.arange(ws[0], len(cp), dtype=np.int64) - np.repeat(ws, np.diff(np.append(ws, len(cp))))
        value = np.where(black[ws[0] :], cp[ws[0] :] * _MIX[inside & 15], np.uint32(0)).astype(np.uint32)
        word = np.add.reduceat(value, ws - ws[0], dtype=np.uint32)
        of = line[ws]
        again = np.concatenate(([False], (word[1:] == word[:-1]) & (of[1:] == of[:-1])))
        words = np.bincount(of, minlength=n)
        x[:, 9] = np.bincount(of[again], minlength=n) / np.maximum(words - 1, 1)
        x[:, 10] = np.minimum((size - counts[:, 3]) / np.maximum(words, 1), 40) / 10
        sums = np.bincount(of, weights=word, minlength=n)
    else:
        sums = np.zeros(n)
    part = counts / np.maximum(size, 1)[:, None]
    x[:, 0] = 1
    for at, k in ((1, 1), (2, 2), (3, 7), (4, 6), (5, 5), (6, 4), (7, 3), (8, 8)):
        x[:, at] = part[:, k] * (10 if k in (5, 6, 7) else 1)  # rare marks, on the scale of the rest
    x[:, 11] = np.log1p(size) / 8
    x[:, 12] = size < 5
    doc = np.repeat(np.arange(len(texts)), lines)
    order = np.lexsort((sums, doc))
    twin = (doc[order][1:] == doc[order][:-1]) & (sums[order][1:] == sums[order][:-1])
    x[order[1:][twin], 13] = 1
    x[order[:-1][twin], 13] = 1
    _neighbours(x, lines)
    return x, lines, size + 1


def _neighbours(x: np.ndarray, lines: np.ndarray) -> None:
    """Fill in what each line reads from the line before and after it in its text."""
    doc = np.repeat(np.arange(len(lines)), lines)
    same = doc[1:] == doc[:-1]
    x[:, len(OWN) :] = 0
    for i, f in enumerate(NEAR):
        x[1:, len(OWN) + i] = np.where(same, x[:-1, f], 0)
        x[:-1, len(OWN) + len(NEAR) + i] = np.where(same, x[1:, f], 0)


@dataclass(frozen=True)
class Model:
    """Weights and transitions of the field, then the logistic that turns a document's good share into a score."""

    weights: np.ndarray | None
    trans: np.ndarray | None
    slope: float
    offset: float

    def lines(self, x: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """The probability that a line is good, for every line."""
        return crf.marginals(x @ self.weights, self.trans, lines)[:, 1]

    def shares(self, x: np.ndarray, lines: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return _shares(self.lines(x, lines), lines, weight)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.offset)
        return 1 / (1 + np.exp(-(self.slope * self.shares(*line_features(texts)) + self.offset)))


def _shares(p: np.ndarray, lines: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Length-weighted share of good lines in each text."""
    first = np.concatenate(([0], np.cumsum(lines)[:-1]))
    return np.add.reduceat(p * weight, first) / np.add.reduceat(weight, first)


def _believed(unary: np.ndarray, trans: np.ndarray, lines: np.ndarray, weight: np.ndarray, y: np.ndarray) -> np.ndarray:
    """`unary` with the least push per document for which its lines agree with its label.

    Of all distributions over a document's lines that have the share its label asks for, this is the one nearest
    to the field: every line's good score moves by the same amount, found by halving.
    """
    low, high = np.zeros(len(y)), np.full(len(y), 12.0)
    way = np.where(y == 1, 1.0, -1.0)
    pushed = lambda d: unary + np.column_stack((np.zeros(len(unary)), np.repeat(way * d, lines)))
    meets = lambda d: np.where(y == 1, (s := _shares(crf.marginals(pushed(d), trans, lines)[:, 1], lines, weight)) >= GOOD, s <= BAD)
    none = meets(low)
    for _ in range(8):
        mid = (low + high) / 2
        ok = meets(mid)
        high, low = np.where(ok, mid, high), np.where(ok, low, mid)
    return pushed(np.where(none, 0.0, high))


def _spliced(x: np.ndarray, lines: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lines, places of the lines in x) of texts made of a good and a bad document, in turns in either order."""
    first = np.concatenate(([0], np.cumsum(lines)[:-1]))
    pairs = list(zip(np.flatnonzero(y == 1).tolist(), np.flatnonzero(y == 0).tolist(), strict=False))[:SPLICES]
    parts = [p[:: 1 if i % 2 else -1] for i, p in enumerate(pairs)]
    at = np.concatenate([np.arange(first[d], first[d] + lines[d]) for p in parts for d in p])
    many = np.array([lines[a] + lines[b] for a, b in parts], np.int64)
    out = x[at].copy()
    _neighbours(out, many)
    return out, many, at


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """The model of (label, line features, line weights) rows.

    A label is known for a document, not for its lines: those are latent. They start from the document's label;
    then, in turns, the lines' labels are estimated by the field under what the label says of their share
    (`_believed`), and the field is fitted to the estimates. Texts spliced from a good and a bad document show it
    how labels change within a text.
    """
    good = sum(r[0] for r in rows)
    if not rows or good in (0, len(rows)):
        return Model(None, None, 0.0, good / len(rows) if rows else 0.5)
    lines = np.array([len(r[1]) for r in rows], np.int64)
    x, weight = np.concatenate([r[1] for r in rows]).astype(np.float64), np.concatenate([r[2] for r in rows])
    y = np.array([r[0] for r in rows])
    mixed, many, at = _spliced(x, lines, y)
    both, all_lines = np.concatenate((x, mixed)), np.concatenate((lines, many))
    label = np.repeat(y, lines)
    field = crf.train(both, np.concatenate((label, label[at])), all_lines, 2)
    for _ in range(ROUNDS):
        w, a = field
        believed = _believed(x @ w, a, lines, weight, y)
        p, seen, _ = crf.marginals(believed, a, lines, pairs=True)
        # a spliced text has its parts' estimates
        q, switched, _ = crf.marginals(np.log(np.maximum(p[at], 1e-6)), a, many, pairs=True)
        field = crf.fit(both, np.concatenate((p, q)), seen + switched, all_lines, steps=30, start=field)
    share = Model(*field, 1.0, 0.0).shares(x, lines, weight)
    z, slope, offset = share - 0.5, 1.0, 0.0
    for _ in range(50):  # Newton's steps, slightly shrunk
        p = 1 / (1 + np.exp(-(slope * z + offset)))
        r = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((y - p) * z).sum() - 0.05 * slope, (y - p).sum()])
        h = np.array([[(r * z * z).sum() + 0.05, (r * z).sum()], [(r * z).sum(), r.sum()]])
        step = np.clip(np.linalg.solve(h, g), -3, 3)
        slope, offset = slope + step[0], offset + step[1]
    return Model(*field, float(slope), float(offset - 0.5 * slope))


def held_out(doc_id) -> F.Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sampled(most: int):
    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, label, text in zip(b["doc_id"].tolist(), b["quality"].tolist(), strings(b["text"]), strict=True):
                x, _, weight = line_features([text])
                if len(x) > most:
                    # ten runs of neighbouring lines
                    run = most // 10
                    keep = np.unique(np.concatenate([np.arange(s, s + run) for s in np.linspace(0, len(x) - run, 10).astype(int)]))
                    x, weight = x[keep], weight[keep]
                out.append((doc, label, x.astype("<f4").tobytes(), weight.astype("<f8").tobytes()))
            yield pd.DataFrame(out, columns=["doc_id", "quality", "x", "weight"])

    return sampled


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> Model:
    """Fit on at most `train_docs` labelled documents outside the held-out fold, chosen by hash of their id.

    Only features of this bounded sample reach the driver: at most `train_lines` lines of each. Labels other than 0 and
    1, null ids and labels without a document are not used; of several labels of one document the best counts, of
    several texts the least; null and empty texts are one empty line. Without both labels the score is the share
    of good documents, or a half without any. Empty tables: a half.
    """
    chosen = (
        labels.select("doc_id", "quality").where("quality in (0, 1) and doc_id is not null").where(~held_out("doc_id"))
        .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # `train_docs` rows at most
    rows = mapped(found, _sampled(train_lines), "doc_id long, quality int, x binary, weight binary").collect()
    rows.sort(key=lambda r: r["doc_id"])
    return fit([(r["quality"], np.frombuffer(r["x"], "<f4").reshape(-1, WIDTH), np.frombuffer(r["weight"], "<f8")) for r in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 where score >= 0.5) of its column text; a narrow stage.

    The score reads the text alone, whole. Null and empty texts are one empty line; equal texts have equal scores.
    All rows and columns stay, but columns named score and predicted are replaced: put others' into a struct first,
    as the pipeline does. Empty table: no rows.
    """
    from pyspark.sql.types import DoubleType

    ship(docs.sparkSession)

    @F.pandas_udf(DoubleType())
    def of(text: pd.Series) -> pd.Series:
        texts = strings(text)
        return pd.Series(np.concatenate([model.scores(texts[s]) for s in chunks(texts)]) if texts else [], dtype="float64")

    return docs.withColumn("score", of("text")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; see `train` and `score`."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", deal=True)
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
