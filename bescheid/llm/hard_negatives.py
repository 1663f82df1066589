"""Hard negatives by a distributed nearest-neighbour join over Voronoi cells of norm-augmented vectors.

With a further component that gives all rows x one length M, and 0 for it in an anchor q, the greatest inner product
is the least distance: |q' - x'|^2 = |q|^2 + M^2 - 2 q.x. Rows belong to the cell of their nearest pivot; what is known
of a group of anchors bounds the distances that can serve it, and only rows within those bounds are sent there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, mapped, ship, table

POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these percentages of its positive's.
LOW, HIGH = 50, 95
SCALE = 256
#: Pivots at most; they go to every task.
PIVOTS = 256
#: Anchors that meet in one task, and candidates that one task reads for them.
GROUP, SHARE = 4096, 100_000
#: Products held at once in a task.
CELLS = 1 << 20
#: Rows of one cell and label that travel together, at most.
BLOCK = 256
LEAST, MOST = -(1 << 63), (1 << 63) - 1

#: Rows that take part, as SQL; never null.
VALID = "coalesce(vec_id is not null and label is not null and embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('inf')), false)"
_ROW = "row long, vec_id long, label string, anchor boolean, dim int, square double, width int, raw binary"
_BLOCK = "cell long, label string, nearest double, farthest double, block long, held int, ids binary, width int, raw binary"


def quantized(v: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of each component in double precision; beyond 62 bits it is the bound."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * v.astype(np.float64)), -(2.0**62), 2.0**62).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of `a` and `b`, exact; beyond 64 bits they are the bound."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top < 2**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), LEAST, MOST).astype(np.int64)


def unpacked(raw: list[bytes], width: list[int]) -> np.ndarray:
    """Vectors of one length as they were packed, as rows of 64-bit numbers."""
    if len(set(width)) == 1:
        return np.frombuffer(b"".join(raw), f"<i{width[0]}").reshape(len(raw), -1).astype(np.int64)
    return np.array([np.frombuffer(r, f"<i{w}") for r, w in zip(raw, width, strict=True)], np.int64)


def _coder(scale: int):
    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row, vec, label, anchor, v in zip(b["row"], b["vec_id"], b["label"], b["anchor"], b["embedding"], strict=True):
                q = quantized(v, scale)
                width = next(w for w in (2, 4, 8) if not len(q) or np.abs(q).max() < 1 << (8 * w - 1))
                out.append((row, vec, label, anchor, len(q), float(np.square(q.astype(np.float64)).sum()), width, q.astype(f"<i{width}").tobytes()))
            yield pd.DataFrame(out, columns=["row", "vec_id", "label", "anchor", "dim", "square", "width", "raw"])

    return code


@dataclass
class Pivots:
    """Some rows by their length, the greatest square M^2 of all rows, and distances to them."""

    most: float
    rows: dict[int, np.ndarray] = field(default_factory=dict)

    def of(self, dim: int) -> np.ndarray:
        """Pivots of vectors of a length; where there are none, the zero vector."""
        return self.rows.get(dim, np.zeros((1, dim)))

    def lifted(self, square: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.most - square, 0))

    def apart(self, dim: int, own: int) -> np.ndarray:
        """Distances of the pivot `own`, as an anchor, to all pivots of a length."""
        p = self.of(dim)
        return np.sqrt(np.maximum(np.square(p[own]).sum() + self.most - 2 * (p @ p[own]), 0))

    def cells(self, v: np.ndarray, square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest pivot, distance) of rows."""
        p, own = self.of(v.shape[1]), self.lifted(square)
        d = 2 * (self.most - v @ p.T - own[:, None] * self.lifted(np.square(p).sum(axis=1))[None, :])
        return _least(d)

    def homes(self, v: np.ndarray, square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest pivot, distance) of anchors, with pivots taken as anchors, too, so that distances are those of the vectors."""
        p = self.of(v.shape[1])
        return _least(square[:, None] + np.square(p).sum(axis=1)[None, :] - 2 * (v @ p.T))


def _least(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    best = d.argmin(axis=1)
    return best, np.sqrt(np.maximum(d[np.arange(len(d)), best], 0))


def _assign(pivots: Pivots):
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, g in b.groupby("dim", sort=False):
                v, square = unpacked(g["raw"].tolist(), g["width"].tolist()).reshape(len(g), dim).astype(np.float64), g["square"].to_numpy()
                cell, away = pivots.cells(v, square)
                home, reach = pivots.homes(v, square)
                yield g.assign(cell=dim * PIVOTS + cell, away=away, home=dim * PIVOTS + home, reach=reach)

    return assign


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by cell, label and distance as blocks of at most BLOCK: their ids and vectors, and the distances they span."""
    for b in batches:
        out = []
        for (cell, label), g in b.groupby(["cell", "label"], sort=False):
            for k in range(0, len(g), BLOCK):
                x = g.iloc[k : k + BLOCK]
                width, raw = int(x["width"].max()), x["raw"].tolist()
                packed = b"".join(raw) if (x["width"] == width).all() else unpacked(raw, x["width"].tolist()).astype(f"<i{width}").tobytes()
                out.append((cell, label, x["away"].min(), x["away"].max(), x["row"].iloc[0], len(x), x["vec_id"].to_numpy("<i8").tobytes(), width, packed))
        yield pd.DataFrame(out, columns=["cell", "label", "nearest", "farthest", "block", "held", "ids", "width", "raw"])


def _routes(pivots: Pivots):
    """For each group of anchors and each cell the distances from its pivot at which a row can serve the group."""

    def routes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for group, home, reach, inner, outer, *label in b[["group", "home", "reach", "inner", "outer", *[c for c in ("label",) if c in b.columns]]].itertuples(index=False, name=None):
                dim, own = divmod(home, PIVOTS)
                apart = pivots.apart(dim, own)
                # room for rounding, as the bounds are real numbers and the scores whole ones
                slack = 1e-6 * (math.sqrt(pivots.most) + reach) + 1e-3
                wide = outer + reach + slack
                near = np.maximum(apart - wide, inner - reach - apart - slack)
                out += [(group, dim * PIVOTS + j, *label, float(lo), float(hi)) for j, (lo, hi) in enumerate(zip(near, apart + wide, strict=True)) if hi >= lo]
            yield pd.DataFrame(out, columns=["group", "cell", *[c for c in ("label",) if c in b.columns], "near", "far"])

    return routes


class _Task:
    """The anchors of one group and the best candidates of each of their windows so far."""

    def __init__(self, anchors: pd.DataFrame, same: bool, keep: int) -> None:
        self.same, self.keep = same, keep
        self.row, self.own, self.label = anchors["row"].to_numpy(np.int64), anchors["vec_id"].to_numpy(np.int64), anchors["label"].tolist()
        self.v = unpacked(anchors["raw"].tolist(), anchors["width"].tolist())
        # one entry for each window: its anchor, tag, bounds
        n = [len(x) for x in anchors["tags"]]
        self.at = np.repeat(np.arange(len(n)), n)
        self.tag, self.low, self.high = (np.concatenate([np.asarray(x, np.int64) for x in anchors[c]]) for c in ("tags", "lows", "highs"))
        #: The id with which a full window's last score is held; before that any id may enter at its lower bound.
        self.last = np.full(len(self.at), MOST)
        self.best = np.zeros((0, 3), np.int64)  # window, score, vec_id

    def take(self, ids: np.ndarray, labels: list[str], v: np.ndarray) -> None:
        """Look at further candidates."""
        codes: dict[str, int] = {}
        mine = np.array([codes.setdefault(x, len(codes)) for x in self.label])
        theirs = np.array([codes.setdefault(x, len(codes)) for x in labels])
        step = max(1, min(BLOCK, CELLS // max(1, len(self.at))))
        for s in range(0, len(ids), step):
            score, own = products(self.v, v[s : s + step]), ids[None, s : s + step]
            fit = self.own[:, None] != own
            if not self.same:
                fit &= mine[:, None] != theirs[None, s : s + step]
            x = score[self.at]
            hit = fit[self.at] & (x <= self.high[:, None]) & ((x > self.low[:, None]) | ((x == self.low[:, None]) & (own <= self.last[:, None])))
            w, j = np.nonzero(hit)
            if len(w):
                self._merge(np.stack([w, x[w, j], ids[s + j]], axis=1))

    def _merge(self, new: np.ndarray) -> None:
        touched = np.zeros(len(self.at), bool)
        touched[new[:, 0]] = True
        old = touched[self.best[:, 0]]
        b = np.concatenate((self.best[old], new))
        # scores descend; ~x keeps the order of -x without overflow
        b = b[np.lexsort((b[:, 2], ~b[:, 1], b[:, 0]))]
        first = np.flatnonzero(np.concatenate(([True], b[1:, 0] != b[:-1, 0])))
        place = np.arange(len(b)) - np.repeat(first, np.diff(np.append(first, len(b))))
        b = b[place < self.keep]
        last = b[place[place < self.keep] == self.keep - 1]
        self.low[last[:, 0]], self.last[last[:, 0]] = last[:, 1], last[:, 2]
        self.best = np.concatenate((self.best[~old], b))

    def found(self) -> pd.DataFrame:
        w = self.best[:, 0]
        return pd.DataFrame({"row": self.row[self.at[w]], "tag": self.tag[w], "score": self.best[:, 1], "found": self.best[:, 2]})


def _search(same: bool, keep: int):
    """Rows sorted by group, share and kind: the anchors of a group, then blocks of candidates that serve it."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, anchors, task = None, [], None
        for b in batches:
            for (group, share, kind), g in b.groupby(["group", "share", "kind"], sort=False):
                if (group, share) != at:
                    if task is not None:
                        yield task.found()
                    at, anchors, task = (group, share), [], None
                if kind == 0:
                    anchors.append(g)
                elif anchors or task is not None:
                    if task is None:
                        task, anchors = _Task(pd.concat(anchors), same, keep), []
                    ids = [np.frombuffer(x, "<i8") for x in g["ids"]]
                    labels = [x for x, n in zip(g["label"].tolist(), g["held"].tolist(), strict=True) for _ in range(n)]
                    v = [np.frombuffer(r, f"<i{w}").reshape(len(i), -1).astype(np.int64) for r, w, i in zip(g["raw"], g["width"], ids, strict=True)]
                    task.take(np.concatenate(ids), labels, np.concatenate(v))
        if task is not None:
            yield task.found()

    return search


_FOUND = "row long, tag long, score long, found long"


def _joined(blocks: DataFrame, anchors: DataFrame, routes: DataFrame, same: bool, keep: int, share: int) -> DataFrame:
    """The best `keep` candidates (row, tag, score, found) of each window of the anchors among the blocks on the routes."""
    on = ["cell", "label"] if same else ["cell"]
    held = blocks.groupBy(*on).agg(F.sum("held").alias("rows"))
    shares = routes.join(held, on).groupBy("group").agg(F.greatest(F.lit(1), F.ceil(F.sum("rows") / share)).cast("int").alias("shares"))
    cands = blocks.join(routes.join(shares, "group"), on).where("farthest >= near and nearest <= far")
    cands = cands.select("group", F.pmod(F.xxhash64("block"), F.col("shares")).cast("int").alias("share"), F.lit(1).alias("kind"), "label", "held", "ids", "width", "raw")
    asked = anchors.join(shares, "group").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    asked = asked.select("group", "share", F.lit(0).alias("kind"), "row", "vec_id", "label", "width", "raw", "tags", "lows", "highs")
    both = asked.unionByName(cands, allowMissingColumns=True).repartition("group", "share").sortWithinPartitions("group", "share", "kind")
    got = mapped(both, _search(same, keep), _FOUND)
    first = F.row_number().over(W.partitionBy("row", "tag").orderBy(F.desc("score"), "found"))
    return got.withColumn("place", first).where(F.col("place") <= keep)


def best_in_windows(blocks: DataFrame, anchors: DataFrame, pivots: Pivots, same: bool, keep: int, group: int = GROUP, share: int = SHARE) -> DataFrame:
    """(row, tag, score, found, place): for each window (tags, lows, highs) of each anchor the `keep` rows of its own label
    (`same`) or another with the highest scores within it, ties by the smaller vec_id.

    Rows come in blocks of one cell and label, by their distance from the pivot. Anchors of one cell (and label) form
    groups of about `group`. First each group meets the blocks of its own cell, which gives every window a lower bound of
    its last score; then all blocks whose distances from their pivot reach into the bounds of the group. Groups that many rows serve are read in shares, and what the shares found is merged.
    """
    by = ["home", "label"] if same else ["home"]
    parts = anchors.groupBy(*by).agg(F.ceil(F.count("*") / group).alias("parts"))
    named = anchors.join(parts, by).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))).drop("parts")
    named = cut(named.withColumn("group", F.xxhash64(*by, "part")), few=True)
    keys = ["group", *by]
    own = named.select(*keys).distinct().withColumns({"near": F.lit(0.0), "far": F.lit(float("inf"))}).withColumnRenamed("home", "cell")
    first = _joined(blocks, named, own, same, keep, share).where(F.col("place") == keep).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("tag", "score"))).alias("least"))
    known = named.join(first, "row", "left").withColumn("lows", F.expr("transform(tags, (t, i) -> greatest(lows[i], coalesce(try_element_at(least, t), lows[i])))")).drop("least")
    known = cut(known, few=True)
    away = lambda s: F.sqrt(F.greatest(F.lit(0.0), F.col("square") + F.lit(pivots.most) - 2 * s.cast("double")))
    bounds = known.groupBy(*keys).agg(F.max("reach").alias("reach"), F.min(away(F.array_max("highs"))).alias("inner"), F.max(away(F.array_min("lows"))).alias("outer"))
    kind = "group long, cell long, label string, near double, far double" if same else "group long, cell long, near double, far double"
    return _joined(blocks, known, mapped(bounds, _routes(pivots), kind), same, keep, share)


def mine(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, pivots: int = PIVOTS, group: int = GROUP, share: int = SHARE) -> DataFrame:
    """Hard negatives of the rows of `vectors` (vec_id, label, embedding) for which `anchor` holds: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the integer inner product, exact. An anchor's positives are the
    `positives` rows of its label with the highest scores; for each the first `negatives` rows of other labels whose score
    lies within `low` to `high` percent of the positive's. Ties go to the smaller vec_id. The join is exact: all rows are
    candidates of all anchors, but for those that the triangle inequality rules out.

    Rows with a null vec_id, a null label, a null vector or null or non-finite components take no part. Vectors of
    different lengths do not meet; empty ones have the score 0. A row that is there several times is several candidates
    and several anchors, though never a positive of its own vec_id. Pivots are at most `pivots` rows, by a hash of the
    vector. Empty table: no rows. Other columns are not read.
    """
    ship(vectors.sparkSession)
    valid = vectors.select("vec_id", F.col("label").cast("string").alias("label"), "embedding", F.coalesce(anchor, F.lit(False)).alias("anchor")).where(VALID)
    # numbered once, in what is written
    coded = cut(mapped(valid.withColumn("row", F.monotonically_increasing_id()), _coder(scale), _ROW))
    n, most = coded.agg(F.count("*"), F.max("square")).first()
    some = coded.orderBy(F.xxhash64("raw"), "vec_id").limit(min(pivots, PIVOTS, max(1, math.isqrt(n) // 2))).select("dim", "width", "raw").distinct().collect()
    by: dict[int, list[np.ndarray]] = {}
    for r in sorted(some):
        by.setdefault(r.dim, []).append(np.frombuffer(r.raw, f"<i{r.width}").astype(np.float64))
    chosen = Pivots(most or 0.0, {d: np.array(v) for d, v in by.items()})
    rows = cut(mapped(coded, _assign(chosen), f"{_ROW}, cell long, away double, home long, reach double"))
    # in ranges, so that a cell with most rows is spread, too
    blocks = cut(mapped(rows.select("cell", "label", "away", "row", "vec_id", "width", "raw").repartitionByRange("cell", "label", "away", "row").sortWithinPartitions("cell", "label", "away"), _pack, _BLOCK))
    asked = rows.where("anchor").drop("cell", "away", "anchor")
    all_ = {"tags": F.array(F.lit(0).cast("long")), "lows": F.array(F.lit(LEAST)), "highs": F.array(F.lit(MOST))}
    good = cut(best_in_windows(blocks, asked.withColumns(all_), chosen, True, positives, group, share).select("row", "score", "found"), few=True)
    part = lambda x, p, how: how(x.cast("decimal(20,0)") * p / 100).cast("long")
    tags = good.groupBy("row").agg(F.array_sort(F.collect_set("score")).alias("tags"))
    # a negative score has no window
    tags = tags.withColumn("tags", F.filter("tags", lambda s: s >= 0)).where(F.size("tags") > 0)
    windows = tags.withColumns({"lows": F.transform("tags", lambda s: part(s, low, F.ceil)), "highs": F.transform("tags", lambda s: part(s, high, F.floor))})
    bad = best_in_windows(blocks, asked.join(windows, "row"), chosen, False, negatives, group, share)
    bad = bad.select("row", F.col("tag").alias("score"), F.col("place").cast("int").alias("rank"), F.col("found").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = asked.select("row", F.col("vec_id").alias("anchor_id"))
    return good.join(ids, "row").join(bad, ["row", "score"]).select("anchor_id", F.col("found").alias("positive_id"), "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding, with the label of every seventh moved on; see `mine`."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


SQL = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) QUALIFY row_number() OVER w <= 3"""
