"""SimHash near-dedup at a similarity: fingerprints under covering masks and MinHash bands find candidates, whole sets decide.

A radius that covering masks can afford (3 of 64 bits) reaches pairs of about 0.98 only; at a Jaccard similarity of
0.8 fingerprints differ in up to 14 bits, which would ask for 2 ** 15 masks. So the masks keep their guarantee for
what lies within the radius, and bands of least hashes find the rest. Texts that share a passage meet in bands, too;
sketches of two bits of each least hash part them there, so only texts that are alike as wholes form groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, cut, forest, mapped, runs, ship, strings
from .simhash import RADIUS, majority, near_links

WORDS, LEAST = 5, 0.8
#: A pair of similarity s shares no band with probability (1 - s ** ROWS) ** BANDS: 8.5e-7 at 0.8. A pair of
#: similarity 0.3 shares one with probability 0.03.
BANDS, ROWS = 46, 6
#: Chance that the sketches of a pair of exactly the least similarity differ so often that the pair is not compared.
MISS = 1e-9
#: Sketches of one band's bucket that are compared at once; what is more is dealt out as pairs of blocks.
CELL = 2048
#: Members of a candidate group that are compared at once; larger groups are dealt out as pairs of blocks.
BLOCK = 256
#: Tasks that share the rows of one bucket.
SALT = 16
SEED = 42
_KEYS = np.random.default_rng(7).integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct XXH64 of all shingles of `words` words; of a shorter text the whole, of none nothing."""
    ws = text.encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return np.zeros(0, np.uint64)
    buf, digest = b" ".join(ws), xxhash.xxh64_intdigest
    if len(ws) <= words:
        return np.array([digest(buf, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.unique(np.array([digest(buf[a:b], SEED) for a, b in zip(starts[: len(ws) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)], np.uint64))


def least_hashes(h: np.ndarray) -> np.ndarray:
    """The least values of the shingles `h` under BANDS * ROWS hash functions."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(h), 512):
        np.minimum(least, ((h[at : at + 512, None] ^ _KEYS[0]) * _KEYS[1]).min(axis=0), out=least)
    return least


def bands(least: np.ndarray) -> list[int]:
    """One number for each band: a hash of its number and its least values."""
    raw = least.tobytes()
    return [xxhash.xxh64_intdigest(raw[8 * ROWS * k : 8 * ROWS * (k + 1)], k) - (1 << 63) for k in range(BANDS)]


_WORDS = -(-BANDS * ROWS // 64)


def sketch(least: np.ndarray) -> bytes:
    """Two middle bits of each least value: all first bits, then all second bits, each filled up to whole words."""
    bits = np.zeros((2, 64 * _WORDS), np.uint8)
    for k in range(2):
        bits[k, : len(least)] = (least >> np.uint64(32 + k)) & np.uint64(1)
    return np.packbits(bits, axis=1).tobytes()


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many least values differ in the sketches `a` and `b` (words last; the other axes are broadcast)."""
    out = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]), np.int16)
    for w in range(_WORDS):
        out += np.bitwise_count((a[..., w] ^ b[..., w]) | (a[..., w + _WORDS] ^ b[..., w + _WORDS]))
    return out


def sketch_limit(least: float = LEAST, miss: float = MISS) -> int:
    """The fewest differences that a pair of similarity `least` exceeds with probability `miss` at most.

    Least values differ with probability 1 - least, and then in two bits with probability 3 / 4.
    """
    n, p, tail = BANDS * ROWS, 0.75 * (1 - least), 1.0
    for d in range(n + 1):
        tail -= math.comb(n, d) * p**d * (1 - p) ** (n - d)
        if tail <= miss:
            return d
    return n


def _signatures(words: int):
    def signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingles(t, words) for t in strings(b["text"])]
            fp = np.array([majority(s) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            least = [least_hashes(s) for s in sets]
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "row": b["row"], "key": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "fp": fp,
                "bands": [bands(x) if len(s) else [] for x, s in zip(least, sets, strict=True)], "sketch": [sketch(x) for x in least],
            })

    return signatures


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray] | None = None, least: float = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Places in `left` and `right` (or twice in `left`) of all pairs of sets with Jaccard similarity >= `least`, exact."""
    sets = left + (right or [])
    size = np.array([len(s) for s in sets], np.int64)
    n = len(left)
    _, name, times = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    shared = times[name] > 1
    place = np.cumsum(times > 1) - 1
    name, owner = place[name[shared]], owner[shared]
    order = np.argsort(name, kind="stable")
    name, owner = name[order], owner[order]
    a, b = (slice(0, n), slice(n, None)) if right is not None else (slice(None), slice(None))
    both = np.zeros((len(size[a]), len(size[b])), np.int64)
    step = 4096
    for low in range(0, int(name[-1]) + 1 if len(name) else 0, step):
        x, y = np.searchsorted(name, (low, low + step))
        m = np.zeros((len(sets), step), np.float32)
        m[owner[x:y], name[x:y] - low] = 1
        both += np.rint(m[a] @ m[b].T).astype(np.int64)
    union = size[a][:, None] + size[b][None, :] - both
    i, j = np.nonzero((both >= least * union - 1e-9) & (both > 0))
    return (i, j) if right is not None else (i[i < j], j[i < j])


def _links(words: int, least: float):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in runs(batches, ["root", "i", "j"]):
            out: list[tuple[int, int]] = []
            for (_, i, j), g in b.groupby(["root", "i", "j"], sort=False):
                node, sets = g["node"].to_numpy(), [shingles(t, words) for t in strings(g["text"])]
                if i == j:
                    x, y = similar_pairs(sets, None, least)
                    one, two = node[x], node[y]
                else:
                    own = (g["block"] == i).to_numpy()
                    first, second = np.flatnonzero(own), np.flatnonzero(~own)
                    x, y = similar_pairs([sets[k] for k in first], [sets[k] for k in second], least)
                    one, two = node[first[x]], node[second[y]]
                out += forest(one.tolist(), two.tolist())
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return links


def _words(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(len(column), 2 * _WORDS)


def _close(limit: int):
    """Whether each row's sketch is close to that of its bucket's head."""

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            near = differing(_words(b["sketch"]), _words(b["lead"])) <= limit
            yield b[["value", "salt", "head", "node", "sketch"]].assign(close=near)

    return close


def _near(limit: int):
    """Of each cell a spanning forest of the pairs with close sketches; of two blocks only pairs across."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in runs(batches, ["value", "low", "high"]):
            value, low, high, block, node = (b[c].to_numpy() for c in ("value", "low", "high", "block", "node"))
            words = _words(b["sketch"])
            new = np.concatenate(([True], (value[1:] != value[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
            ends = np.append(np.flatnonzero(new), len(b))
            one, two = [], []
            for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                label = np.arange(s, e)
                first = np.flatnonzero(block[s:e] == low[s])
                second = np.flatnonzero(block[s:e] == high[s])
                for at in range(0, len(first), 256):
                    rows = first[at : at + 256]
                    alike = differing(words[s + rows][:, None], words[s + second][None]) <= limit
                    for i, r in enumerate(rows.tolist()):
                        joined = np.unique(np.append(label[second[alike[i]]], label[r]))
                        if len(joined) > 1:
                            label[np.isin(label, joined)] = joined[0]
                far = np.flatnonzero(label != np.arange(s, e))
                one.append(node[s + far])
                two.append(node[label[far]])
            yield pd.DataFrame({"a": np.concatenate(one), "b": np.concatenate(two)}, dtype="int64")

    return near


def _salted(buckets: DataFrame) -> DataFrame:
    return buckets.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))


def _banded(nodes: DataFrame, limit: int, cell: int) -> DataFrame:
    """Edges (a, b) that connect the nodes (node, bands, sketch) with a common band and close sketches, and no others.

    Bands that gather the same nodes count once. In each bucket all sketches meet that of its smallest node, its head.
    Rows close to it are connected by that; the others then meet each other and those rows, dealt out as pairs of
    blocks of `cell` sketches. So a large group of copies costs one comparison a row, and rows that only share a
    passage cost sketches of 80 bytes, never texts.
    """
    rows = nodes.select("node", F.explode("bands").alias("value")).withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALT)))
    gathered = rows.groupBy("value").agg(F.min("node").alias("head"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("members"))
    buckets = gathered.where("n > 1").groupBy("head", "n", "members").agg(F.min("value").alias("value"))
    sketches = nodes.select("node", "sketch")
    heads = buckets.join(sketches.toDF("head", "lead"), "head").select("value", "head", "lead")
    met = rows.join(_salted(heads), ["value", "salt"]).join(sketches, "node").select("value", "salt", "head", "node", "sketch", "lead")
    met = cut(mapped(met, _close(limit), "value long, salt long, head long, node long, sketch binary, close boolean"), few=True)
    rest = met.groupBy("value").agg(F.count_if(~F.col("close")).alias("far"), F.count_if("close").alias("near")).where("far > 0 and far + near > 2")
    rest = rest.select("value", F.ceil(F.col("far") / cell).alias("far"), F.ceil(F.col("near") / cell).alias("near"))
    dealt = (
        met.join(_salted(rest), ["value", "salt"])
        .withColumn("block", F.expr("if(close, far + pmod(xxhash64(node), near), pmod(xxhash64(node), far))"))
        .withColumn("other", F.explode(F.expr("sequence(0L, if(close, far, far + near) - 1)")))
        .select("value", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "sketch")
    )
    cells = dealt.repartition("value", "low", "high").sortWithinPartitions("value", "low", "high")
    return met.where("close").select(F.col("node").alias("a"), F.col("head").alias("b")).unionByName(mapped(cells, _near(limit), "a long, b long"))


def _candidates(nodes: DataFrame, least: float = LEAST, cell: int = CELL) -> DataFrame:
    """Edges (a, b) whose components hold every pair of nodes with a common band and close sketches, or with fingerprints
    within RADIUS bits."""
    full = nodes.where("size(bands) > 0")
    first = cut(full.groupBy("fp").agg(F.min("node").alias("node")), few=True)
    equal = full.join(first.withColumnRenamed("node", "head"), "fp").select(F.col("node").alias("a"), F.col("head").alias("b"))
    return _banded(full, sketch_limit(least), cell).unionByName(equal).where("a != b").unionByName(near_links(first))


def _row_hash(docs: DataFrame) -> Column:
    """A hash of a whole row; rows with one doc_id and one hash count as equal."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def _classes(docs: DataFrame, words: int, least: float, block: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, key of its set of shingles) for each row, and (key, root) for each different set."""
    ship(docs.sparkSession)
    slim = docs.select("doc_id", "text", _row_hash(docs).alias("row")).where("doc_id is not null")
    marked = cut(mapped(slim, _signatures(words), "doc_id long, row long, key binary, fp long, bands array<long>, sketch binary"))
    # numbered once, in what is written: the smallest row stands for its set
    first = F.min(F.struct("doc_id", "row"))
    nodes = cut(marked.groupBy("key").agg(first.alias("first"), F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")).withColumn("node", F.monotonically_increasing_id()), few=True)
    groups = cut(components(_candidates(nodes, least)), few=True)
    members = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    blocks = members.groupBy("root").agg(F.ceil(F.count("*") / block).alias("blocks"))
    members = members.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    again = marked.groupBy("doc_id", "row").agg(F.count("*").alias("times")).where("times > 1")
    members = cut(members.join(nodes.select("node", "first.doc_id", "first.row"), "node").join(again, ["doc_id", "row"], "left"), few=True)
    texts = lambda those: slim.join(those, ["doc_id", "row"]).select("root", "node", "block", "blocks", "text")
    # of a row that is there several times one text goes on
    cells = texts(members.where("times is null")).unionByName(texts(members.where("times > 1")).groupBy("root", "node", "block", "blocks").agg(F.first("text").alias("text")))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "text")
    links = mapped(cells.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j"), _links(words, least), "a long, b long")
    of = components(links).withColumnRenamed("node", "member")
    named = nodes.join(of, F.col("node") == F.col("member"), "left").select("key", F.coalesce("root", "node").alias("root"))
    return marked.select("doc_id", "row", "key"), named


def near_duplicates(docs: DataFrame, words: int = WORDS, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """doc_id, component_id of the rows of `docs` (doc_id, text) that have a doc_id.

    component_id is the smallest doc_id that links of a Jaccard similarity of at least `least` reach. Equal sets of
    shingles are one node. Nodes that share a band and have close sketches, or whose fingerprints differ in at most
    RADIUS bits, are joined to candidate groups, in which whole sets are compared: every pair within a group, in blocks
    if it is large, so a link is never estimated. Texts that share a passage only form no group. Null and empty texts are alike; texts are read whole. Rows with the same doc_id but
    different texts are members of their own. Empty table: no rows. Other columns are not read but for ties.
    """
    marked, named = _classes(docs, words, least, block)
    rows = marked.join(named, "key")
    least_id = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least_id, "root").select("doc_id", "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """`docs` with one row of each class of `near_duplicates`: that of the smallest doc_id, then of the smallest hash
    of the whole row. Rows without a doc_id all stay."""
    marked, named = _classes(docs, words, least, block)
    times = marked.groupBy("key", "doc_id", "row").agg(F.count("*").alias("times"))
    kept = times.join(named, "key").groupBy("root").agg(F.min(F.struct("doc_id", "row", "times")).alias("x")).select("x.*")
    kept = cut(kept.withColumnRenamed("doc_id", "_id").withColumnRenamed("row", "_row"), few=True)
    hashed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col("doc_id").alias("_id"), _row_hash(docs).alias("_row"))
    once = hashed.join(kept.where("times = 1"), ["_id", "_row"], "left_semi").select("whole")
    # of rows that are equal in all columns one stays
    equal = hashed.join(kept.where("times > 1"), ["_id", "_row"], "left_semi").groupBy("_id", "_row").agg(F.first("whole").alias("whole")).select("whole")
    return once.unionByName(equal).select("whole.*").unionByName(docs.where("doc_id is null"))
