"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosines, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, forest, mapped, runs, ship, table

COSINE = 0.9
#: Share of pairs at exactly the cosine asked for that may share no bucket.
MISS = 0.001
#: Strangers that a bucket holds on average, at most: the number of signs of a table follows from it and from n.
STRANGERS = 64
#: Vectors of one bucket that one task compares; fuller buckets are compared block by block.
BLOCK = 512
#: Signs by which members of a bucket are compared before any vector moves.
SKETCH = 192
SEED = 7


#: Vectors that can link, as SQL; never null.
VALID = "coalesce(embedding is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('inf')) and exists(embedding, x -> x != 0), false)"


def plan(n: int, cosine: float = COSINE) -> tuple[int, int]:
    """(signs of a table, tables) for n vectors: as many tables as MISS asks for."""
    bits = min(40, max(6, math.ceil(math.log2(max(n, 1) / STRANGERS))))
    same = 1 - math.acos(cosine) / math.pi
    return bits, math.ceil(math.log(MISS) / math.log1p(-(same**bits)))


def sketch_limit(cosine: float = COSINE) -> int:
    """Sketches of vectors at the cosine differ in more signs once in 100,000 pairs."""
    q = math.acos(cosine) / math.pi
    return math.ceil(SKETCH * q + 4.3 * math.sqrt(SKETCH * q * (1 - q)))


@lru_cache(maxsize=8)
def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, SKETCH + bits * tables))


def _unit(raw: np.ndarray) -> np.ndarray | None:
    """The vector at length one, in double precision whatever its scale; None if there is none."""
    if not np.isfinite(raw).all() or not raw.any():
        return None
    v = raw.astype(np.float64)
    v /= np.abs(v).max()
    return v / np.sqrt(np.square(v).sum())


def _coder(bits: int, tables: int):
    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            out = []
            for node, n, v in zip(b["node"].tolist(), b["copies"].tolist(), b["embedding"], strict=True):
                if v is None or not len(v) or (unit := _unit(v := np.array([np.nan if x is None else x for x in v], v.dtype if v.dtype.kind == "f" else np.float64))) is None:
                    continue
                sign = unit @ planes(len(v), bits, tables) > 0
                keys = ((len(v) * tables + np.arange(tables)) << bits) + (sign[SKETCH:].reshape(tables, bits) * weight).sum(axis=1)
                out.append((node, n, v.itemsize, v.astype(v.dtype.newbyteorder("<")).tobytes(), np.packbits(sign[:SKETCH]).tobytes(), keys))
            yield pd.DataFrame(out, columns=["node", "copies", "width", "raw", "sketch", "keys"])

    return code


def _cells(b: pd.DataFrame) -> Iterator[tuple[int, int, int, int]]:
    """(begin, length, low block, high block) of each cell of two or more rows."""
    key, low, high = (b[c].to_numpy() for c in ("key", "low", "high"))
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
    first = np.append(np.flatnonzero(new), len(b))
    size = np.diff(first)
    for s, n in zip(first[:-1][size > 1].tolist(), size[size > 1].tolist(), strict=True):
        yield s, n, int(low[s]), int(high[s])


def _partners(limit: int):
    """Of each cell the rows whose sketch is within `limit` signs of another's: strangers' vectors need not move."""

    def partners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in runs(batches, ["key", "low", "high"]):
            keep, block = np.zeros(len(b), bool), b["block"].to_numpy()
            sketch = np.frombuffer(b"".join(b["sketch"]), np.uint64).reshape(len(b), -1)
            for s, n, low, high in _cells(b):
                v, own = sketch[s : s + n], block[s : s + n]
                for i in range(0, n, 256):
                    near = np.zeros((len(v[i : i + 256]), n), np.int64)
                    for w in range(v.shape[1]):
                        near += np.bitwise_count(v[i : i + 256, w, None] ^ v[None, :, w])
                    near = near <= limit
                    near[np.arange(len(near)), i + np.arange(len(near))] = False
                    if low != high:
                        near &= own[i : i + 256, None] != own[None, :]
                    keep[s + i : s + i + len(near)] = near.any(axis=1)
            yield b.loc[keep, ["key", "low", "high", "block", "node"]]

    return partners


def _compare(cosine: float, bits: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in runs(batches, ["key", "low", "high"]):
            key, block, node, copies = (b[c].to_numpy() for c in ("key", "block", "node", "copies"))
            raw, width, keys = b["raw"].tolist(), b["width"].tolist(), b["keys"].tolist()
            left, right = [], []
            for s, n, low, high in _cells(b):
                v = np.array([_unit(np.frombuffer(raw[k], f"<f{width[k]}")) for k in range(s, s + n)])
                i, j = np.nonzero(np.triu(v @ v.T >= cosine, 1))
                if low != high:
                    other = block[s + i] != block[s + j]
                    i, j = i[other], j[other]
                if not len(i):
                    continue
                c = np.array(keys[s : s + n])
                # a pair counts in the first table where its keys agree
                for k in range(0, len(i), 20_000):
                    a, d = i[k : k + 20_000], j[k : k + 20_000]
                    mine = c[a, (c[a] == c[d]).argmax(axis=1)] == key[s]
                    left.append(s + a[mine])
                    right.append(s + d[mine])
            if not left:
                continue
            a, d = np.concatenate(left), np.concatenate(right)
            links = np.bincount(a, copies[d], len(b)) + np.bincount(d, copies[a], len(b))
            at = np.flatnonzero(links)
            tree = forest(node[a].tolist(), node[d].tolist())
            yield pd.DataFrame({"a": np.concatenate((node[at], [x for x, _ in tree])).astype("int64"), "b": pd.array([None] * len(at) + [y for _, y in tree], "Int64"), "n": np.concatenate((links[at], np.zeros(len(tree)))).astype("int64")})

    return compare


def near_vectors(vectors: DataFrame, cosine: float = COSINE, bits: int | None = None, tables: int | None = None, block: int = BLOCK) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Rows link at a cosine of at least `cosine`, computed exactly in double precision for pairs that share a
    bucket in some table; no pair below is linked. Signs and tables follow from the number of different vectors
    (`plan`), so that a bucket holds few strangers at any size and one pair of a thousand at the very cosine is
    missed, fewer above it. Equal vectors are one node with a count, so a group of copies costs one comparison.

    Tables move as rows of key, node and a sketch of 192 signs. In each bucket sketches pick the nodes that have a
    partner there; only for them vectors move, as wide as they came. Buckets are counted first; one with over
    `block` nodes is dealt to tasks as pairs of blocks, all of them compared. A task gives link counts and a
    spanning forest, never pairs; a pair that meets in several tables counts once.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing: 0 links, own
    component. Vectors of different lengths do not link; very long vectors are compared whole. A null vec_id keeps
    its row, links with nothing and has a null component. Rows with one vec_id but different vectors are one member
    of a component. Empty table: no rows. Other columns are not read.
    """
    ship(vectors.sparkSession)
    rows = vectors.select("vec_id", "embedding", F.expr(f"vec_id is not null and {VALID}").alias("valid"))
    # equal vectors have equal digests of 128 bits, which move in their place
    known = rows.where("valid").select("vec_id", "embedding", F.struct(F.xxhash64("embedding").alias("x"), F.xxhash64(F.lit(1), "embedding").alias("y")).alias("digest"))
    same = cut(known.groupBy("digest").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")), few=True)
    if bits is None or tables is None:
        bits, tables = plan(same.count(), cosine)
    coded = cut(mapped(same, _coder(bits, tables), "node long, copies long, width int, raw binary, sketch binary, keys array<long>"), few=True)
    slots = coded.select("node", "sketch", F.explode("keys").alias("key"))
    hot = (
        slots.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
        .select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    parts = slots.join(hot, "key").groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("key", "blocks"))).alias("parts"))
    dealt = (
        coded.select("node", "sketch", "keys").join(parts, "node", "left").withColumn("key", F.explode("keys"))
        .withColumn("blocks", F.coalesce(F.expr("parts[key]"), F.lit(1))).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "node", "sketch")
    )
    cells = lambda df: df.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    near = mapped(cells(dealt), _partners(sketch_limit(cosine)), "key long, low int, high int, block int, node long")
    full = near.join(coded.select("node", "copies", "width", "raw", "keys"), "node")
    found = cut(mapped(cells(full), _compare(cosine, bits), "a long, b long, n long"))
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("far"))
    spread = known.groupBy("vec_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x != y").select("vec_id")
    tied = known.select("vec_id", "digest").join(spread, "vec_id", "left_semi").join(same.select("digest", "node"), "digest").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    of = components(found.where("b is not null").select("a", "b").unionByName(tied)).withColumnRenamed("node", "member")
    named = same.select("digest", "node", "copies").join(links, "node", "left").join(of, F.col("node") == F.col("member"), "left").select(
        "digest", (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("links"), F.coalesce("root", "node").alias("component")
    )
    linked = known.select("vec_id", "digest").join(named, "digest").select("vec_id", F.col("links").cast("long").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and components of all embeddings; see `near_vectors`."""
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
