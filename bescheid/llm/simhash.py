"""SimHash fingerprints and their links within a Hamming radius by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, forest, mapped, runs, ship, strings, table

RADIUS = 3
WORDS = 3
SEED = 42
#: Distinct fingerprints that one bucket may hold before it is divided by further masks.
BUCKET = 1024
BITS = 64


def simhash(text: str, words: int = WORDS) -> int:
    """64-bit fingerprint: the majority of each bit over the XXH64 of all word shingles, repeats included."""
    ws = text.encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    buf = b" ".join(ws)
    digest = xxhash.xxh64_intdigest
    if len(ws) <= words:
        hashes = [digest(buf, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [digest(buf[a:b], SEED) for a, b in zip(starts[: len(ws) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]
    return majority(np.array(hashes, np.uint64))


_LANES = np.uint64(0x0101010101010101)


def majority(h: np.ndarray) -> int:
    """Bits set in over half of `h`; eight counters to a word, emptied before one can overflow."""
    n = len(h)
    counts = np.zeros(BITS, np.int64)
    pad = -n % 255
    blocks = np.concatenate((h, np.zeros(pad, np.uint64))).reshape(-1, 255)
    for k in range(8):
        sums = ((blocks >> np.uint64(k)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[k::8] = sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def covering(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the given bit positions such that any `radius` positions are all outside some mask.

    Pagh 2016: each position gets a non-zero vector of radius + 1 bits; the mask of v holds the positions
    whose vector has odd product with v. `radius` vectors never span the space, so some v misses them all.
    """
    names = 2 ** (radius + 1)
    vector = {b: i % (names - 1) + 1 for i, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() % 2) for v in range(1, names)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(radius: int) -> list[list[int]]:
    """Level 1: masks over all bits. Level 2 and 3: for each mask so far, masks over the bits that it leaves out."""
    levels = [covering(list(range(BITS)), radius)]
    for _ in range(2):
        levels.append([m | s for m in levels[-1] for s in covering([b for b in range(BITS) if not m >> b & 1], radius)])
    return levels


def _links(radius: int):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in runs(batches, ["mask", "key"]):
            fp = b["fp"].to_numpy().view(np.uint64)
            node, mask, key = (b[c].to_numpy() for c in ("node", "mask", "key"))
            new = np.concatenate(([True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]))) if len(b) else np.zeros(0, bool)
            first = np.flatnonzero(new)
            end = np.repeat(np.append(first[1:], len(b)), np.diff(np.append(first, len(b))))
            at, d = np.arange(len(b)), 1
            found: list[tuple[np.ndarray, np.ndarray]] = []
            while len(at := at[at + d < end[at]]):
                near = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= radius]
                found.append((node[near], node[near + d]))
                d += 1
            pairs = forest(*(np.concatenate(x).tolist() for x in zip(*found, strict=True))) if found else []
            yield pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    return links


def near_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect exactly the rows (fp, node) of distinct fingerprints at most `radius` bits apart.

    Every such pair shares a bucket of some level-1 mask. Buckets are counted first (pre-aggregated); one with
    over `bucket` fingerprints is divided by the masks over its free bits, and again: after the third level
    about eight bits are free, so a bucket has a few hundred fingerprints whatever the input. No pair is lost,
    no bucket is unbounded, and a bucket gives a spanning forest of its links, not all pairs.
    """
    levels, rows, edges = _masks(radius), None, []
    for level, masks in enumerate(levels):
        if rows is None:
            exploded = fps.select("fp", "node", F.posexplode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask", "m"))
        else:
            per = 2 ** (radius + 1) - 1
            choice = F.lit([_signed(m) for m in masks])
            exploded = rows.select("fp", "node", (F.col("mask") * per).alias("at"), choice.alias("masks")).select(
                "fp", "node", "masks", F.explode(F.sequence(F.col("at"), F.col("at") + (per - 1))).alias("mask")
            ).select("fp", "node", "mask", F.get("masks", "mask").alias("m"))
        rows = exploded.select("mask", F.col("fp").bitwiseAND(F.col("m")).alias("key"), "fp", "node")
        hot = None
        if level + 1 < len(levels):
            hot = cut(rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).drop("n"), few=True)
            hot = None if hot.isEmpty() else hot
        cold = rows if hot is None else rows.join(hot, ["mask", "key"], "left_anti")
        edges.append(mapped(cold.repartition("mask", "key").sortWithinPartitions("mask", "key"), _links(radius), "a long, b long"))
        if hot is None:
            break
        rows = rows.join(hot, ["mask", "key"], "left_semi")
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


def _fingerprints(words: int):
    def fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([simhash(t, words) for t in strings(b["text"])], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "fp": fp})

    return fingerprints


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words: int = WORDS, bucket: int = BUCKET) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, fp (signed 64 bits), component_id.

    component_id is the smallest doc_id that links of at most `radius` differing bits reach. Equal fingerprints
    are one node, so copies cost nothing beyond their own row. Null and empty texts have fingerprint zero and
    link like any other. A null doc_id keeps its row, names no component, and is null if all its equals are.
    Rows with the same doc_id are one member. Empty table: no rows. Other columns are not read.
    """
    ship(docs.sparkSession)
    marked = cut(mapped(docs.select("doc_id", "text"), _fingerprints(words), "doc_id long, fp long"))
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("node")), few=True)
    ids = marked.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("fp"), F.max("fp").alias("other")).where("fp != other")
    links = near_links(nodes.where("node is not null"), radius, bucket)
    # a doc_id with several texts ties their fingerprints together
    same = marked.join(ids.select("doc_id"), "doc_id", "left_semi").join(nodes, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    of = components(links.unionByName(same))
    named = nodes.join(of, nodes["node"] == of["node"], "left").select("fp", F.coalesce("root", nodes["node"]).alias("component_id"))
    return marked.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all documents; see `near_duplicates`."""
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text", deal=True))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
