"""Document fingerprints from locally consistent parsing with deterministic coin tossing."""

from __future__ import annotations

import hashlib
import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, mapped, ship, strings, table, whole

#: Rounds of parsing; phrases of round r are about 3 ** r bytes long. Names from round FIRST on are kept.
ROUNDS, FIRST = 6, 2
#: Slots of a fingerprint, each with the 16 bits of its least name; 0 is an empty slot.
SLOTS = 128
#: Characters that are parsed together, in whole-array steps of some hundred bytes a character.
CHUNK = 250_000
_SEP = 0xFF  # never a byte of UTF-8


def _toss(a: int, b: int) -> int:
    """Where two different symbols first differ, and the bit of the second there."""
    low = ((a ^ b) & -(a ^ b)).bit_length() - 1
    return 2 * low + (b >> low & 1)


def _toss_table(size: int) -> np.ndarray:
    return np.array([_toss(a, b) if a != b else 0 for a in range(size) for b in range(size)], np.uint8).reshape(size, size)


_BYTES, _FOUR, _SEVEN = _toss_table(256), _toss_table(16), _toss_table(128)
_ODD = np.random.default_rng(11).integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_NAMES = _mix(np.arange(1, 257, dtype=np.uint64))
_SEP_NAME = np.uint64(0)


def _again(label: np.ndarray, toss: np.ndarray, walls: np.ndarray) -> np.ndarray:
    """One more round of tossing: each label against its left neighbour. Walls between texts stay 0."""
    out = np.empty_like(label)
    out[1:] = toss[label[:-1], label[1:]]
    out[walls] = 0
    return out


def _phrases(label: np.ndarray, wall: np.ndarray) -> np.ndarray:
    """Where phrases begin: at local maxima of the labels, at walls and after them."""
    begin = wall.copy()
    begin[0] = True
    begin[1:] |= wall[:-1]
    begin[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:])
    return np.flatnonzero(begin)


def _named(name: np.ndarray, length: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The name of each phrase: a hash of its symbols' names and run lengths in order."""
    inside = np.arange(len(name)) - np.repeat(at, np.diff(np.append(at, len(name))))
    value = (name + length * np.uint64(0x9E3779B97F4A7C15)) * _ODD[inside & 63]
    value ^= value >> np.uint64(29)
    return _mix(np.add.reduceat(value, at))


def names(texts: list[str], rounds: int = ROUNDS, first: int = FIRST) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text number, phrase name) arrays, one pair for each round from `first` on. Texts must not be empty.

    Each round merges runs of equal symbols, labels every symbol by tossing coins with its left neighbour
    until few labels are left (neighbours stay different), and starts phrases at local maxima. So a boundary
    depends on a few neighbours only, and equal substrings get equal phrases away from their ends.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    byte = np.frombuffer(b"\xff" + b"\xff".join(raw) + b"\xff", np.uint8)
    keep = np.concatenate(([True], byte[1:] != byte[:-1]))
    at = np.flatnonzero(keep)
    symbol, length = byte[at], np.diff(np.append(at, len(byte))).astype(np.uint64)
    wall = symbol == _SEP
    walls = np.flatnonzero(wall)
    label = _again(_again(_again(symbol, _BYTES, walls), _FOUR, walls), _FOUR, walls)
    start = _phrases(label, wall)
    name = _named(_BYTE_NAMES[symbol], length, start)
    wall = wall[start]
    name[wall] = _SEP_NAME
    out = []
    for r in range(1, rounds + 1):
        if r >= first:
            doc = np.cumsum(wall) - 1
            out.append((doc[~wall], name[~wall] ^ np.uint64(r)))
        if r == rounds:
            break
        keep = np.concatenate(([True], name[1:] != name[:-1]))
        at = np.flatnonzero(keep)
        length, name, wall = np.diff(np.append(at, len(name))).astype(np.uint64), name[at], wall[at]
        x = name[1:] ^ name[:-1]
        low = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1))
        label = np.zeros(len(name), np.uint8)
        label[1:] = 2 * low + ((name[1:] >> low.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
        walls = np.flatnonzero(wall)
        label[walls] = 0
        label = _again(_again(_again(label, _SEVEN, walls), _FOUR, walls), _FOUR, walls)
        start = _phrases(label, wall)
        named = _named(name, length, start)
        wall = wall[start]
        named[wall] = _SEP_NAME
        name = named
    return out


def sketches(texts: list[str], slots: int = SLOTS, rounds: int = ROUNDS, first: int = FIRST) -> np.ndarray:
    """(texts x slots) of 16 bits: in each slot the least name that falls there, 0 if none. Empty text: all 0."""
    out = np.zeros((len(texts), slots), np.uint16)
    full = [i for i, t in enumerate(texts) if t]
    for part in chunks([texts[i] for i in full], CHUNK):
        own = full[part]
        found = names([texts[i] for i in own], rounds, first)
        doc, name = np.concatenate([d for d, _ in found]), _mix(np.concatenate([n for _, n in found]))
        cell = doc * slots + (name % np.uint64(slots)).astype(np.int64)
        least = np.full(len(own) * slots, np.iinfo(np.uint64).max)
        np.minimum.at(least, cell, name >> np.uint64(8))
        value = (least % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        value[least == np.iinfo(np.uint64).max] = 0
        out[own] = value.reshape(-1, slots)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots among those that either fingerprint fills: an estimate of the names' Jaccard similarity.

    1 for two empty texts, 0 for one.
    """
    used = ((a > 0) | (b > 0)).sum(axis=-1)
    same = ((a == b) & (a > 0)).sum(axis=-1)
    return np.where(used > 0, same / np.maximum(used, 1), 1.0)


def as_text(sketch: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in sketch]


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches sorted by range, then doc_id; each range ends with the first row of the next (`extra`)."""
    held: tuple | None = None

    def done(rows: list[tuple]) -> pd.DataFrame:
        texts = [r[1] for r in rows]
        nexts = [r[2] for r in rows]
        edited = []
        for t, x in zip(texts, nexts, strict=True):
            k = len(t) // 4
            edited.append(t[: len(t) - k] + x[:k])
        own, changed = sketches(texts), sketches(edited)
        # a row's next document is mostly the next row; where a range ends it is an extra row
        tail = sketches([rows[-1][2]])
        after = np.concatenate((own[1:], tail))
        loose = [i for i in range(len(rows) - 1) if rows[i][2] is not texts[i + 1]]
        if loose:
            after[loose] = sketches([nexts[i] for i in loose])
        return pd.DataFrame({
            "doc_id": pd.array([r[0] for r in rows], "Int64"), "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
            "fingerprint": as_text(own), "edited_fingerprint": as_text(changed), "near_edited": likeness(own, changed), "near_next": likeness(own, after),
        })

    for b in batches:
        rows, size = [], 0
        for part, doc, text, extra in zip(b["part"].tolist(), b["doc_id"].tolist(), strings(b["text"]), b["extra"].tolist(), strict=True):
            if held is not None and held[0] == part:
                rows.append((held[1], held[2], text))
                size += len(held[2])
                if size > 1_000_000:
                    yield done(rows)
                    rows, size = [], 0
            held = None if extra else (part, whole(doc), text)
        if rows:
            yield done(rows)


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every document of `docs` (doc_id, text), of its edited text, and their likeness.

    Edited: the last quarter (rounded down) of the code points gives way to the first as many of the next
    document by doc_id (after the last: the first; of one document alone: itself). Rows with one doc_id follow
    each other by a hash of their text, then the text; a null doc_id comes first; null text is empty. A very long
    text is parsed whole, alone. Repeated rows each have their row. Empty table: no rows. Other columns are not read.

    Texts move once, into ranges of doc_id of about the same number of bytes: fine ranges by approximate quantiles,
    a doc_id that fills several of them split by the hash, then neighbours joined. Only the first row of each range
    (a bounded number) is also sent to the range before.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    parts = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    fine = 2 * parts
    probes = [(i + 1) / fine for i in range(fine - 1)]
    seen = docs.agg(F.percentile_approx("doc_id", F.lit(probes), F.lit(20 * fine)).alias("bounds"), F.avg(F.col("doc_id").isNull().cast("double")).alias("nulls")).first()
    if seen["nulls"] is None:
        return spark.createDataFrame([], SCHEMA)
    docs = docs.withColumn("fine", _range_of(seen["bounds"] or [], math.ceil(seen["nulls"] * fine)))
    sizes = sorted(docs.groupBy("fine").agg(F.sum(F.octet_length("text") + F.lit(1)).alias("bytes")).collect())  # a row a fine range
    total, at, coarse = sum(r["bytes"] for r in sizes), 0, [0] * (sizes[-1]["fine"] + 1)
    for r in sizes:
        coarse[r["fine"]] = at * parts // total
        at += r["bytes"]
    docs = docs.withColumn("part", F.get(F.lit(coarse), F.col("fine"))).drop("fine")
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("there"), "doc_id", "hash")).alias("x")
    firsts = sorted(((r["part"], r["x"]["doc_id"], r["x"]["hash"]) for r in docs.groupBy("part").agg(first).collect()), key=lambda r: r[0])  # a row a range
    # each range's first row and the range before it (the last one's for the first); as many rows as ranges
    lead = spark.createDataFrame([(p, d, h, firsts[i - 1][0]) for i, (p, d, h) in enumerate(firsts)], "own int, lead long, lead_hash long, before int")
    of = (F.col("part") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("lead")) & (F.col("hash") == F.col("lead_hash"))
    leads = docs.join(F.broadcast(lead), of).groupBy("before", "doc_id", "hash").agg(F.min("text").alias("text"))
    rows = docs.select("part", "doc_id", "hash", "text", F.lit(False).alias("extra")).unionByName(leads.select(F.col("before").alias("part"), "doc_id", "hash", "text", F.lit(True).alias("extra")))
    ordered = rows.repartition("part").sortWithinPartitions("part", "extra", F.col("doc_id").asc_nulls_first(), "hash", "text")
    return mapped(ordered.select("part", "doc_id", "text", "extra"), _rows, SCHEMA)


def _range_of(bounds: list[int], nulls: int) -> Column:
    """The number of a row's range among those between the bounds, in order of (doc_id, hash).

    Nulls fill the first `nulls` ranges; a doc_id that is a bound several times has as many of its own. The bound at
    or above a doc_id is looked up among every k-th of the different bounds, then among k.
    """
    def sub(of: Column) -> Column:
        """Which of `of` equal ranges of the hash."""
        return F.floor((F.shiftright("hash", 32).cast("double") + 2.0**31) / 2.0**32 * of).cast("int")

    null = sub(F.lit(max(nulls, 1)))
    if not bounds:
        return null
    many = Counter(bounds)
    own = sorted(many)
    room = [many[b] if many[b] > 1 else 0 for b in own]
    start = [nulls + i + sum_ for i, sum_ in enumerate(itertools.accumulate([0, *room]))]
    k = max(1, int(len(own) ** 0.5))
    below = lambda x: x < F.col("doc_id")
    coarse = F.size(F.filter(F.lit(own[k - 1 :: k]), below))
    at = coarse * k + F.size(F.filter(F.get(F.lit([own[i : i + k] for i in range(0, len(own) + k, k)]), coarse), below))
    hot = F.when(F.get(F.lit(own), at) == F.col("doc_id"), F.get(F.lit(room), at)).otherwise(0)
    inside = F.when(hot > 0, 1 + sub(hot)).otherwise(0)
    return F.when(F.col("doc_id").isNull(), null).otherwise(F.get(F.lit(start), at) + inside)


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents; see `fingerprints`."""
    return fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))
