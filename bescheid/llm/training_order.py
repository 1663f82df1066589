"""Token-id shards in training order: a keyed Feistel permutation with cycle-walking gives every sequence its slot."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mapped, shared_dir, ship, strings, table, whole

#: Ids of one sequence; a document's last sequence is padded with zeros.
LENGTH = 256
#: Bytes of text for one shard, roughly. A reader takes a shard whole, so at most some 100 MB.
SHARD_BYTES = 4 << 20
ROUNDS = 6
#: Records that a worker hands over at once.
ROWS = 4000
KEY = 2024
#: doc_id, number of the sequence in its document, ids used.
HEAD = "<qii"
HEAD_SIZE = struct.calcsize(HEAD)
NO_ID = -(1 << 63)
#: Indexes are below this.
SPACE = 1 << 62
#: Shards whose starts one task adds up.
RUN = 1024

_held: dict[str, object] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def permute(index: np.ndarray, size: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """A keyed bijection of 0 .. size - 1, or its inverse.

    A balanced Feistel network permutes the next even power of two; values that leave the range walk on along
    their cycle until they return, which takes under four steps on average.
    """
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = np.array(index, np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        if back:
            for k in keys[::-1]:
                left, right = right ^ (_mix(left + k) & mask), left
        else:
            for k in keys:
                left, right = right, left ^ (_mix(right + k) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def _tokenizer(path: str):
    if path not in _held:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _held[path] = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _held[path]


def end_id(path: str) -> int:
    """The id after the vocabulary's last."""
    return _tokenizer(path).max_token_value + 1


def width_of(path: str) -> int:
    """Bytes of an id: two where all ids fit."""
    return 2 if end_id(path) < 1 << 16 else 4


def stride(length: int, width: int = 2) -> int:
    """Bytes of one record: head, ids of `width` bytes, and the line end that Spark's text writer adds."""
    return HEAD_SIZE + width * length + 1


def _records(path: str, length: int, rooms: int, shards: int, key: int):
    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end, width = _tokenizer(path).encode_ordinary, end_id(path), width_of(path)
        size = width * length
        numbers = SPACE // rooms
        total = numbers * rooms
        index: list[int] = []
        record: list[bytes] = []

        def flush() -> pd.DataFrame:
            place = permute(np.array(index, np.uint64), total, key)
            out = pd.DataFrame({"shard": (place // -(-total // shards)).astype(np.int32), "place": place, "record": record})
            index.clear()
            record.clear()
            return out

        for b in batches:
            for doc, number, text in zip(b["doc_id"].tolist(), b["number"].tolist(), strings(b["text"]), strict=True):
                ids = np.array([*encode(text), end], f"<u{width}").tobytes()
                doc, first = NO_ID if (doc := whole(doc)) is None else doc, number % numbers * rooms
                for n, s in enumerate(range(0, len(ids), size)):
                    part = ids[s : s + size]
                    index.append(first + n)
                    record.append(struct.pack(HEAD, doc, n, len(part) // width) + part.ljust(size, b"\0"))
                if len(record) >= ROWS:
                    yield flush()
            if record:
                yield flush()

    return records


@dataclass(frozen=True)
class Shards:
    """Written shards: part-K files of fixed-stride records, sorted by slot across files and within each."""

    path: str
    length: int
    width: int = 2

    def _files(self, spark: SparkSession) -> DataFrame:
        files = spark.read.format("binaryFile").load(self.path).where("length > 0")
        return files.withColumn("shard", F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int"))

    def read(self, spark: SparkSession, shards: DataFrame | None = None) -> DataFrame:
        """Records of all shards, or of those in the column shard of `shards` alone.

        Columns: doc_id, seq_no, n_tokens, ids (little-endian, `width` bytes each), shard, row in it, byte offset.
        """
        ship(spark)
        files = self._files(spark).select("shard", "content")
        files = files if shards is None else files.join(shards.select("shard").distinct(), "shard", "left_semi")
        return mapped(files, _parser(self.length, self.width), "doc_id long, seq_no int, n_tokens int, ids binary, shard int, row long, byte_offset long")

    def starts(self, spark: SparkSession) -> dict[int, int]:
        """`start_table` on the driver, a row a shard, for a reader of few shards."""
        return {r["shard"]: r["start"] for r in self.start_table(spark).collect()}

    def start_table(self, spark: SparkSession) -> DataFrame:
        """shard, start, records: its first slot, from file sizes alone. Slot s of a shard is record s - start there.

        Sums run in tasks of RUN shards each, then over one row for each such task.
        """
        sizes = self._files(spark).select("shard", F.expr(f"length div {stride(self.length, self.width)}").alias("records")).withColumn("run", F.expr(f"shard div {RUN}"))
        before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
        bases = sizes.groupBy("run").agg(F.sum("records").alias("n")).select("run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
        inside = Window.partitionBy("run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        return sizes.join(bases, "run").select("shard", (F.col("base") + F.coalesce(F.sum("records").over(inside), F.lit(0))).alias("start"), "records")

    def resume(self, spark: SparkSession, slot: int) -> DataFrame:
        """Records from `slot` on, with their slots; shards before it are not read."""
        starts = self.start_table(spark)
        later = starts.where(F.col("start") + F.col("records") > slot)
        return self.read(spark, later).join(later, "shard").withColumn("slot", F.col("start") + F.col("row")).where(F.col("slot") >= slot).drop("start", "records")


def _parser(length: int, width: int):
    size = stride(length, width)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for shard, content in zip(b["shard"].tolist(), b["content"], strict=True):
                if len(content) % size:
                    raise ValueError(f"shard {shard} ends within a record")
                rows = [(*struct.unpack_from(HEAD, content, s), s) for s in range(0, len(content), size)]
                for k in range(0, len(rows), ROWS):
                    part = rows[k : k + ROWS]
                    yield pd.DataFrame({
                        "doc_id": pd.array([None if r[0] == NO_ID else r[0] for r in part], "Int64"), "seq_no": [r[1] for r in part], "n_tokens": [r[2] for r in part],
                        "ids": [content[r[3] + HEAD_SIZE : r[3] + HEAD_SIZE + width * r[2]] for r in part], "shard": shard, "row": range(k, k + len(part)), "byte_offset": [r[3] for r in part],
                    })

    return parse


def write(docs: DataFrame, path: str, vocabulary: str | None = None, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, key: int = KEY) -> Shards:
    """Write every id of `docs` (doc_id, text) to fixed-stride shards in an order that data and key alone decide.

    A document's ids and an end id are cut into sequences of `length`. A sequence's index is its document's number
    (a 64-bit hash of doc_id and text, reduced to the numbers that fit) times the most sequences that any document
    can have, plus its own number. The permutation moves indexes to places among all of them; a sequence's slot
    is the rank of its place, ties (equal hashes) by the record itself. So a hot doc_id is spread, texts are
    tokenized and moved once, and neither splits nor cluster matter. Shards are equal ranges of places, one task
    each, sorted, and written by Spark's committer wherever Spark can write; slots follow from file sizes, so a
    reader resumes at any slot.

    Null text is empty (an end id alone); a null doc_id is kept as such (the least long stands for it in records);
    rows repeated whole lie side by side; very long texts are many sequences. Empty table: no shards with records.
    Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    width = width_of(vocabulary)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.max(F.octet_length("text")).alias("longest"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    shards, rooms = (1, 1) if size["longest"] is None else (max(1, -(-size["bytes"] // shard_bytes)), size["longest"] // length + 1)  # a token has a byte at least
    made = mapped(rows.withColumn("number", F.xxhash64("doc_id", "text")), _records(vocabulary, length, rooms, shards, key), "shard int, place long, record binary")
    ordered = made.repartitionById(shards, "shard").sortWithinPartitions("place", "record")
    ordered.select(F.col("record").cast("string").alias("value")).write.option("compression", "none").option("lineSep", "\n").text(path)
    return Shards(path, length, width)


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all documents, written to the shared folder and read back: each sequence with its slot and place."""
    base = shared_dir(spark)
    shards = write(table(spark, sf_dir, "documents", "doc_id", "text"), f"{base}/shards")
    # written, so that its size is known when the join is planned
    shards.start_table(spark).write.parquet(f"{base}/starts")
    starts = spark.read.parquet(f"{base}/starts").select("shard", "start")
    return shards.read(spark).join(starts, "shard").select("doc_id", "seq_no", "n_tokens", (F.col("start") + F.col("row")).alias("slot"), "shard", "byte_offset", F.crc32("ids").alias("ids_crc32"))
