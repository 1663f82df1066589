"""Packing into fixed windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import mapped, ship, strings, table, whole

WINDOW = 4096
#: A document's rest after whole windows is cut into pieces of at most so many ids.
PIECE = 1024
#: Windows that one differencing fills.
GROUP = 256
END = 2
NUMBERS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
SCHEMA = ", ".join(f"{x} long" for x in ("doc_id", *NUMBERS))
#: Parts of words whose ids one worker keeps.
CACHE = 1_000_000

_held: dict[str, tuple] = {}


#: The vocabulary's splitter for lower-case Latin-1: contractions, letters, single numerals, runs of the rest.
_SPLIT = re.compile("'(?:[stmd]|re|ve|ll)|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")


def _parts(text: str) -> list[str] | None:
    """The splitter's parts, or None for a text that only the library splits right."""
    try:
        text.encode("latin-1")  # there composing changes nothing and lower case is letter by letter
    except UnicodeEncodeError:
        return None
    return None if "<|" in text else _SPLIT.findall(text.lower())


#: The normalizer and splitter that `_parts` follows, as the tokenizers library writes them.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def _in_parts(spec: dict) -> bool:
    """Whether a tokenizer's texts may be encoded part by part: it has the known normalizer and splitter, and added tokens open with "<|"."""
    return spec["normalizer"] == _NORMALIZER and spec["pre_tokenizer"] == _SPLITTER and not spec["model"].get("dropout") and all(t["content"].startswith("<|") for t in spec["added_tokens"])


def encoder(path: str):
    """A function from a list of texts to the little-endian uint32 ids of each, as `tokenizers` gives them.

    Where the file's normalizer and splitter are the known ones, a text is composed, lowered and split here and
    encoded part by part; parts repeat, so their ids are kept in a bounded table. A text beyond Latin-1, or with
    what can open a control word, and any text of another tokenizer is encoded whole by the library.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _held:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        _held[path] = (tok, {}, _in_parts(json.loads(tok.to_str())))
    tok, known, in_parts = _held[path]

    def encode(texts: list[str]) -> list[bytes]:
        if len(known) > CACHE:
            known.clear()
        split = [_parts(t) if in_parts else None for t in texts]
        new = list(set().union(*[x for x in split if x]).difference(known))
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            known.update(zip(part, [pack_ids(e.ids) for e in tok.encode_batch_fast(part, add_special_tokens=False)], strict=True))
        whole = iter(tok.encode_batch_fast([t for t, x in zip(texts, split, strict=True) if x is None], add_special_tokens=False))
        return [pack_ids(next(whole).ids) if x is None else b"".join([known[w] for w in x]) for x in split]

    return encode


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp differencing of `sizes` into k bins: lists of item numbers.

    Each item starts as a partition with one filled bin. The two partitions with the largest imbalance
    (fullest less emptiest bin) are merged again and again, fullest bin with emptiest, until one is left.
    Only filled bins are stored. Ties go to the older partition, so equal inputs give equal results.
    """
    if k <= 1 or len(sizes) <= 1:
        return [list(range(len(sizes)))] + [[] for _ in range(k - 1)]
    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)  # both descending by sum; absent bins are empty
        _, _, b = heapq.heappop(heap)
        room = k - len(a)
        if len(b) <= room:
            merged = a + b
        else:
            merged = a[: k - len(b)] + [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[k - len(b) :], reversed(b[room:]), strict=True)] + b[:room]
        merged.sort(key=lambda x: -x[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        heapq.heappush(heap, (-spread, number, merged))
        number += 1
    bins = [x[1] for x in heap[0][2]]
    return bins + [[] for _ in range(k - len(bins))]


def windows(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Near-equal windows over `sizes` (each at most `window`), none above it: the count rises until all fit."""
    k = max(1, -(-sum(sizes) // window))
    while True:
        bins = difference(sizes, k)
        if all(sum(sizes[i] for i in b) <= window for b in bins):
            return [b for b in bins if b]
        k += max(1, k // 256)


def pieces(n: int, window: int = WINDOW, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of a document's n ids: whole windows first, then the rest in near-equal pieces."""
    out = [(s, window) for s in range(0, n - n % window, window)]
    rest, start = n % window, n - n % window
    parts = -(-rest // piece)
    for i in range(parts):
        a, b = rest * i // parts, rest * (i + 1) // parts
        out.append((start + a, b - a))
    return out


def _packer(path: str, window: int, piece: int, group: int, end: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        used = 0
        held: list[tuple] = []
        total = 0

        def flush(rows: list[tuple]) -> pd.DataFrame:
            nonlocal used
            out = []
            for b in windows([r[2] for r in rows], window):
                at = 0
                for i in b:
                    out.append((*rows[i], base + used, at))
                    at += rows[i][2]
                used += 1
            doc, *rest = zip(*out, strict=True)
            return pd.DataFrame({"doc_id": pd.array(doc, "Int64"), **dict(zip(NUMBERS, (np.array(x, np.int64) for x in rest), strict=True))})

        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            texts, names = strings(batch["text"]), batch["doc_id"].tolist()
            for at in range(0, len(texts), 500):
                done = []
                for doc, ids in zip(names[at : at + 500], encode(texts[at : at + 500]), strict=True):
                    view = memoryview(ids + last)
                    n = len(view) // 4
                    doc = whole(doc)
                    for s, m in pieces(n, window, piece):
                        row = (doc, s, m, zlib.crc32(view[4 * s : 4 * (s + m)]), n)
                        if m == window:
                            done.append(row)
                            continue
                        if total + m > group * window:
                            yield flush(held)
                            held, total = [], 0
                        held.append(row)
                        total += m
                if done:
                    yield flush(done)
        if held:
            yield flush(held)

    return pack


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, piece: int = PIECE, group: int = GROUP, end: int = END) -> DataFrame:
    """Every id of every document of `docs` (doc_id, text) in exactly one piece of one window.

    A narrow stage: each task tokenizes its rows, differences about `group` windows of pieces at a time and
    emits them, so nothing is shuffled, memory is bounded by a group, and a lost task is simply run again with
    the same result. sequence_id is the task's number and a count within it. A task's last group may be
    smaller; it has at most one window not near full. Null text: empty (the end id alone). Null doc_id: kept.
    Repeated rows: each packed on its own. A very long text is tokenized whole; its ids are held while its pieces are
    cut. Empty table: no rows. Other columns are not read. `end` is the id put after each document.
    """
    ship(docs.sparkSession)
    return mapped(docs.select("doc_id", "text"), _packer(path or public_tokenizers.path("word_bpe_49k.json"), window, piece, group, end), SCHEMA)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of at most 4096 ids; see `pack`."""
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))
