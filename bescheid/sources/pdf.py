"""Texts of PDF files page by page, in plain Python: objects, page tree, streams and the operators that show text."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

_OBJECT = re.compile(rb"(?<!\d)(\d+)\s+(\d+)\s+obj\b(.*?)(?:\bendobj\b|(?=(?<!\d)\d+\s+\d+\s+obj\b)|\Z)", re.DOTALL)
_STREAM = re.compile(rb"(.*?)\bstream\r?\n(.*?)\r?\n?endstream", re.DOTALL)
_REFERENCE = re.compile(rb"(\d+)\s+\d+\s+R")
_SHOWN = re.compile(
    rb"""\((?P<text>(?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*)\)|<(?P<hex>[0-9A-Fa-f\s]*)>|(?P<number>[-+]?\d*\.?\d+)|(?P<open>\[)|(?P<close>\])|(?P<op>T\*|'|"|[A-Za-z]+)""", re.DOTALL,
)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _literal(raw: bytes) -> str:
    def plain(m: re.Match[bytes]) -> bytes:
        x = m[1]
        return bytes([int(x, 8) & 255]) if x[:1].isdigit() else b"" if x in (b"\n", b"\r\n", b"\r") else _ESCAPES.get(x, x)

    return _decoded(re.sub(rb"\\([0-7]{1,3}|\r\n|.)", plain, raw, flags=re.DOTALL))


def _decoded(raw: bytes) -> str:
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("cp1252", "replace")


def _content(body: bytes) -> bytes:
    """A stream's bytes; only deflated and plain ones are read."""
    m = _STREAM.match(body)
    if not m:
        return b""
    if b"/FlateDecode" in m[1]:
        return zlib.decompressobj().decompress(m[2])
    return b"" if b"/Filter" in m[1] else m[2]


def _objects(data: bytes) -> dict[int, bytes]:
    found = {int(m[1]): m[3] for m in _OBJECT.finditer(data)}
    for body in list(found.values()):
        if b"/ObjStm" in body[:400]:
            raw = _content(body)
            first, n = (int(re.search(rb"/" + k + rb"\s+(\d+)", body)[1]) for k in (b"First", b"N"))  # type: ignore[index]
            heads = [int(x) for x in raw[:first].split()][: 2 * n]
            starts = [*heads[1::2], len(raw) - first]
            found.update({number: raw[first + a : first + b] for number, a, b in zip(heads[::2], starts, starts[1:], strict=False)})
    return found


def _pages(objects: dict[int, bytes]) -> Iterator[bytes]:
    """Page objects in the order of the page tree, or of their numbers if there is none."""
    page = re.compile(rb"/Type\s*/Page(?![A-Za-z])")
    roots = [b for b in objects.values() if re.search(rb"/Type\s*/Pages\b", b) and not re.search(rb"/Parent\b", b)]
    if not roots:
        yield from (objects[k] for k in sorted(objects) if page.search(objects[k]))
        return
    stack, seen = [roots[0]], set()
    while stack:
        body = stack.pop()
        if page.search(body):
            yield body
            continue
        kids = re.search(rb"/Kids\s*\[(.*?)\]", body, re.DOTALL)
        for k in reversed([int(x) for x in _REFERENCE.findall(kids[1])] if kids else []):
            if k in objects and k not in seen:
                seen.add(k)
                stack.append(objects[k])


def _shown(content: bytes) -> str:
    """The text that a page's operators show; a move to another line is a line end."""
    out: list[str] = []
    held: list[str | float] = []
    listed = False
    for m in _SHOWN.finditer(content):
        if m["text"] is not None:
            held.append(_literal(m["text"]))
        elif m["hex"] is not None:
            digits = re.sub(rb"\s", b"", m["hex"])
            held.append(_decoded(bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())))
        elif m["number"] is not None:
            # a wide gap within a line is a space
            if listed and float(m["number"]) < -200:
                held.append(" ")
            elif not listed:
                held.append(float(m["number"]))
        elif m["open"] or m["close"]:
            listed = m["open"] is not None
        else:
            op = m["op"]
            if op in (b"'", b'"', b"T*"):
                out.append("\n")
            elif op in (b"Td", b"TD") and len(held) >= 2 and held[-1] != 0:
                out.append("\n")
            elif op in (b"Tm", b"ET"):
                out.append("\n")
            if op in (b"Tj", b"TJ", b"'", b'"'):
                out += [x for x in held if isinstance(x, str)]
            held.clear()
    return "\n".join(line for line in (x.strip() for x in "".join(out).split("\n")) if line)


def pages(data: bytes | None) -> list[str] | None:
    """The texts of all pages, empty ones included; null for what is no readable file."""
    if not data or b"%PDF" not in data[:1024]:
        return None
    try:
        objects = _objects(data)
        out = []
        for body in _pages(objects):
            refs = re.search(rb"/Contents\s*(?:\[(.*?)\]|(\d+\s+\d+\s+R))", body, re.DOTALL)
            numbers = [int(x) for x in _REFERENCE.findall(refs[1] or refs[2])] if refs else []
            out.append(_shown(b"\n".join(_content(objects.get(k, b"")) for k in numbers)))
        return out
    except (ValueError, TypeError, zlib.error):
        return None


@F.pandas_udf(ArrayType(StringType()))
def page_texts(data: pd.Series) -> pd.Series:
    """`pages` in Arrow batches: no built-in function reads this format."""
    return data.map(pages).astype(object)


def text(pages_: Column | str, most: int | None = None) -> Column:
    """Non-empty pages among the first `most`, parted by an empty line; null without any."""
    p = F.col(pages_) if isinstance(pages_, str) else pages_
    head = p if most is None else F.slice(p, 1, most)
    return F.nullif(F.array_join(F.filter(head, lambda x: x != ""), "\n\n"), F.lit(""))
