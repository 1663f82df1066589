"""Merkle manifest of a table of documents: a radix-ranked trie of SHA-256 hashes with a proof for every row."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, mapped, ship, table

#: Nodes that become one in a run.
BASE = 2
#: Digits of a rank that one task reduces: 2 ** DIGITS nodes with one prefix.
DIGITS = 10
#: Rows that a bucket of equal key digits may hold before further digits divide it.
BUCKET = 1024
#: Bits of one further digit.
RADIX = 12


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels until n nodes are one."""
    return max(n - 1, 0).bit_length()


def levels(nodes: list[str], high: int) -> list[list[str]]:
    """The nodes and what they become in `high` levels: every two consecutive ones, a last one alone, are hashed together."""
    out = [nodes]
    for _ in range(high):
        last = out[-1]
        out.append([_hash("".join(last[i : i + BASE])) for i in range(0, len(last), BASE)])
    return out


def siblings(tree: list[list[str]], i: int) -> str:
    """What the i-th node meets on its way up: for each level `R` or `L` with the sibling on that side, or `-` without one."""
    out = []
    for row in tree[:-1]:
        j = i ^ 1
        out.append("-" if j >= len(row) else ("R" if j > i else "L") + row[j])
        i >>= 1
    return "".join(out)


def steps(path: str) -> Iterator[tuple[str, str]]:
    """(side, sibling) of each level of a path as `siblings` writes it."""
    at = 0
    while at < len(path):
        side = path[at]
        end = at + 1 if side == "-" else at + 65
        yield side, path[at + 1 : end]
        at = end


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and the siblings on its way give."""
    for side, other in steps(path):
        leaf = _hash(leaf + other if side != "L" else other + leaf)
    return leaf


def leaf_hash(*fields: Column) -> Column:
    """SHA-256 of the fields, each as its UTF-8 byte count, a colon and its value, or `-` for null."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[part(f.cast("string")) for f in fields]), 256)


def _mask(shift: int) -> int:
    """A 64-bit mask, signed, that clears the lowest `shift` bits."""
    return 0 if shift >= 64 else -(1 << shift)


def ranks(rows: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """`rows` (g, doc_id, leaf, row) with their place (rank, from 0) in g by doc_id (null first), leaf and row, and g's size n.

    No sort runs over a group. Leading digits of the key give buckets; their histogram, summed by digits from the top,
    gives the number of rows before each bucket, and rows are numbered within their bucket only. The first digits are
    as many as make the average bucket a quarter of `bucket`; a bucket that holds more is divided by RADIX further bits
    of doc_id, then of the leaf, then of `row`, so neither clustered ids nor one id on most rows make a bucket grow.
    """
    span = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    spread = 64 if span[0] is None or (span[0] < 0) != (span[1] < 0) else (span[0] ^ span[1]).bit_length()
    first = max(0, spread - math.ceil(math.log2(max(1, 4 * span[2] / bucket))))
    down = lambda top: [*range(top, 0, -RADIX), 0]
    shifts = [(s, 60, 63) for s in down(first)] + [(0, s, 63) for s in down(60 - RADIX)] + [(0, 0, s) for s in down(63 - RADIX)]
    key = ["g", "known", "p0", "p1", "p2"]
    left = rows.withColumns({"known": F.col("doc_id").isNotNull(), "k0": F.coalesce("doc_id", F.lit(0)), "k1": F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long")})
    parts, counts = [], []
    for s in shifts:
        marked = left.withColumns({f"p{i}": F.col(c).bitwiseAND(F.lit(_mask(n))) for i, (c, n) in enumerate(zip(("k0", "k1", "row"), s, strict=True))})
        counted = cut(marked.groupBy(*key).agg(F.count("*").alias("held")), few=True)
        hot = counted.where(F.col("held") > bucket).select(*key)
        if s == (0, 0, 0) or hot.isEmpty():
            parts.append(marked)
            counts.append(counted)
            break
        parts.append(marked.join(hot, key, "left_anti"))
        counts.append(counted.where(F.col("held") <= bucket))
        left = marked.join(hot, key, "left_semi").drop("p0", "p1", "p2")
    held, placed = counts[0], parts[0]
    for c, p in zip(counts[1:], parts[1:], strict=True):
        held, placed = held.unionByName(c), placed.unionByName(p)
    # buckets of fewer digits sum up those of more: first before each upper digit, then within it
    upper = held.withColumn("top", F.col("p0").bitwiseAND(F.lit(_mask(first + DIGITS))))
    sums = upper.groupBy("g", "known", "top").agg(F.sum("held").alias("sum"))
    group = W.partitionBy("g")
    sums = sums.select("g", "known", "top", (F.sum("sum").over(group.orderBy("known", "top")) - F.col("sum")).alias("above"), F.sum("sum").over(group).alias("n"))
    within = F.sum("held").over(W.partitionBy("g", "known", "top").orderBy("p0", "p1", "p2")) - F.col("held")
    offsets = upper.withColumn("within", within).join(sums, ["g", "known", "top"]).select(*key, (F.col("above") + F.col("within")).alias("before"), "n")
    own = F.row_number().over(W.partitionBy(*key).orderBy("k0", "k1", "row")) - 1
    return placed.withColumn("own", own).join(offsets, key).withColumn("rank", F.col("before") + F.col("own")).select(*rows.columns, "rank", "n")


def numbered(rows: DataFrame, by: str) -> DataFrame:
    """`rows` with `rank` from 0 in the order of `by`: sorted by ranges, numbered in each, and the ranges' counts summed."""
    base = cut(rows.orderBy(by)).withColumn("_id", F.monotonically_increasing_id())
    base = cut(base.withColumns({"_part": F.shiftright("_id", 33), "_own": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_id"), few=True)
    # one row for each range
    before = base.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    return base.join(before, "_part").withColumn("rank", F.col("_before") + F.col("_own")).drop("_part", "_own", "_before")


def chunked(nodes: DataFrame, *more: str) -> DataFrame:
    """One row for all nodes (g, rank, n, hash) with one prefix: g, prefix, n, and their hashes and `more` in order."""
    cols = ["hash", *more]
    held = nodes.withColumn("prefix", F.shiftright("rank", DIGITS)).groupBy("g", "prefix").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("rank", *cols))).alias("x"))
    return held.select("g", "prefix", "n", *[F.col(f"x.{c}").alias(c) for c in cols])


def _up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        top = [levels(list(h), min(DIGITS, height(n)))[-1][0] for h, n in zip(b["hash"], b["n"], strict=True)]
        yield pd.DataFrame({"g": b["g"], "rank": b["prefix"], "n": -(-b["n"] // BASE**DIGITS), "hash": top})


def _down(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for g, prefix, n, h, path in zip(b["g"], b["prefix"], b["n"], b["hash"], b["path"], strict=True):
            tree = levels(list(h), min(DIGITS, height(n)))
            out += [(g, (prefix << DIGITS) + i, siblings(tree, i) + path, x) for i, x in enumerate(tree[0])]
        yield pd.DataFrame(out, columns=["g", "rank", "path", "hash"])


_NODE, _PATH = "g string, rank long, n long, hash string", "g string, rank long, path string, hash string"


class Trie:
    """The trie over nodes (g, rank, n, hash) of each g, reduced by the longest prefix of their ranks' digits.

    Nodes with one prefix meet in one task, at most 2 ** DIGITS; what they become is a node of the next round, whose
    rank is the prefix. So a group of any size takes log(size) / DIGITS shuffles of hashes, and no task gets more.
    """

    def __init__(self, nodes: DataFrame, largest: int, *more: str) -> None:
        self.rounds = [chunked(nodes, *more)]
        while True:
            top = cut(mapped(self.rounds[-1].select("g", "prefix", "n", "hash"), _up, _NODE), few=True)
            largest = -(-largest // BASE**DIGITS)
            if largest <= 1:
                break
            self.rounds.append(chunked(top))
        #: (g, rank 0, n 1, hash): the root of each group.
        self.roots = top

    def paths(self, above: DataFrame) -> DataFrame:
        """The lowest chunks with what stands over each in `path`, from the paths (g, path, and any more) over the roots."""
        more = [c for c in above.columns if c not in ("g", "path")]
        over = above.withColumn("prefix", F.lit(0).cast("long"))
        for chunks in self.rounds[:0:-1]:
            down = mapped(chunks.join(over.select("g", "prefix", "path"), ["g", "prefix"]), _down, _PATH)
            over = down.select("g", F.col("rank").alias("prefix"), "path")
            over = over.join(above.select("g", *more), "g") if more else over
            over = cut(over, few=True)
        return self.rounds[0].join(over, ["g", "prefix"])


def _proofs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for n, h, path, ids, bad, sub in zip(b["n"], b["hash"], b["path"], b["doc_id"], b["tampered"], b["subroot"], strict=True):
            tree = levels(list(h), min(DIGITS, height(n)))
            for i, (leaf, doc, other) in enumerate(zip(tree[0], ids, bad, strict=True)):
                whole = siblings(tree, i) + path
                out.append((doc, leaf, sub, _hash("".join(x for _, x in steps(whole))), fold(other or leaf, whole)))
        found = pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])
        found["doc_id"] = pd.array([None if x is None else int(x) for x in found["doc_id"]], "Int64")
        yield found


def manifest(docs: DataFrame, tampered: Column | None = None, bucket: int = BUCKET) -> DataFrame:
    """One row per row of `docs` (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Each row is a leaf; leaves of one lang, in order of doc_id, are reduced to its subroot, and the subroots, null
    first, to the root: every two consecutive nodes become their hash, a last one alone is hashed too. `proof_sha256` is
    of all siblings on the way up, `folded_root` what the leaf and they give. Where `tampered` (a condition over
    columns of `docs`) holds, n_chars plus one is folded with the original siblings, so `verified` tells the change; a null
    n_chars stays.

    Nulls in any column are values of their own. A null doc_id comes first; rows with one doc_id go by their leaf, and
    equal rows one after another, each with its own proof. Texts are hashed whole in one scan; only hashes move. A
    lang or doc_id on any share of the rows is spread. Empty table: no rows. Other columns are not read.
    """
    ship(docs.sparkSession)
    fields = lambda n: leaf_hash(*[F.col(c) for c in ("doc_id", "source", "lang")], n, F.col("text"))
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    bad = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    # null before all names, which keep their order
    g = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    leaves = docs.select(g.alias("g"), F.col("doc_id").cast("long").alias("doc_id"), fields(F.col("n_chars")).alias("leaf"), F.when(bad, fields(more)).alias("tampered"))
    leaves = cut(leaves.withColumn("row", F.monotonically_increasing_id()))
    # ids in arrays travel as text: beside nulls Python would see them as floating point
    placed = ranks(leaves, bucket).select("g", "rank", "n", F.col("leaf").alias("hash"), F.col("doc_id").cast("string").alias("doc_id"), "tampered")
    sizes = leaves.groupBy("g").agg(F.count("*").alias("n"))
    most, groups = sizes.agg(F.max("n"), F.count("*")).first()
    low = Trie(placed, most or 0, "doc_id", "tampered")
    subroots = numbered(low.roots.select(F.col("g").alias("lang"), "hash"), "lang")
    high = Trie(subroots.select(F.lit("").alias("g"), "rank", F.lit(groups).cast("long").alias("n"), "hash", "lang"), groups, "lang")
    # one row, one hash
    root = high.roots.select("hash").first()
    top = high.paths(docs.sparkSession.createDataFrame([("", "")], "g string, path string"))
    named = mapped(top, _named, "g string, path string, subroot string")
    whole = low.paths(named)
    out = mapped(whole.select("n", "hash", "path", "doc_id", "tampered", "subroot"), _proofs, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    root = F.lit(root[0] if root else None).cast("string")
    return out.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def _named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for n, h, path, names in zip(b["n"], b["hash"], b["path"], b["lang"], strict=True):
            tree = levels(list(h), min(DIGITS, height(n)))
            out += [(g, siblings(tree, i) + path, x) for i, (g, x) in enumerate(zip(names, tree[0], strict=True))]
        yield pd.DataFrame(out, columns=["g", "path", "subroot"])


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, with one added to n_chars where 7 divides the id's crc32; see `manifest`."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    return manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)


_PART = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_PART.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"

#: Levels by recursion over whole levels; the checksum by its table of bytes.
SQL = f"""WITH RECURSIVE
tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
doc AS (SELECT *, row_number() OVER () AS row, list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])) AS c FROM documents, tab),
leaf AS (SELECT lang, doc_id, row, {_LEAF.format(n="n_chars")} AS h, CASE WHEN xor(c, 4294967295) % 7 = 0 THEN {_LEAF.format(n="(n_chars::HUGEINT + 1)")} END AS bad FROM doc),
placed AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h, row) - 1 AS pos FROM leaf),
low AS (SELECT g, 0 AS lv, pos, h, (SELECT count(*) FROM placed q WHERE q.g = p.g) AS n FROM placed p
  UNION ALL SELECT g, min(lv) + 1, pos // 2 AS q, sha256(string_agg(h, '' ORDER BY pos)), (min(n) + 1) // 2 FROM low WHERE n > 1 GROUP BY g, pos // 2),
sub AS (SELECT g, h AS subroot FROM low WHERE n = 1),
high AS (SELECT 0 AS lv, g AS pos, subroot AS h, (SELECT count(*) FROM sub) AS n FROM sub
  UNION ALL SELECT min(lv) + 1, pos // 2 AS q, sha256(string_agg(h, '' ORDER BY pos)), (min(n) + 1) // 2 FROM high WHERE n > 1 GROUP BY pos // 2),
root AS (SELECT h AS root FROM high WHERE n = 1),
way AS (
  SELECT p.row, l.lv, p.pos >> l.lv AS node, s.h AS other FROM placed p JOIN (SELECT DISTINCT g, lv FROM low WHERE n > 1) l USING (g) LEFT JOIN low s ON s.g = p.g AND s.lv = l.lv AND s.pos = xor(p.pos >> l.lv, 1)
  UNION ALL SELECT p.row, 1000 + l.lv, p.g >> l.lv, s.h FROM placed p, (SELECT DISTINCT lv FROM high WHERE n > 1) l LEFT JOIN high s ON s.lv = l.lv AND s.pos = xor(p.g >> l.lv, 1)),
ways AS (SELECT row, list(struct_pack(node := node, other := coalesce(other, '')) ORDER BY lv) AS w, string_agg(other, '' ORDER BY lv) AS proof FROM way GROUP BY row),
folded AS (SELECT p.row, coalesce(bad, h) AS h, coalesce(w, []) AS w, 1 AS k FROM placed p LEFT JOIN ways USING (row)
  UNION ALL SELECT row, sha256(CASE WHEN w[k].node % 2 = 0 THEN h || w[k].other ELSE w[k].other || h END), w, k + 1 FROM folded WHERE k <= len(w))
SELECT p.doc_id, p.h AS leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM placed p JOIN sub USING (g) LEFT JOIN ways USING (row) JOIN folded f ON f.row = p.row AND f.k = len(f.w) + 1, root"""
