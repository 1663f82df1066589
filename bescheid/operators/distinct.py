"""Exact distinct counts at several levels from one pass, kept as bitmaps that a delta merges with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def states(rows: DataFrame, by: list[str], counted: dict[str, Column]) -> DataFrame:
    """The distinct numbers of each name of `counted` (whole numbers, null where a row does not count) in each group: by,
    _of, _bucket, _bits.

    A bucket is a stretch of 32,768 numbers, its bits those that occur, 4 KB at most; so numbers should be dense, as
    running numbers are. A number that a row repeats sets its bit again: rows that a join multiplied cost nothing here.
    Groups are combined before they move, and a hot group is spread over its buckets.
    """
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("of"), v.cast("long").alias("id")) for n, v in counted.items()])).alias("_x")
    x = rows.select(*by, each).select(*by, F.col("_x.of").alias("_of"), F.col("_x.id").alias("_id")).where("_id is not null")
    return x.groupBy(*by, "_of", F.bitmap_bucket_number("_id").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("_bits"))


def merged(*parts: DataFrame) -> DataFrame:
    """States of all parts together, without looking at the rows that made them. A part that comes twice adds nothing."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    by = [c for c in out.columns if c != "_bits"]
    return out.groupBy(*by).agg(F.bitmap_or_agg("_bits").alias("_bits"))


def counts(held: DataFrame, levels: list[list[str]], names: list[str]) -> DataFrame:
    """Distinct counts of `names` at each level: the columns of all levels, null where a level does not have them, `level`
    (how many it has) and one column for each name, 0 where nothing counts.

    All levels come from one pass over the states: each bucket is united once for every level, then its bits are counted.
    Groups without any state are absent.
    """
    by = list(dict.fromkeys(c for level in levels for c in level))
    level = F.explode(F.array(*[F.struct(F.lit(len(level)).alias("level"), *[(F.col(c) if c in level else F.lit(None).cast(held.schema[c].dataType)).alias(c) for c in by]) for level in levels])).alias("_l")
    united = held.select(level, "_of", "_bucket", "_bits").groupBy("_l", "_of", "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"))
    of = united.groupBy("_l").agg(*[F.coalesce(F.sum(F.when(F.col("_of") == n, F.bitmap_count("_bits"))), F.lit(0)).cast("long").alias(n) for n in names])
    return of.select("_l.level", *[f"_l.{c}" for c in by], *names)
