"""Running sums within keys when one key may hold most rows: ranges first, then what stands before each range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import cut


def running(rows: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """`rows` with running sums (name to whole-number values) within each key, in order, the row itself included.

    Rows are sorted into ranges of key and order, so a key with most rows lies in many of them. Each range sums what it
    holds of a key; those sums, one row for each key and range, give what stands before, and a row's own sum runs
    within its range only. Rows with the same key and order are taken in any order.
    """
    named = rows.withColumns({f"_{n}": v.cast("long") for n, v in sums.items()})
    base = cut(named.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    held = base.groupBy(*keys, "_part").agg(*[F.sum(f"_{n}").alias(f"_{n}_held") for n in sums])
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # keys may be null, which equal nothing in a join
    before = held.select(F.xxhash64(*keys).alias("_key"), F.xxhash64(F.lit(1), *keys).alias("_more"), "_part", *[F.coalesce(F.sum(f"_{n}_held").over(earlier), F.lit(0)).alias(f"_{n}_before") for n in sums])
    own = W.partitionBy(*keys, "_part").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    local = base.withColumns({f"_{n}_own": F.sum(f"_{n}").over(own) for n in sums} | {"_key": F.xxhash64(*keys), "_more": F.xxhash64(F.lit(1), *keys)})
    out = local.join(before, ["_key", "_more", "_part"])
    return out.select(*rows.columns, *[(F.col(f"_{n}_own") + F.col(f"_{n}_before")).alias(n) for n in sums])
