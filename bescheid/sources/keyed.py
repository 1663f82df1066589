"""Tables kept by key in hashed buckets: a delta rewrites only the buckets that hold its keys."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut

BUCKET = "_bucket"
Merge = Callable[[DataFrame, DataFrame], DataFrame]
"""(rows so far, delta) to the rows of both by key; it drops no key."""


@dataclass(frozen=True)
class KeyedTable:
    """A Parquet table at `path`, partitioned by the hash of `key` into `buckets`.

    A bucket is what one task rewrites, so `buckets` should grow with the table (about 256 MB each); it is fixed once
    the table is there. Null keys hash like any value. Columns may have any name but `_bucket`.
    """

    path: str
    key: tuple[str, ...]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.key]), F.lit(self.buckets)).cast("int")

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        # dynamic overwrites leave no mark of success; a bucket is there once its job has ended
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BUCKET}=*")
        there = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
        return spark.read.parquet(self.path) if there else None

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows; of a table that was never written this is an error."""
        return spark.read.parquet(self.path).drop(BUCKET)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows whose key is in `keys`, from the buckets that can hold them."""
        touched = self._touched(keys.withColumn(BUCKET, self.bucket()))
        rows = keys.sparkSession.read.parquet(self.path).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        return rows.join(keys.select(*self.key), list(self.key), "left_semi")

    @staticmethod
    def _touched(rows: DataFrame) -> list[int]:
        # at most one number for each bucket
        return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())

    def merge(self, delta: DataFrame, how: Merge) -> list[int]:
        """Merge `delta` by `how` and rewrite the buckets that its keys fall into; gives their numbers.

        Buckets without a key of the delta are neither read nor written. New files are staged and take the old ones'
        place when all tasks are done, so a job that fails leaves the table as it was. Should the driver be lost while
        files are put in place, merging the same delta again completes it, unless a bucket was caught between removal
        and replacement; a store of snapshots is needed where that must not be. A replay of a delta changes nothing where
        `how` is an upsert. An empty delta writes nothing.
        """
        spark = delta.sparkSession
        new = cut(delta.withColumn(BUCKET, self.bucket()))
        touched, stored = self._touched(new), self._stored(spark)
        if not touched:
            return []
        fresh = new.drop(BUCKET)
        base = spark.createDataFrame([], fresh.schema) if stored is None else stored.where(F.col(BUCKET).isin(touched)).select(*[F.col(f"`{c}`") for c in fresh.columns])
        rows = how(base, fresh).withColumn(BUCKET, self.bucket()).repartition(BUCKET)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)
        return touched
