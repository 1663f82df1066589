"""What the operators share: tables, the shared folder, whole runs of sorted rows, components."""

from __future__ import annotations

import itertools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Bytes of an Arrow batch, about; one longer row comes alone.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str, deal: bool = False) -> DataFrame:
    """The named Parquet table; only `columns` when given. Workers get the path of this package.

    `deal`: a table of fewer files than cores is dealt out once by rows, for row-by-row work; a file of one row
    group is else one task. Tables of many files, as a cluster's are, stay as they are.
    """
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    df = df.select(*columns) if columns else df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if deal and len(df._jdf.inputFiles()) < cores else df


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when the driver found it by its working folder only, and bound the bytes
    of the batches that they get, else bounded by rows only, however long texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), ROOT) if x)


def base_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors see, set as the checkpoint folder.

    Only where the session names none and runs on one machine (tests) it is a temporary one; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        base = f"file://{tempfile.mkdtemp(prefix='bescheid-')}"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession) -> str:
    """The path of a new folder below `base_dir`."""
    return f"{base_dir(spark)}/{uuid.uuid4().hex}"


def cut(df: DataFrame, few: bool = False) -> DataFrame:
    """`df` checkpointed in the shared folder: computed once, and safe when executors go.

    `few`: at most two files for each core of the cluster, for frames of ids that many shuffle partitions share.
    """
    base_dir(df.sparkSession)
    return (df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism) if few else df).checkpoint()


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to `path` to its end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


_WHOLE = {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}


def mapped(df: DataFrame, step: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """`df` through `step` in Arrow batches, as `mapInPandas`, but whole numbers beside nulls stay whole.

    There a column of 64-bit numbers with any null reaches Python as floating point, which rounds ids over 2^53.
    Here such a column has the type Int64, with pd.NA. Columns of the result may be Int64, int64 or lists of int.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for b in batches:
            holes = {c.type for c in b.columns if c.null_count}
            yield b.to_pandas(types_mapper=lambda t, holes=holes: _WHOLE.get(t) if t in holes else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in step(frames(batches)):
            yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

    return df.mapInArrow(run, schema)


def whole(x: object) -> int | None:
    """A value of an integer column, null as None."""
    return None if x is None or x is pd.NA else int(x)  # type: ignore[call-overload]


def chunks(texts: list[str], limit: int = 1_000_000) -> Iterator[slice]:
    """Slices of `texts` of at most `limit` characters together (one longer text comes alone)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def strings(column: pd.Series) -> list[str]:
    """The values as str; null becomes the empty text."""
    return [x if isinstance(x, str) else "" for x in column.tolist()]


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Regroup sorted batches so that no run of equal keys is cut between two of them."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        last = b[keys].iloc[-1]
        start = len(b)
        same = (b[keys] == last).all(axis=1).to_numpy()
        start = len(b) - (int(same[::-1].argmin()) if not same.all() else len(b))
        if start:
            yield pd.concat([*held, b.iloc[:start]], ignore_index=True) if held else b.iloc[:start].reset_index(drop=True)
            held = []
        elif held and not (held[-1][keys].iloc[-1] == last).all():
            yield pd.concat(held, ignore_index=True)
            held = []
        held.append(b.iloc[start:])
    if held:
        yield pd.concat(held, ignore_index=True)


def forest(pairs_a: list[int], pairs_b: list[int]) -> list[tuple[int, int]]:
    """The pairs' components as (member, smallest member): at most one row for each member."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    for a, b in zip(pairs_a, pairs_b, strict=True):
        ra, rb = root(a), root(b)
        if ra != rb:
            lo, hi = (ra, rb) if ra < rb else (rb, ra)
            up[hi] = lo
            up.setdefault(lo, lo)
    return [(x, r) for x in list(up) if (r := root(x)) != x]


def components(edges: DataFrame, most_rounds: int | None = None) -> DataFrame:
    """Connected components of edges (a, b): (node, root), root the smallest node; isolated nodes are absent.

    Alternating large and small stars (Kiveris et al. 2014). Each round is aggregations and equi-joins,
    checkpointed; a hub's minimum is pre-aggregated before the shuffle and its rows can be split by
    adaptive skew joins. Only a count and a checksum reach the driver. Rounds go on until nothing changes; if
    `most_rounds` do not reach that, it is an error.
    """
    cur = cut(
        edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct(), few=True
    )
    seen = None
    for done in itertools.count():
        sig = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi"))).first()
        if sig == seen or not sig[0]:
            break
        if done == most_rounds:
            raise RuntimeError(f"components still change after {most_rounds} rounds")
        seen = sig
        both = cur.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            cur.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        out = large.join(small, "hi").where("lo != m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        cur = cut(out.unionByName(small.select(F.col("m").alias("lo"), "hi")).distinct(), few=True)
    return cur.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


Query = Callable[[SparkSession, str], DataFrame]
