"""The folder that driver and executors share, and what is cut off or written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def base_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, or that of the context, set as the checkpoint folder.

    Only where a session on one machine names none (tests) it is a temporary one; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        base = f"file://{tempfile.mkdtemp(prefix='work-')}"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def work_folder(spark: SparkSession) -> str:
    """The path of a new folder below `base_folder`."""
    return f"{base_folder(spark)}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """`df` as a reliable checkpoint: computed once, its plan cut, safe when executors go."""
    base_folder(df.sparkSession)
    return df.checkpoint()
