"""The corpus pipeline: quality, near duplicates, secrets, packing; each stage written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bescheid.llm import packing, quality, secret_scan, similar
from bescheid.llm.common import finished, shared_dir, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts. It learns from the corpus's labels outside the held-out fold.

    Null and empty texts are scored as one empty line; very long ones whole; repeated rows alike. Columns of any name
    stay as they are. Empty table: no rows.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    # the work columns have names of their own, so that columns of `docs` stay as they are
    marked = quality.score(docs.select(F.struct(*docs.columns).alias("row"), "text"), model)
    return marked.where("predicted = 1").select("row.*")


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts whose five-word shingles have a Jaccard similarity of at least 0.8, links followed.

    The row of the smallest doc_id stays, of several the one with the smallest hash of all columns; different texts
    under one doc_id are documents of their own. Null and empty texts are alike. Rows without a doc_id all stay.
    Very long texts count whole. Empty table: no rows. Columns of any name stay.
    """
    return similar.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets in their texts replaced by a mark and n_chars, if there, counted anew (null for null).

    Empty texts stay, very long ones are scanned whole, repeated rows stay. Empty table: no rows.
    """
    out = secret_scan.redact(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in windows of at most 4096 ids; see `packing.pack` for nulls, empty, very long and repeated texts."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("near_duplicates", one_of_similar),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Fingerprints, trained models and tokenizers have no SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The pieces that all stages leave of the documents of `sf_dir`.

    Stages are written to a new shared folder, or to `folder`: then those that an earlier run over the same tables
    wrote there to the end are read, not run again. The folder may be removed once the result is used.
    """
    docs, base = table(spark, sf_dir, "documents"), folder or shared_dir(spark)
    for name, stage in STAGES[:-1]:
        if not (folder and finished(spark, f"{base}/{name}")):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
