"""Job streams: fan-out, routing, candidate intake by micro-batches, event-time counts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import scoring

SOURCES = ("RIS", "GAZETTE", "MUNICIPAL_WEBSITE")
JOB = "source string, municipality_key string, candidate_id string, mode string, title string, url string, discovery_source string"


def fan_out(seeds: DataFrame, mode: str = "fast") -> DataFrame:
    """Three discovery jobs for each municipality, as structs."""
    jobs = F.array(*[F.struct(F.lit(s).alias("source"), F.col("municipality_key"), F.lit(mode).alias("mode")) for s in SOURCES])
    return seeds.select("municipality_key", F.explode(jobs).alias("job"))


def enqueue(jobs: DataFrame, path: str) -> None:
    """Append jobs as JSON lines to a folder that a stream reads."""
    jobs.write.mode("append").json(path)


def route(jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(discovery jobs, extraction jobs): those with a candidate are for extraction."""
    return jobs.where("candidate_id is null"), jobs.where("candidate_id is not null")


def counted(jobs: DataFrame, name: str = "jobs") -> tuple[DataFrame, Observation]:
    """`jobs` with counters (rows, extraction jobs, sources) that are there once it has been written: no extra pass."""
    seen = Observation(name)
    return jobs.observe(seen, F.count("*").alias("jobs"), F.count("candidate_id").alias("extractions"), F.collect_set("source").alias("sources")), seen


def by_host(requests: DataFrame) -> DataFrame:
    """Requests (url) so that one task owns all of a host: the place for a delay per host."""
    return requests.repartition(F.try_parse_url(F.col("url"), F.lit("HOST")))


def work_folder(spark: SparkSession) -> str:
    """A new folder that all executors see: below spark.checkpoint.dir, or a local one where a session on one machine names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
    return f"{(base or 'file://' + tempfile.mkdtemp(prefix='jobs-')).rstrip('/')}/{uuid.uuid4().hex}"


def intake(stream: DataFrame, table: str, checkpoint: str, mode: str = "fast"):
    """A stream query that scores arriving candidates and keeps one row each in the Parquet folder `table`.

    Each micro-batch writes its own folder, overwritten when the batch is replayed, so a restart repeats nothing.
    """

    def batch(df: DataFrame, number: int) -> None:
        ok = scoring.should_extract(F.round(scoring.prefilter_score(F.col("title"), F.col("url")), 6), F.col("discovery_source"), mode)
        df.select("candidate_id", F.when(ok, "ENQUEUED").otherwise("SKIPPED").alias("status"), F.lit(number).cast("long").alias("batch")).write.mode("overwrite").parquet(f"{table}/n={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, table: str) -> DataFrame:
    """The last state of each candidate: a pre-aggregated maximum over the batches."""
    rows = spark.read.parquet(table)
    return rows.groupBy("candidate_id").agg(F.max_by("status", "batch").alias("status"), F.max("batch").alias("batch"))


def run_candidates(spark: SparkSession, announcements: DataFrame) -> DataFrame:
    """All announcements through the JSON queue, the stream and its table, until the queue is empty."""
    base = work_folder(spark)
    queue = announcements.select(F.lit("RIS").alias("source"), "municipality_key", F.col("doc_id").cast("string").alias("candidate_id"), F.lit("fast").alias("mode"), "title", "url", "discovery_source")
    enqueue(queue, f"{base}/queue")
    stream = spark.readStream.schema(JOB).json(f"{base}/queue")
    q = intake(route(stream)[1], f"{base}/table", f"{base}/checkpoint")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return current(spark, f"{base}/table").select(F.col("candidate_id").cast("long").alias("candidate_id"), "status")


def daily_counts(spark: SparkSession, path: str) -> DataFrame:
    """Events by day and type, counted by a stream in windows.

    Update mode: the watermark frees the state of windows that are over, and a micro-batch writes only the windows
    that it changed, to a folder of its own that a replay overwrites. A window's last count stands. Events later than
    the watermark are not counted, as in any such stream; a bounded table read at once has none.
    """
    base = work_folder(spark)
    folder, _, name = path.rpartition("/")
    schema = spark.read.parquet(path).schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder) if name else spark.readStream.schema(schema).parquet(path)
    counts = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 day").groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n"))
    out = counts.select(F.col("w.start").alias("start"), "event_type", "n")

    def keep(df: DataFrame, number: int) -> None:
        df.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{base}/counts/run={number}")

    q = out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    last = spark.read.parquet(f"{base}/counts").groupBy("start", "event_type").agg(F.max_by("n", "batch").alias("n"))
    return last.groupBy(F.col("start").cast("date").alias("day"), "event_type").agg(F.sum("n").alias("n"))
