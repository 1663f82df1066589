"""Sources: response cache, robots rules, map services, progressive page texts; and the sinks of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..functions.text import authority, decode_references

#: Words that make the whole file worth reading.
TRIGGERS = ["batteriespeicher", "energiespeicher", "bebauungsplan", "aufstellungsbeschluss"]


#: Bytes of an Arrow batch, about; one longer row comes alone.
BATCH_BYTES = 2 << 20


def dealt(df: DataFrame) -> DataFrame:
    """A scanned table for row-by-row work: dealt out once over the cores if it has fewer files than they are.

    A file of one row group is one task however many cores wait; tables of many files stay as they are. Batches that
    Python gets are bounded in bytes: by rows alone they grow with the texts, and with the table until they are full.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df._jdf.inputFiles()) < cores else df


def cache_key(url: Column | str) -> Column:
    return F.sha2(F.col(url) if isinstance(url, str) else url, 256)


def misses(requests: DataFrame, cache: DataFrame, now: Column, days: int | None = None) -> DataFrame:
    """Requests (url) with no fresh entry in the cache (key, cached_at): what a fetcher still has to get."""
    fresh = cache if days is None else cache.where(F.col("cached_at") >= now - F.make_dt_interval(F.lit(days)))
    return requests.withColumn("key", cache_key("url")).join(fresh.select("key"), "key", "left_anti")


def allowed(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """Requests (url) with whether robots rules (host, prefix) leave them open; hosts without rules are open."""
    path = F.regexp_replace("url", r"^[a-z]+://[^/?#]*", "")
    r = rules.groupBy("host").agg(F.collect_set("prefix").alias("prefixes"))  # a host's rules are one small file
    x = requests.withColumn("host", authority("url")).join(r, "host", "left")
    return x.withColumn("allowed", ~F.coalesce(F.exists("prefixes", lambda p: path.startswith(p)), F.lit(False))).drop("prefixes", "host")


def progressive(df: DataFrame, pages: str, first: int) -> DataFrame:
    """`text` of an array of page texts: all pages if a trigger word is on the first ones, else those alone.

    Empty pages are left out; pages are parted by an empty line.
    """
    head = F.slice(pages, 1, first)
    low, hit = F.lower(F.array_join(head, "\n")), F.lit(False)
    for t in TRIGGERS:
        hit = hit | low.contains(t)
    full = lambda a: F.array_join(F.filter(a, lambda x: F.trim(x) != ""), "\n\n")
    return df.withColumn("triggered", hit).withColumn("text", F.when(F.col("triggered"), full(F.col(pages))).otherwise(full(head)))


def features(answers: DataFrame) -> DataFrame:
    """One row per feature of a map service's answers (body): id, name, planart, gemeinde, each from either spelling.

    An answer is GeoJSON, else XML, whose members are cut apart (`members`). An empty value counts as missing; what is
    missing on both sides is empty. Members have no id.
    """
    schema = "struct<features:array<struct<id:string,properties:map<string,string>>>>"
    is_json = F.get_json_object("body", "$").isNotNull()
    f = answers.where(is_json).select(F.explode(F.from_json("body", schema)["features"]).alias("f")).select("f.id", F.col("f.properties").alias("p"))
    m = answers.where(~F.coalesce(is_json, F.lit(True))).select(F.explode(members("body")).alias("p")).select(F.lit(None).cast("string").alias("id"), "p")
    either = lambda *names: F.coalesce(*[F.nullif(F.try_element_at("p", F.lit(n)), F.lit("")) for n in names], F.lit(""))
    return f.unionByName(m).select("id", either("name", "bezeichnung").alias("name"), either("planart", "planArt").alias("planart"), either("gemeinde", "gemeindename").alias("gemeinde"))


#: The names that are read of a member.
MEMBER_FIELDS = ["name", "bezeichnung", "planart", "planArt", "gemeinde", "gemeindename", "status"]


def members(body: Column | str) -> Column:
    """The feature members of an XML answer in order: maps from the names of their elements, without prefix, to the last
    text that stands under each. The answer is cut at its members, so each is read once."""
    parts = F.split(F.col(body) if isinstance(body, str) else body, r"<(?:[\w.-]+:)?member(?=[\s>])[^>]*>", -1)
    inside = lambda p: F.get(F.split(p, r"</(?:[\w.-]+:)?member\s*>", 2), 0)
    last = lambda p, n: F.try_element_at(F.regexp_extract_all(p, F.lit(rf"<(?:[\w.-]+:)?{n}(?:\s[^<>]*)?(?<!/)>([^<]*)<"), F.lit(1)), F.lit(-1))
    fields = lambda p: F.create_map(*[x for n in MEMBER_FIELDS for x in (F.lit(n), decode_references(last(p, n)))])
    return F.transform(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), inside), fields)


def page_text(html: Column | str) -> Column:
    """A page's text, a line for each stretch between tags, its character references decoded; scripts, styles and comments give nothing."""
    return F.btrim(markup.lines(decode_references(markup.text_of(html))), F.lit("\n "))


def text_cache_key(url: Column, size: Column) -> Column:
    """Key of a file's cached text: its address and length, so that a changed file is read again."""
    return F.sha2(F.concat(url, size.cast("string")), 256)


def files(spark, path: str, most_bytes: int | None = None) -> DataFrame:
    """Files below a folder with their digest; larger ones are left out before their content is read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    if most_bytes is not None:
        df = df.where(F.col("length") <= most_bytes)
    return df.select("path", "length", F.sha2("content", 256).alias("sha256"), "content")


def seeds(spark, path: str) -> DataFrame:
    """municipality_key, name, county, state from a CSV list with a header; rows without a key or name are left out, of one key the first name stays."""
    rows = spark.read.option("header", True).schema("municipality_key string, name string, county string, state string").csv(path)
    known = rows.where("municipality_key is not null and name is not null")
    return known.groupBy("municipality_key").agg(F.min(F.struct("name", "county", "state")).alias("x")).select("municipality_key", "x.*")


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock times, for sheets that know no zone."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"})


def write_csv(frames: dict[str, DataFrame], folder: str) -> None:
    """A folder of CSV files per report."""
    for name, df in frames.items():
        without_zone(df).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def write_parquet(df: DataFrame, path: str, *by: str) -> None:
    (df.write.mode("overwrite").partitionBy(*by) if by else df.write.mode("overwrite")).parquet(path)


def write_workbook(frames: dict[str, DataFrame], path: str) -> str:
    """An Excel workbook of small reports where openpyxl is installed, else a folder of CSV files; the path written."""
    try:
        import openpyxl
        from openpyxl.styles import Font
    except ImportError:
        write_csv(frames, path + ".csv")
        return path + ".csv"
    book = openpyxl.Workbook()
    book.remove(book.active)
    for name, df in frames.items():
        sheet = book.create_sheet(name[:31])
        sheet.append(df.columns)
        for row in without_zone(df).toLocalIterator():
            sheet.append([str(v) if isinstance(v, (list, dict)) else v for v in row])
        for cell in sheet[1]:
            cell.font = Font(bold=True)
        for column in sheet.columns:
            sheet.column_dimensions[column[0].column_letter].width = min(50, 2 + max(len(str(x.value or "")) for x in column))
    book.save(path)
    return path
