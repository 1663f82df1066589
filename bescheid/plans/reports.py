"""Coverage, bottleneck, recall, monitoring and export reports. Fan-outs are aggregated before they are joined."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import distinct
from . import bindings as B
from .base import Book

BOOK = Book()
query = BOOK.query

_NTZ = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
_AS_OF = f"TIMESTAMP '{B.AS_OF.isoformat(sep=' ')}'"
_PS = f"{B.PROCEDURES_SQL}, {B.SOURCES_SQL}"
_ALL = f"{B.SEED_SQL}, {_PS}, {B.PROJECTS_SQL}"


def known(kind: str = "procedure_type"):
    return F.col(kind).isNotNull() & (F.col(kind) != "UNKNOWN")


def per_procedure(src: DataFrame) -> DataFrame:
    """Sources and documents of each procedure, counted before any join."""
    return src.where("procedure_id is not null").groupBy("procedure_id").agg(F.count_distinct("source_id").alias("sources"), F.count_distinct("document_id").alias("documents"))


@query("due_municipalities", f"""WITH {B.SEED_SQL}, {B.STATS_SQL}
SELECT s.municipality_key, name, CAST(last AS DATE) AS last_day FROM seed s LEFT JOIN (SELECT municipality_key, max(created_at) AS last FROM stats WHERE source_type = 'signup' GROUP BY 1) x ON x.municipality_key = s.municipality_key
WHERE last IS NULL OR last < {_AS_OF} - INTERVAL 1 DAY - INTERVAL 12 HOUR ORDER BY last NULLS FIRST, s.municipality_key LIMIT 10""")
def due_municipalities(spark: SparkSession, d: str) -> DataFrame:
    last = B.stats(spark, d).where("source_type = 'signup'").groupBy("municipality_key").agg(F.max("created_at").alias("last"))
    due = F.col("last").isNull() | (F.col("last") < _NTZ(B.AS_OF - timedelta(days=1, hours=12)))
    return B.seed(spark, d).join(last, "municipality_key", "left").where(due).orderBy(F.col("last").asc_nulls_first(), "municipality_key").limit(10).select("municipality_key", "name", F.col("last").cast("date").alias("last_day"))


@query("export_procedures", f"""WITH {_PS}
SELECT p.procedure_id, title, bess_score, grid_score, confidence, capacity_mw, count(DISTINCT s.source_id) AS source_count, count(DISTINCT s.document_id) AS document_count
FROM procedures p LEFT JOIN sources s ON s.procedure_id = p.procedure_id GROUP BY ALL""")
def export_procedures(spark: SparkSession, d: str) -> DataFrame:
    p = B.procedures(spark, d).select("procedure_id", "title", "bess_score", "grid_score", "confidence", "capacity_mw")
    return p.join(per_procedure(B.sources(spark, d)), "procedure_id", "left").select(
        *p.columns, F.coalesce("sources", F.lit(0)).alias("source_count"), F.coalesce("documents", F.lit(0)).alias("document_count")
    )


@query("summary_metrics", f"""WITH {_PS}, m AS (SELECT count(*) AS a, count(*) FILTER (bess_score >= 1) AS b, count(*) FILTER (bess_score >= 3) AS c, count(*) FILTER (grid_score >= 1) AS d, count(*) FILTER (grid_score >= 3) AS e,
  count(*) FILTER (confidence = 'high') AS f, count(*) FILTER (confidence = 'medium') AS g, count(capacity_mw) AS h, round(avg(bess_score), 4) AS i, round(avg(grid_score), 4) AS j, round(sum(capacity_mw), 2) AS k FROM procedures)
UNPIVOT (SELECT CAST(a AS DOUBLE) AS total, CAST(b AS DOUBLE) AS storage_1, CAST(c AS DOUBLE) AS storage_3, CAST(d AS DOUBLE) AS grid_1, CAST(e AS DOUBLE) AS grid_3, CAST(f AS DOUBLE) AS high, CAST(g AS DOUBLE) AS medium, CAST(h AS DOUBLE) AS with_capacity, i AS avg_storage, j AS avg_grid, k AS total_mw FROM m)
ON COLUMNS(*) INTO NAME metric VALUE value""")
def summary_metrics(spark: SparkSession, d: str) -> DataFrame:
    n = lambda c: F.count_if(c).cast("double")
    m = B.procedures(spark, d).agg(
        F.count("*").cast("double").alias("total"), n(F.col("bess_score") >= 1).alias("storage_1"), n(F.col("bess_score") >= 3).alias("storage_3"), n(F.col("grid_score") >= 1).alias("grid_1"),
        n(F.col("grid_score") >= 3).alias("grid_3"), n(F.col("confidence") == "high").alias("high"), n(F.col("confidence") == "medium").alias("medium"), F.count("capacity_mw").cast("double").alias("with_capacity"),
        F.round(F.avg("bess_score"), 4).alias("avg_storage"), F.round(F.avg("grid_score"), 4).alias("avg_grid"), F.round(F.sum("capacity_mw"), 2).alias("total_mw"),
    )
    return m.unpivot([], m.columns, "metric", "value")


def _covered(spark: SparkSession, d: str) -> DataFrame:
    p = B.procedures(spark, d).where("state = 'BB'").groupBy("municipality_key").agg(
        F.count("*").alias("procedures"), F.count_if(known()).alias("known"), F.count_if("review_recommended").alias("reviews")
    )
    return B.seed(spark, d).where("state = 'BB'").join(p, "municipality_key", "left")


_COVERED = f"{B.SEED_SQL}, {_PS}, j AS (SELECT s.municipality_key, s.name, s.county, p.procedure_id, p.procedure_type FROM seed s LEFT JOIN procedures p ON p.municipality_key = s.municipality_key AND p.state = 'BB' WHERE s.state = 'BB')"
_COUNTS = "count(DISTINCT municipality_key) AS municipalities, count(DISTINCT CASE WHEN procedure_id IS NOT NULL THEN municipality_key END) AS covered, count(DISTINCT procedure_id) AS procedures, count(DISTINCT CASE WHEN procedure_type <> 'UNKNOWN' THEN procedure_id END) AS known_procedures"


def _counts() -> list:
    return [
        F.count("municipality_key").alias("municipalities"), F.count("procedures").alias("covered"), F.coalesce(F.sum("procedures"), F.lit(0)).alias("procedures"), F.coalesce(F.sum("known"), F.lit(0)).alias("known_procedures"),
    ]


@query("coverage_overall", f"WITH {_COVERED} SELECT {_COUNTS}, round(100.0 * count(DISTINCT CASE WHEN procedure_id IS NOT NULL THEN municipality_key END) / nullif(count(DISTINCT municipality_key), 0), 4) AS percent FROM j")
def coverage_overall(spark: SparkSession, d: str) -> DataFrame:
    return _covered(spark, d).agg(*_counts()).withColumn("percent", F.round(F.when(F.col("municipalities") > 0, F.col("covered") / F.col("municipalities") * 100), 4))


@query("coverage_by_county", f"WITH {_COVERED} SELECT county, {_COUNTS} FROM j GROUP BY county")
def coverage_by_county(spark: SparkSession, d: str) -> DataFrame:
    return _covered(spark, d).groupBy("county").agg(*_counts())


@query("coverage_top_municipalities", f"""WITH {_COVERED}
SELECT name, county, count(DISTINCT j.procedure_id) AS procedures, count(DISTINCT s.source_id) AS sources, count(DISTINCT s.document_id) AS documents FROM j LEFT JOIN sources s ON s.procedure_id = j.procedure_id
GROUP BY name, county HAVING count(DISTINCT j.procedure_id) > 0 ORDER BY procedures DESC, name LIMIT 50""")
def coverage_top_municipalities(spark: SparkSession, d: str) -> DataFrame:
    p = B.procedures(spark, d).where("state = 'BB'").select("procedure_id", "municipality_key")
    s = B.sources(spark, d).where("procedure_id is not null").select("procedure_id", "source_id", "document_id")
    # sources belong to one procedure; documents are shared, so pairs come before the count
    n = p.groupBy("municipality_key").agg(F.count("*").alias("procedures"))
    ps = s.join(p, "procedure_id")
    m = ps.groupBy("municipality_key").agg(F.count_distinct("source_id").alias("sources"), F.count_distinct("document_id").alias("documents"))
    return B.seed(spark, d).where("state = 'BB'").join(n, "municipality_key").join(m, "municipality_key", "left").select("name", "county", "procedures", F.coalesce("sources", F.lit(0)).alias("sources"), F.coalesce("documents", F.lit(0)).alias("documents")).orderBy(F.desc("procedures"), "name").limit(50)


_LEVELS = [[], ["county"], ["county", "name"]]
_SETS = "CAST(2 - grouping(county) - grouping(name) AS INTEGER) AS level, county, name"


def _by_delta(rows: DataFrame, by: list[str], key: str, counted: dict) -> DataFrame:
    """States of the rows with even keys, and of the others as a delta that merges with them."""
    return distinct.merged(*[distinct.states(rows.where(F.col(key) % 2 == k), by, counted) for k in (0, 1)])


@query("coverage_levels", f"""WITH {B.SEED_SQL}, {_PS}, j AS (SELECT s.county, s.name, s.municipality_key, p.procedure_id, p.procedure_type, x.source_id, x.document_id FROM procedures p JOIN seed s ON s.municipality_key = p.municipality_key AND s.state = 'BB' AND p.state = 'BB' LEFT JOIN sources x ON x.procedure_id = p.procedure_id)
SELECT {_SETS}, count(DISTINCT municipality_key) AS municipalities, count(DISTINCT procedure_id) AS procedures, count(DISTINCT CASE WHEN procedure_type <> 'UNKNOWN' THEN procedure_id END) AS known_procedures, count(DISTINCT source_id) AS sources, count(DISTINCT document_id) AS documents FROM j GROUP BY GROUPING SETS ((), (county), (county, name))""")
def coverage_levels(spark: SparkSession, d: str) -> DataFrame:
    """Coverage of the state, its counties and municipalities from one scan of the sources, by bitmaps."""
    p = B.procedures(spark, d).where("state = 'BB'").select("procedure_id", "municipality_key", "procedure_type")
    s = B.sources(spark, d).where("procedure_id is not null").select("procedure_id", "source_id", "document_id")
    rows = p.join(s, "procedure_id", "left").join(B.seed(spark, d).where("state = 'BB'").select("municipality_key", "county", "name"), "municipality_key")
    counted = {"municipalities": F.col("municipality_key"), "procedures": F.col("procedure_id"), "known_procedures": F.when(known(), F.col("procedure_id")), "sources": F.col("source_id"), "documents": F.col("document_id")}
    return distinct.counts(_by_delta(rows, ["county", "name"], "procedure_id", counted), _LEVELS, list(counted))


@query("coverage_by_source", f"WITH {_PS} SELECT coalesce(discovery_source, 'UNKNOWN') AS source, count(DISTINCT p.procedure_id) AS procedures, count(DISTINCT CASE WHEN procedure_type <> 'UNKNOWN' THEN p.procedure_id END) AS known_procedures FROM procedures p LEFT JOIN sources s ON s.procedure_id = p.procedure_id GROUP BY discovery_source")
def coverage_by_source(spark: SparkSession, d: str) -> DataFrame:
    pairs = B.sources(spark, d).where("procedure_id is not null").select("procedure_id", "discovery_source").distinct()
    p = B.procedures(spark, d).select("procedure_id", "procedure_type").join(pairs, "procedure_id", "left")
    return p.groupBy("discovery_source").agg(F.count("*").alias("procedures"), F.count_if(known()).alias("known_procedures")).select(F.coalesce("discovery_source", F.lit("UNKNOWN")).alias("source"), "procedures", "known_procedures")


_PROJ = f"{B.SEED_SQL}, {_PS}, {B.PROJECTS_SQL}, j AS (SELECT s.municipality_key, s.name, s.county, p.project_id, p.maturity_stage, p.legal_basis_best FROM seed s LEFT JOIN projects p ON p.municipality_key = s.municipality_key AND p.state = 'BB' WHERE s.state = 'BB')"
_PCOUNTS = "count(DISTINCT CASE WHEN project_id IS NOT NULL THEN municipality_key END) AS covered, count(DISTINCT project_id) AS projects, count(DISTINCT CASE WHEN legal_basis_best IN ('§35', '§36') THEN project_id END) AS privileged, count(DISTINCT CASE WHEN maturity_stage LIKE 'BPLAN%' THEN project_id END) AS plans"


def _projects(spark: SparkSession, d: str) -> DataFrame:
    p = B.projects(B.procedures(spark, d)).where("state = 'BB'").groupBy("municipality_key").agg(F.count("*").alias("n"), F.count_if(F.col("legal_basis_best").isin("§35", "§36")).alias("priv"), F.count_if(F.col("maturity_stage").startswith("BPLAN")).alias("pl"))
    return B.seed(spark, d).where("state = 'BB'").join(p, "municipality_key", "left")


def _pcounts() -> list:
    s = lambda c, a: F.coalesce(F.sum(c), F.lit(0)).alias(a)
    return [F.count("n").alias("covered"), s("n", "projects"), s("priv", "privileged"), s("pl", "plans")]


@query("project_coverage_overall", f"WITH {_PROJ} SELECT {_PCOUNTS} FROM j")
def project_coverage_overall(spark: SparkSession, d: str) -> DataFrame:
    return _projects(spark, d).agg(*_pcounts())


@query("project_coverage_by_county", f"WITH {_PROJ} SELECT county, {_PCOUNTS} FROM j GROUP BY county")
def project_coverage_by_county(spark: SparkSession, d: str) -> DataFrame:
    return _projects(spark, d).groupBy("county").agg(*_pcounts())


@query("project_coverage_levels", f"WITH {_PROJ} SELECT {_SETS}, {_PCOUNTS} FROM j WHERE project_id IS NOT NULL GROUP BY GROUPING SETS ((), (county), (county, name))")
def project_coverage_levels(spark: SparkSession, d: str) -> DataFrame:
    """Projects at all three levels from one scan, by bitmaps."""
    rows = B.projects(B.procedures(spark, d)).where("state = 'BB'").join(B.seed(spark, d).where("state = 'BB'").select("municipality_key", "county", "name"), "municipality_key")
    counted = {"covered": F.col("municipality_key"), "projects": F.col("project_id"), "privileged": F.when(F.col("legal_basis_best").isin("§35", "§36"), F.col("project_id")), "plans": F.when(F.col("maturity_stage").startswith("BPLAN"), F.col("project_id"))}
    return distinct.counts(_by_delta(rows, ["county", "name"], "project_id", counted), _LEVELS, list(counted))


@query("project_coverage_top", f"WITH {_PROJ} SELECT name, county, count(DISTINCT project_id) AS projects FROM j GROUP BY name, county HAVING count(DISTINCT project_id) > 0 ORDER BY projects DESC, name LIMIT 50")
def project_coverage_top(spark: SparkSession, d: str) -> DataFrame:
    return _projects(spark, d).where("n > 0").select("name", "county", F.col("n").alias("projects")).orderBy(F.desc("projects"), "name").limit(50)


@query("project_coverage_by_maturity", f"WITH {_ALL} SELECT maturity_stage, count(*) AS projects FROM projects WHERE state = 'BB' GROUP BY 1")
def project_coverage_by_maturity(spark: SparkSession, d: str) -> DataFrame:
    return B.projects(B.procedures(spark, d)).where("state = 'BB'").groupBy("maturity_stage").agg(F.count("*").alias("projects"))


_KINDS = (("ris", "RIS"), ("amtsblatt", "GAZETTE"), ("municipal", "MUNICIPAL_WEBSITE"))
_PIVOT = f"""{B.SEED_SQL}, {B.STATS_SQL}, v AS (SELECT t.municipality_key, name, county, count(DISTINCT job_id) AS jobs, sum(k) AS candidates, {', '.join(f"max(CASE WHEN source_type = '{s}' THEN source_status END) AS {n}_status" for n, s in _KINDS)}
FROM stats t LEFT JOIN seed m ON m.municipality_key = t.municipality_key WHERE created_at > {_AS_OF} - INTERVAL 48 HOUR GROUP BY t.municipality_key, name, county)"""


def _pivot(spark: SparkSession, d: str) -> DataFrame:
    s = B.stats(spark, d).where(F.col("created_at") > _NTZ(B.AS_OF - timedelta(hours=48)))
    status = [F.max(F.when(F.col("source_type") == k, F.col("source_status"))).alias(f"{n}_status") for n, k in _KINDS]
    return s.groupBy("municipality_key").agg(F.count_distinct("job_id").alias("jobs"), F.sum("k").alias("candidates"), *status).join(B.seed(spark, d).select("municipality_key", "name", "county"), "municipality_key", "left")


@query("source_status_pivot", f"WITH {_PIVOT} SELECT municipality_key, name, county, jobs, CAST(candidates AS BIGINT) AS candidates, ris_status, amtsblatt_status, municipal_status FROM v")
def source_status_pivot(spark: SparkSession, d: str) -> DataFrame:
    return _pivot(spark, d).select("municipality_key", "name", "county", "jobs", "candidates", "ris_status", "amtsblatt_status", "municipal_status")


@query("source_status_totals", f"WITH {_PIVOT} SELECT count(*) AS municipalities, count(*) FILTER (candidates > 0) AS with_candidates, count(*) FILTER (ris_status LIKE '%ERROR%' OR amtsblatt_status LIKE '%ERROR%' OR municipal_status LIKE '%ERROR%') AS with_errors, count(*) FILTER (ris_status LIKE '%ERROR%') AS ris_errors FROM v")
def source_status_totals(spark: SparkSession, d: str) -> DataFrame:
    bad = lambda n: F.coalesce(F.col(f"{n}_status").contains("ERROR"), F.lit(False))
    return _pivot(spark, d).agg(F.count("*").alias("municipalities"), F.count_if(F.col("candidates") > 0).alias("with_candidates"), F.count_if(bad("ris") | bad("amtsblatt") | bad("municipal")).alias("with_errors"), F.count_if(bad("ris")).alias("ris_errors"))


@query("source_status_last", f"WITH {B.STATS_SQL}, x AS (SELECT municipality_key, source_type, max_by(source_status, created_at) AS status, sum(k) AS k FROM (SELECT *, row_number() OVER (PARTITION BY created_at, municipality_key, source_type ORDER BY job_id DESC) AS r FROM stats) WHERE r = 1 GROUP BY ALL) SELECT municipality_key, source_type, status, CAST(k AS BIGINT) AS k FROM x")
def source_status_last(spark: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("created_at", "municipality_key", "source_type").orderBy(F.desc("job_id"))
    s = B.stats(spark, d).withColumn("r", F.row_number().over(w)).where("r = 1")
    return s.groupBy("municipality_key", "source_type").agg(F.max_by("source_status", "created_at").alias("status"), F.sum("k").alias("k"))


def _bottlenecks(s: DataFrame) -> DataFrame:
    return s.groupBy("domain", "source_type").agg(F.count("*").alias("jobs"), F.round(F.avg("total_ms"), 4).alias("avg_total_ms"), F.round(F.avg("k"), 4).alias("avg_k"), F.sum("k").alias("total_k")).orderBy(F.desc("avg_total_ms"), "domain", "source_type").limit(20)


_BOTTLENECKS = "SELECT domain, source_type, count(*) AS jobs, round(avg(total_ms), 4) AS avg_total_ms, round(avg(k), 4) AS avg_k, CAST(sum(k) AS BIGINT) AS total_k FROM stats {w} GROUP BY 1, 2 ORDER BY avg_total_ms DESC, domain, source_type LIMIT 20"


@query("bottlenecks", f"WITH {B.STATS_SQL} {_BOTTLENECKS.format(w='')}")
def bottlenecks(spark: SparkSession, d: str) -> DataFrame:
    return _bottlenecks(B.stats(spark, d))


@query("bottlenecks_by_run", f"WITH {B.STATS_SQL} " + _BOTTLENECKS.format(w="WHERE run_id = 'run1'"))
def bottlenecks_by_run(spark: SparkSession, d: str) -> DataFrame:
    return _bottlenecks(B.stats(spark, d).where("run_id = 'run1'"))


@query("recall_orphans", f"WITH {B.SOURCES_SQL} SELECT count(*) AS skipped_sources, count(DISTINCT discovery_source) AS source_kinds FROM sources WHERE procedure_id IS NULL AND discovery_source IS NOT NULL")
def recall_orphans(spark: SparkSession, d: str) -> DataFrame:
    return B.sources(spark, d).where("procedure_id is null and discovery_source is not null").agg(F.count("*").alias("skipped_sources"), F.count_distinct("discovery_source").alias("source_kinds"))


@query("recall_by_source", f"WITH {_PS} SELECT discovery_source, count(DISTINCT p.procedure_id) AS procedures, count(DISTINCT CASE WHEN procedure_type = 'UNKNOWN' THEN p.procedure_id END) AS unknown, count(DISTINCT CASE WHEN review_recommended THEN p.procedure_id END) AS reviews FROM procedures p JOIN sources s ON s.procedure_id = p.procedure_id WHERE state = 'BB' GROUP BY 1")
def recall_by_source(spark: SparkSession, d: str) -> DataFrame:
    pairs = B.sources(spark, d).where("procedure_id is not null").select("procedure_id", "discovery_source").distinct()
    p = B.procedures(spark, d).where("state = 'BB'").select("procedure_id", "procedure_type", "review_recommended").join(pairs, "procedure_id")
    return p.groupBy("discovery_source").agg(F.count("*").alias("procedures"), F.count_if(F.col("procedure_type") == "UNKNOWN").alias("unknown"), F.count_if("review_recommended").alias("reviews"))


@query("recall_projects", f"WITH {_ALL} SELECT count(*) AS projects, count(*) FILTER (legal_basis_best IN ('§35', '§36')) AS privileged, count(*) FILTER (maturity_stage IN ('PERMIT_36', 'BAUVORBESCHEID', 'BAUGENEHMIGUNG')) AS permits, count(*) FILTER (needs_review) AS reviews FROM projects WHERE state = 'BB'")
def recall_projects(spark: SparkSession, d: str) -> DataFrame:
    p = B.projects(B.procedures(spark, d)).where("state = 'BB'")
    return p.agg(F.count("*").alias("projects"), F.count_if(F.col("legal_basis_best").isin("§35", "§36")).alias("privileged"), F.count_if(F.col("maturity_stage").isin("PERMIT_36", "BAUVORBESCHEID", "BAUGENEHMIGUNG")).alias("permits"), F.count_if("needs_review").alias("reviews"))


def _export(spark: SparkSession, d: str, high: bool) -> DataFrame:
    procs = B.procedures(spark, d)
    p, links = B.projects(procs).where("state = 'BB'"), B.project_links(procs)
    kinds = procs.select("procedure_id", "procedure_type")
    linked = links.join(kinds, "procedure_id")
    if high:
        p = p.where("max_confidence >= 0.6").join(linked.where(known()), "project_id", "left_semi")
    src = B.sources(spark, d).where("procedure_id is not null")
    # only what belongs to a listed project is counted, and each distinct count has a pass of its own: together they hold each row twice
    listed = links.join(p.select("project_id"), "project_id", "left_semi")
    of = src.join(listed, "procedure_id").select("project_id", "source_id", "document_id")
    distinct = lambda x, a: of.groupBy("project_id").agg(F.count_distinct(x).alias(a))
    n = linked.groupBy("project_id").agg(F.count("*").alias("procedures"), F.count_if(known()).alias("known"))
    z = lambda c, a: F.coalesce(c, F.lit(0)).alias(a)
    return p.join(n, "project_id", "left").join(distinct("source_id", "sources"), "project_id", "left").join(distinct("document_id", "documents"), "project_id", "left").select(
        "project_id", "municipality_key", "canonical_project_name", "maturity_stage", "legal_basis_best", "capacity_mw_best", "first_seen_date", F.round("max_confidence", 6).alias("max_confidence"), "needs_review",
        z("procedures", "number_of_procedures"), z("known", "number_of_known_procedures"), z("sources", "number_of_sources"), z("documents", "number_of_documents"),
    )


_EXPORT = f"""WITH {_ALL} SELECT pe.project_id, municipality_key, canonical_project_name, maturity_stage, legal_basis_best, capacity_mw_best, first_seen_date, round(max_confidence, 6) AS max_confidence, needs_review,
count(DISTINCT pp.procedure_id) AS number_of_procedures, count(DISTINCT CASE WHEN p.procedure_type <> 'UNKNOWN' THEN p.procedure_id END) AS number_of_known_procedures, count(DISTINCT s.source_id) AS number_of_sources, count(DISTINCT s.document_id) AS number_of_documents
FROM projects pe LEFT JOIN links pp ON pp.project_id = pe.project_id LEFT JOIN (SELECT procedure_id, procedure_type FROM procedures) p ON p.procedure_id = pp.procedure_id LEFT JOIN (SELECT source_id, document_id, procedure_id AS pid FROM sources) s ON s.pid = p.procedure_id
WHERE pe.state = 'BB'"""


@query("projects_export", _EXPORT + " GROUP BY ALL")
def projects_export(spark: SparkSession, d: str) -> DataFrame:
    return _export(spark, d, False)


@query("projects_high_confidence", _EXPORT + " AND pe.max_confidence >= 0.6 AND EXISTS (SELECT 1 FROM links l2 JOIN procedures p2 ON p2.procedure_id = l2.procedure_id WHERE l2.project_id = pe.project_id AND p2.procedure_type IS NOT NULL AND p2.procedure_type <> 'UNKNOWN') GROUP BY ALL")
def projects_high_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _export(spark, d, True)


@query("project_timeline", f"WITH {_ALL} SELECT l.project_id, p.procedure_id, p.seen, p.procedure_type, s.discovery_source, s.source_id FROM links l JOIN procedures p ON p.procedure_id = l.procedure_id LEFT JOIN sources s ON s.procedure_id = p.procedure_id")
def project_timeline(spark: SparkSession, d: str) -> DataFrame:
    procs = B.procedures(spark, d)
    p = B.project_links(procs).join(procs.select("procedure_id", "seen", "procedure_type"), "procedure_id")
    return p.join(B.sources(spark, d).where("procedure_id is not null").select("procedure_id", "discovery_source", "source_id"), "procedure_id", "left").select("project_id", "procedure_id", "seen", "procedure_type", "discovery_source", "source_id")


@query("diagnostics", f"""WITH {_ALL} SELECT 'procedures_total' AS metric, count(*) AS value FROM procedures WHERE state = 'BB' UNION ALL SELECT 'sources_without_procedure', count(*) FROM sources WHERE procedure_id IS NULL
UNION ALL SELECT 'valid_procedures', count(*) FROM procedures WHERE state = 'BB' AND procedure_type IS NOT NULL UNION ALL SELECT 'projects_total', count(*) FROM projects WHERE state = 'BB'
UNION ALL SELECT 'projects_' || maturity_stage, count(*) FROM projects WHERE state = 'BB' GROUP BY maturity_stage
UNION ALL SELECT * FROM (SELECT 'projects_county_' || county AS metric, count(*) AS value FROM projects p JOIN seed s ON s.municipality_key = p.municipality_key WHERE p.state = 'BB' GROUP BY county ORDER BY value DESC, metric LIMIT 10)
UNION ALL SELECT 'source_' || coalesce(discovery_source, 'UNKNOWN'), count(DISTINCT p.procedure_id) FROM procedures p LEFT JOIN sources s ON s.procedure_id = p.procedure_id GROUP BY discovery_source""")
def diagnostics(spark: SparkSession, d: str) -> DataFrame:
    procs, src = B.procedures(spark, d), B.sources(spark, d)
    bb = procs.where("state = 'BB'")
    pr = B.projects(procs).where("state = 'BB'")
    one = lambda df, name: df.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value")
    counties = pr.join(B.seed(spark, d).select("municipality_key", "county"), "municipality_key").groupBy("county").agg(F.count("*").alias("value")).select(F.concat(F.lit("projects_county_"), "county").alias("metric"), "value").orderBy(F.desc("value"), "metric").limit(10)
    pairs = src.where("procedure_id is not null").select("procedure_id", "discovery_source").distinct()
    by = procs.select("procedure_id").join(pairs, "procedure_id", "left").groupBy("discovery_source").agg(F.count("*").alias("value")).select(F.concat(F.lit("source_"), F.coalesce("discovery_source", F.lit("UNKNOWN"))).alias("metric"), "value")
    parts = [one(bb, "procedures_total"), one(src.where("procedure_id is null"), "sources_without_procedure"), one(bb.where("procedure_type is not null"), "valid_procedures"), one(pr, "projects_total")]
    parts += [pr.groupBy("maturity_stage").agg(F.count("*").alias("value")).select(F.concat(F.lit("projects_"), "maturity_stage").alias("metric"), "value"), counties, by]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("monitor_totals", f"WITH {_PS} SELECT count(*) AS procedures, count(CASE WHEN bess_score >= 1 THEN 1 END) AS storage_1, count(CASE WHEN bess_score >= 3 THEN 1 END) AS storage_3, count(CASE WHEN confidence = 'high' THEN 1 END) AS high, count(capacity_mw) AS with_capacity FROM procedures")
def monitor_totals(spark: SparkSession, d: str) -> DataFrame:
    return B.procedures(spark, d).agg(F.count("*").alias("procedures"), F.count_if(F.col("bess_score") >= 1).alias("storage_1"), F.count_if(F.col("bess_score") >= 3).alias("storage_3"), F.count_if(F.col("confidence") == "high").alias("high"), F.count("capacity_mw").alias("with_capacity"))


@query("by_source_system", f"WITH {_PS} SELECT discovery_source, count(*) AS rows_joined, count(CASE WHEN bess_score >= 3 THEN 1 END) AS storage_3 FROM procedures p LEFT JOIN sources s ON s.procedure_id = p.procedure_id GROUP BY 1")
def by_source_system(spark: SparkSession, d: str) -> DataFrame:
    s = B.sources(spark, d).where("procedure_id is not null").groupBy("procedure_id", "discovery_source").agg(F.count("*").alias("n"))
    p = B.procedures(spark, d).select("procedure_id", "bess_score").join(s, "procedure_id", "left")
    n = F.coalesce("n", F.lit(1))
    return p.groupBy("discovery_source").agg(F.sum(n).alias("rows_joined"), F.sum(F.when(F.col("bess_score") >= 3, n).otherwise(0)).alias("storage_3"))


@query("eta", f"WITH {_PS} SELECT discovery_source, count(*) AS n, round(count(*) / 60.0, 4) AS portal_minutes, round(count(*) / 150.0, 4) AS queue_minutes FROM procedures p LEFT JOIN sources s ON s.procedure_id = p.procedure_id GROUP BY 1")
def eta(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("rows_joined")
    return by_source_system(spark, d).select("discovery_source", n.alias("n"), F.round(n / 60, 4).alias("portal_minutes"), F.round(n / 150, 4).alias("queue_minutes"))


@query("recent_activity", f"WITH {B.STATS_SQL} SELECT count(*) AS jobs, CAST(coalesce(sum(k), 0) AS BIGINT) AS k, count(DISTINCT municipality_key) AS municipalities FROM stats WHERE created_at > {_AS_OF} - INTERVAL 36 HOUR")
def recent_activity(spark: SparkSession, d: str) -> DataFrame:
    return B.stats(spark, d).where(F.col("created_at") > _NTZ(B.AS_OF - timedelta(hours=36))).agg(F.count("*").alias("jobs"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"), F.count_distinct("municipality_key").alias("municipalities"))


@query("poll_delta", f"WITH {B.STATS_SQL}, d AS (SELECT CAST(created_at AS DATE) AS day, count(*) AS jobs FROM stats GROUP BY 1) SELECT day, jobs, jobs - lag(jobs) OVER (ORDER BY day) AS delta FROM d")
def poll_delta(spark: SparkSession, d: str) -> DataFrame:
    days = B.stats(spark, d).groupBy(F.col("created_at").cast("date").alias("day")).agg(F.count("*").alias("jobs"))
    return days.select("day", "jobs", (F.col("jobs") - F.lag("jobs").over(W.orderBy("day"))).alias("delta"))  # a row a day


@query("seed_listing", f"WITH {B.SEED_SQL} SELECT municipality_key, name, county, state FROM seed WHERE state = 'BB'")
def seed_listing(spark: SparkSession, d: str) -> DataFrame:
    return B.seed(spark, d).where("state = 'BB'").select("municipality_key", "name", "county", "state").orderBy("name")


@query("high_confidence_procedures", f"SELECT * FROM ({BOOK.sql['export_procedures']}) WHERE confidence = 'high'")
def high_confidence_procedures(spark: SparkSession, d: str) -> DataFrame:
    return export_procedures(spark, d).where("confidence = 'high'")
