"""The engine's tables bound to the driver's: who plays which part in the reports.

nation (with region) are the municipalities, orders the procedures and projects, lineitem the sources, part the
documents behind a source, events the job statistics, the fixture over documents the announcements.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import dealt

#: The reports' present moment; never the clock.
AS_OF = datetime(2024, 1, 31)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded pages, dealt out over the cores if they come in fewer files than those."""
    return dealt(read(spark, sf_dir, "pages"))


def seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """municipality_key, name, county, state: nations and their regions. 25 rows: a side that may be broadcast."""
    r = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("county"))
    return F.broadcast(read(spark, sf_dir, "nation").join(F.broadcast(r), "n_regionkey", "left").select(F.col("n_nationkey").alias("municipality_key"), F.col("n_name").alias("name"), "county", F.when(F.col("n_nationkey") % 2 == 0, "BB").otherwise("BE").alias("state")))


SEED_SQL = "seed AS (SELECT n_nationkey AS municipality_key, n_name AS name, r_name AS county, CASE WHEN n_nationkey % 2 = 0 THEN 'BB' ELSE 'BE' END AS state FROM nation LEFT JOIN region ON r_regionkey = n_regionkey)"

_KIND = "CASE o_orderstatus WHEN 'F' THEN 'BPLAN_SATZUNG' WHEN 'O' THEN 'UNKNOWN' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'PERMIT_36_EINVERNEHMEN' WHEN o_orderkey % 3 = 1 THEN 'PERMIT_BAUGENEHMIGUNG' END END"
_PROCEDURES = f"""o_orderkey AS procedure_id, c_nationkey AS municipality_key, o_custkey AS developer_id, 'Vorhaben ' || CAST(o_orderkey AS VARCHAR(20)) AS title, {_KIND} AS procedure_type,
CAST(o_orderkey % 9 AS INT) AS bess_score, CAST(o_orderkey % 5 AS INT) AS grid_score, CASE WHEN o_orderkey % 9 >= 3 AND o_orderkey % 5 >= 3 THEN 'high' WHEN o_orderkey % 9 >= 1 OR o_orderkey % 5 >= 1 THEN 'medium' ELSE 'low' END AS confidence,
CASE WHEN o_orderkey % 4 = 0 THEN CAST(NULL AS DOUBLE) ELSE o_totalprice / 1000 END AS capacity_mw, o_totalprice / 100000 AS score, o_orderkey % 6 = 0 AS review_recommended, CAST(o_orderdate AS DATE) AS seen,
CASE o_orderkey % 4 WHEN 0 THEN '§35' WHEN 1 THEN '§36' WHEN 2 THEN '§34' END AS legal_basis, CASE WHEN c_nationkey % 2 = 0 THEN 'BB' ELSE 'BE' END AS state"""
PROCEDURES_SQL = f"procedures AS (SELECT {_PROCEDURES} FROM orders LEFT JOIN customer ON c_custkey = o_custkey)"


def procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    cols = [x.strip() for x in _split(_PROCEDURES)]
    return o.join(c, "o_custkey", "left").selectExpr(*cols)


def _split(text: str) -> list[str]:
    """Top-level parts of a select list."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    return [*out, text[start:]]


_SOURCES = "l_orderkey * 10 + l_linenumber AS source_id, CASE WHEN l_returnflag = 'R' AND l_linenumber > 5 THEN CAST(NULL AS BIGINT) ELSE l_orderkey END AS procedure_id, l_partkey AS document_id, CASE l_linenumber % 4 WHEN 0 THEN 'RIS' WHEN 1 THEN 'AMTSBLATT' WHEN 2 THEN 'MUNICIPAL_WEBSITE' END AS discovery_source, CAST(l_shipdate AS DATE) AS source_date"
SOURCES_SQL = f"sources AS (SELECT {_SOURCES} FROM lineitem)"


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(*[x.strip() for x in _split(_SOURCES)])


_PROJECTS = "procedure_id AS project_id, municipality_key, title AS canonical_project_name, legal_basis AS legal_basis_best, capacity_mw AS capacity_mw_best, seen AS first_seen_date, least(CAST(1 AS DOUBLE), score) AS max_confidence, review_recommended AS needs_review, state, CASE procedure_type WHEN 'BPLAN_SATZUNG' THEN 'BPLAN_SATZUNG' WHEN 'PERMIT_36_EINVERNEHMEN' THEN 'PERMIT_36' WHEN 'PERMIT_BAUGENEHMIGUNG' THEN 'BAUGENEHMIGUNG' ELSE 'DISCOVERED' END AS maturity_stage"
#: Every fifth procedure founds a project; the others are linked to the project before them.
PROJECTS_SQL = f"projects AS (SELECT {_PROJECTS} FROM procedures WHERE procedure_id % 5 = 0), links AS (SELECT procedure_id - procedure_id % 5 AS project_id, procedure_id FROM procedures)"


def projects(procedures_: DataFrame) -> DataFrame:
    return procedures_.where("procedure_id % 5 = 0").selectExpr(*[x.strip() for x in _split(_PROJECTS)])


def project_links(procedures_: DataFrame) -> DataFrame:
    return procedures_.select((F.col("procedure_id") - F.col("procedure_id") % 5).alias("project_id"), "procedure_id")


#: Job statistics: the event type plays the source type, the JSON field k every counter.
STATS_SQL = """stats AS (SELECT event_id AS job_id, ts AS created_at, user_id % 25 AS municipality_key, 'run' || CAST(user_id % 3 AS VARCHAR(20)) AS run_id, 'host' || CAST(user_id % 11 AS VARCHAR(20)) AS domain,
  CASE event_type WHEN 'click' THEN 'RIS' WHEN 'view' THEN 'GAZETTE' WHEN 'purchase' THEN 'MUNICIPAL_WEBSITE' ELSE event_type END AS source_type, value AS total_ms, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k,
  CASE WHEN event_type = 'error' THEN 'ERROR_SSL' WHEN event_id % 7 = 0 THEN 'ERROR_NETWORK' WHEN event_id % 11 = 0 THEN 'ERROR_OTHER' ELSE 'SUCCESS' END AS source_status FROM events)"""


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, i = F.col("event_type"), F.col("event_id")
    number = lambda n: (F.col("user_id") % n)
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("job_id"), F.col("ts").alias("created_at"), number(25).alias("municipality_key"), F.concat(F.lit("run"), number(3).cast("string")).alias("run_id"),
        F.concat(F.lit("host"), number(11).cast("string")).alias("domain"), F.when(t == "click", "RIS").when(t == "view", "GAZETTE").when(t == "purchase", "MUNICIPAL_WEBSITE").otherwise(t).alias("source_type"),
        F.col("value").alias("total_ms"), F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.when(t == "error", "ERROR_SSL").when(i % 7 == 0, "ERROR_NETWORK").when(i % 11 == 0, "ERROR_OTHER").otherwise("SUCCESS").alias("source_status"),
    )
