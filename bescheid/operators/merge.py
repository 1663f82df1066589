"""Upserts as pure functions of two frames: what a table holds after a delta is merged into it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def last_wins(base: DataFrame, delta: DataFrame, key: list[str], order: str) -> DataFrame:
    """Rows of both by key; the delta's last row by `order` replaces the base's.

    The larger side is not ranked: base rows without a new one pass an anti join.
    """
    new = delta.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(F.col(order).desc_nulls_last()))).where("_n = 1").drop("_n")
    return base.join(new.select(*key), key, "left_anti").unionByName(new)


def first_wins(base: DataFrame, delta: DataFrame, key: list[str], order: str) -> DataFrame:
    """Base rows stay; of new keys the first row by `order` is added."""
    new = delta.join(base.select(*key), key, "left_anti")
    new = new.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(F.col(order).asc_nulls_last()))).where("_n = 1").drop("_n")
    return base.unionByName(new)


# What a procedure seen again replaces, and what stays as it was first seen.
PROCEDURE_REPLACED = [
    "title_raw", "title_norm", "status", "grid_score", "bess_score", "confidence", "developer_company", "capacity_mw", "capacity_mwh", "area_hectares", "decision_date", "procedure_type", "legal_basis",
    "project_components", "ambiguity_flag", "review_recommended", "site_location_raw", "evidence_snippets",
]
PROCEDURE_KEPT = ["instrument", "state", "county", "municipality", "municipality_key", "geometry", "bbox"]


def upsert(base: DataFrame, delta: DataFrame, key: list[str], order: str, replaced: list[str]) -> DataFrame:
    """Rows of both by key; where the base has the key, the delta's last row by `order` replaces the named columns only.

    The delta's last row is a pre-aggregated maximum; the base is joined once and not ranked.
    """
    rest = [x for x in base.columns if x not in key]
    last = delta.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_new"))
    both = base.select(*key, F.struct(*rest).alias("_old")).join(last, key, "full_outer")
    pick = lambda x: (F.when(F.col("_new").isNotNull(), F.col(f"_new.{x}")).otherwise(F.col(f"_old.{x}")) if x in replaced else F.when(F.col("_old").isNotNull(), F.col(f"_old.{x}")).otherwise(F.col(f"_new.{x}"))).alias(x)
    return both.select(*key, *[pick(x) for x in rest])


NEVER, EVER = "9999-12-31", "1900-01-01"


def project_policy(new: str = "n", old: str = "o") -> dict[str, Column]:
    """Column rules of the project upsert. Null capacities of both sides become 0, and two null dates the sentinel."""
    n, o = (lambda c: F.col(f"{new}.{c}")), (lambda c: F.col(f"{old}.{c}"))
    keep = lambda c: F.coalesce(n(c), o(c))
    most = lambda c: F.greatest(F.coalesce(n(c), F.lit(0.0)), F.coalesce(o(c), F.lit(0.0)))
    strong = ("§35", "§34")
    day = lambda v: F.lit(v).cast("date")
    return {
        "canonical_project_name": keep("canonical_project_name"), "site_location_best": keep("site_location_best"),
        "legal_basis_best": F.when(n("legal_basis_best").isin(*strong), n("legal_basis_best")).when(o("legal_basis_best").isin(*strong), o("legal_basis_best")).otherwise(keep("legal_basis_best")),
        "capacity_mw_best": most("capacity_mw_best"), "max_confidence": most("max_confidence"), "maturity_stage": n("maturity_stage"),
        "first_seen_date": F.least(F.coalesce(n("first_seen_date"), day(NEVER)), F.coalesce(o("first_seen_date"), day(NEVER))),
        "last_seen_date": F.greatest(F.coalesce(n("last_seen_date"), day(EVER)), F.coalesce(o("last_seen_date"), day(EVER))),
        "needs_review": n("needs_review") | o("needs_review"),
    }


def merge_projects(base: DataFrame, delta: DataFrame, key: str = "project_id") -> DataFrame:
    """A full outer join by key; where both sides have it, the column rules decide."""
    policy = project_policy()
    both = base.alias("o").join(delta.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    pick = lambda c: F.when(F.col(f"o.{key}").isNull(), F.col(f"n.{c}")).when(F.col(f"n.{key}").isNull(), F.col(f"o.{c}")).otherwise(policy[c]).alias(c)
    return both.select(F.coalesce(f"n.{key}", f"o.{key}").alias(key), *[pick(c) for c in policy])


def update_status(base: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """New status by key; a null reason keeps the old one; unknown keys are ignored."""
    d = delta.select(F.col(key), F.col("status").alias("_s"), F.col("reason").alias("_r"))
    rest = [c for c in base.columns if c not in ("status", "reason")]
    return base.join(d, key, "left").select(*rest, F.coalesce("_s", "status").alias("status"), F.when(F.col("_s").isNotNull(), F.coalesce("_r", "reason")).otherwise(F.col("reason")).alias("reason"))


def replace_partition(base: DataFrame, fresh: DataFrame, column: str, value) -> DataFrame:
    """All rows of one partition value give way to `fresh`."""
    return base.where(~F.coalesce(F.col(column) == F.lit(value), F.lit(False))).unionByName(fresh)


def backfill_json(df: DataFrame, column: str, field: str, value: Column) -> DataFrame:
    """`field` added to the JSON object of `column` where it is absent."""
    absent = F.get_json_object(column, f"$.{field}").isNull()
    added = F.concat(F.regexp_replace(F.col(column), r"\}\s*$", ""), F.when(F.col(column).rlike(r"^\s*\{\s*\}"), "").otherwise(","), F.lit(f'"{field}":"'), value, F.lit('"}'))
    return df.withColumn(column, F.when(absent, added).otherwise(F.col(column)))


def flag_reviews(projects: DataFrame, links: DataFrame, procedures: DataFrame) -> DataFrame:
    """needs_review where any linked procedure asks for one."""
    asked = links.join(procedures.where("review_recommended"), "procedure_id").select("project_id").distinct().withColumn("_asked", F.lit(True))
    return projects.join(asked, "project_id", "left").withColumn("needs_review", F.col("needs_review") | F.coalesce("_asked", F.lit(False))).drop("_asked")
