"""Workbooks and CSV folders of the reports."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.store import write_csv, write_workbook
from . import reports as R


def procedures_workbook(spark: SparkSession, sf_dir: str, path: str) -> str:
    """All procedures, those of high confidence, and the summary; the path written."""
    all_ = R.export_procedures(spark, sf_dir).orderBy(F.desc("bess_score"), F.desc("grid_score"), "procedure_id")
    return write_workbook({"all": all_, "high_confidence": all_.where("confidence = 'high'"), "summary": R.summary_metrics(spark, sf_dir)}, path)


def projects_workbook(spark: SparkSession, sf_dir: str, path: str) -> str:
    """All projects, the trusted ones, the timeline and the diagnostics; the path written."""
    return write_workbook({
        "all_projects": R.projects_export(spark, sf_dir).orderBy(F.desc("first_seen_date"), "maturity_stage", "project_id"),
        "high_confidence": R.projects_high_confidence(spark, sf_dir).orderBy(F.desc("max_confidence"), F.desc("first_seen_date"), "project_id"),
        "timeline": R.project_timeline(spark, sf_dir).orderBy("project_id", "seen", "procedure_id", "source_id"), "diagnostics": R.diagnostics(spark, sf_dir),
    }, path)


def coverage_csv(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Coverage of procedures and of projects: overall, by county, top municipalities."""
    write_csv({
        "overall": R.coverage_overall(spark, sf_dir), "by_county": R.coverage_by_county(spark, sf_dir), "top": R.coverage_top_municipalities(spark, sf_dir),
        "projects_overall": R.project_coverage_overall(spark, sf_dir), "projects_by_county": R.project_coverage_by_county(spark, sf_dir), "projects_top": R.project_coverage_top(spark, sf_dir),
    }, folder)
