"""Reports as plain text for a terminal. Their tables are short by nature or are top lists."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from . import announcements as N
from . import reports as R


def _cell(v: object) -> str:
    return "N/A" if v is None else f"{v:.2f}" if isinstance(v, float) else str(v)


def table(title: str, df: DataFrame, widths: dict[str, int]) -> Iterator[str]:
    """A heading, the named columns cut to their widths, and a line for each row."""
    yield title
    yield " ".join(name.ljust(w) for name, w in widths.items()).rstrip()
    yield "-" * (sum(widths.values()) + len(widths) - 1)
    for row in df.select(*widths).toLocalIterator():
        yield " ".join(_cell(row[name])[: w - 1].ljust(w) for name, w in widths.items()).rstrip()
    yield ""


def recall(spark: SparkSession, sf_dir: str) -> str:
    """What the gates leave out: skipped candidates by source, the best of them, procedures by source, projects, orphans."""
    projects, orphans = R.recall_projects(spark, sf_dir).first(), R.recall_orphans(spark, sf_dir).first()
    share = 100 * projects["privileged"] / projects["projects"] if projects["projects"] else 0.0
    lines = [
        *table("SKIPPED CANDIDATES BY SOURCE", N.recall_skipped(spark, sf_dir).orderBy("discovery_source", "status"), {"discovery_source": 20, "status": 15, "n": 10, "avg_score": 12}),
        *table("TOP SKIPPED TITLES", N.recall_top_skipped(spark, sf_dir), {"title": 60, "discovery_source": 15, "score": 10}),
        *table("PROCEDURES BY SOURCE", R.recall_by_source(spark, sf_dir).orderBy("discovery_source"), {"discovery_source": 20, "procedures": 10}),
        "PROJECTS", f"total {projects['projects']}, privileged {projects['privileged']} ({share:.1f} %)", "",
        "SKIPPED SOURCES", f"total {orphans['skipped_sources']}, kinds {orphans['source_kinds']}",
    ]
    return "\n".join(lines)
