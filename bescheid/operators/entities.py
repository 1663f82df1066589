"""Project entities: signatures, linking of procedures, rollups and stages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import terms as T
from . import extract

LINK_SCHEMA = "municipality_key string, procedure_id long, project_id string, link_confidence double, link_reason string"


def signatures(df: DataFrame) -> DataFrame:
    """`df` (title, evidence_snippets, location, company) with its tokens."""
    text = F.concat_ws(" ", F.col("title"), F.array_join(F.slice("evidence_snippets", 1, 3), " "))
    return df.withColumns({
        "plan_token": extract.plan_token(F.col("title"), text), "parcel_token": extract.parcel_token(F.col("location")),
        "developer_token": extract.company_name(F.col("company")), "title_signature": extract.title_signature(F.col("title")),
    })


def similar_titles(titles: DataFrame, least: float = 0.5, key: str = "municipality_key") -> DataFrame:
    """Pairs (key, a, b, similarity) of different signatures `s` of one key with a Jaccard similarity of at least `least`.

    Exact by prefixes: with each title's words in order of rarity, two such titles share one of their first
    n - ceil(least * n) + 1. So a frequent word, being last, brings no titles together.
    """
    w = titles.select(key, "s", F.filter(F.array_distinct(F.split("s", " ")), lambda x: x != "").alias("ws"))
    words = w.select(key, "s", F.explode("ws").alias("word"))
    rare = words.join(words.groupBy("word").agg(F.count("*").alias("n")), "word").groupBy(key, "s").agg(F.sort_array(F.collect_list(F.struct("n", "word"))).alias("order"))
    size = F.size("order")
    head = rare.select(key, "s", F.transform("order", lambda x: x["word"]).alias("ws"), size.alias("n"), F.explode(F.slice("order", F.lit(1), size - F.ceil(size * least).cast("int") + 1)).alias("x")).select(key, "s", "ws", "n", "x.word")
    a, b = (head.select(key, "word", F.col("s").alias(x), F.col("ws").alias(f"w{x}"), F.col("n").alias(f"n{x}")) for x in "ab")
    # sizes alone rule many pairs out
    met = a.join(b, [key, "word"]).where((F.col("a") < F.col("b")) & (F.least("na", "nb") >= least * F.greatest("na", "nb"))).dropDuplicates([key, "a", "b"])
    both = F.size(F.array_intersect("wa", "wb"))
    return met.select(key, "a", "b", (both / (F.col("na") + F.col("nb") - both)).alias("similarity")).where(F.col("similarity") >= least)


class Fold:
    """The projects of one municipality so far. `link` takes procedures in order.

    A procedure joins the first project whose place contains its parcel, else the first whose name contains its
    plan, else the first of its developer (among fifty with one); else it founds a project. Later links do not
    change a project, so the state grows with the projects, not with the procedures. A token's first project never
    changes once found, and a token without one looks only at the projects founded since: work grows with the
    different tokens, not with the rows.
    """

    def __init__(self) -> None:
        self.projects: list[str] = []
        self.places: list[str | None] = []
        self.names: list[str | None] = []
        self.developers: dict[str, str] = {}
        self.counted = 0
        #: (kind, token): (number of its first project or None, projects looked at)
        self.known: dict[tuple[str, str], tuple[int | None, int]] = {}

    def _first(self, kind: str, token: str, values: list[str | None]) -> int | None:
        found, seen = self.known.get((kind, token), (None, 0))
        if found is None:
            found = next((i for i in range(seen, len(values)) if (v := values[i]) and token in v), None)
            self.known[kind, token] = found, len(values)
        return found

    def link(self, pid, plan, parcel, developer, words, title, place, company, kind) -> tuple[str, float, str]:
        if parcel and (i := self._first("parcel", parcel, self.places)) is not None:
            return self.projects[i], 0.95, "PARCEL_MATCH"
        if plan and (i := self._first("plan", plan, self.names)) is not None:
            return self.projects[i], 0.9, "PLAN_TOKEN_MATCH"
        if developer and words and developer in self.developers:
            return self.developers[developer], 0.8, "DEV+TITLE_MATCH"
        project = f"project-{pid}"
        self.projects.append(project)
        self.places.append(parcel or place)
        self.names.append(f"B-Plan {plan}" if plan else title or None)
        if company and developer and self.counted < 50:
            self.counted += 1
            self.developers.setdefault(developer, project)
        return (project, 0.85, "PERMIT_36_NEW") if kind == "PERMIT_36_EINVERNEHMEN" else (project, 1.0, "NEW_PROJECT")


def fold(rows: list[tuple]) -> Iterator[tuple]:
    """(procedure_id, project_id, confidence, reason) of one municipality's rows, in order."""
    state = Fold()
    for r in rows:
        yield r[0], *state.link(*r)


FIELDS = ["doc_id", "plan_token", "parcel_token", "developer_token", "title_signature", "title", "location", "company", "procedure_type"]


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    at, state = None, Fold()
    for b in batches:
        out = []
        for key, *row in b[["municipality_key", *FIELDS]].itertuples(index=False, name=None):
            key = None if pd.isna(key) else key
            if key != at:
                at, state = key, Fold()
            row = [None if pd.isna(v) else v for v in row]
            out.append((key, row[0], *state.link(*row)))
        yield pd.DataFrame(out, columns=["municipality_key", "procedure_id", "project_id", "link_confidence", "link_reason"])


def link(procedures: DataFrame) -> DataFrame:
    """Procedure to project links.

    The order (seen, doc_id) decides within a municipality, so municipalities run in parallel and each is streamed
    in order through one task, which keeps its projects and not its rows. A null doc_id keeps its row.
    """
    rows = procedures.select("municipality_key", "seen", *FIELDS).repartition("municipality_key").sortWithinPartitions("municipality_key", F.col("seen").asc_nulls_first(), "doc_id")
    # ids travel as text: beside nulls Python would see them as floating point
    linked = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(_stream, LINK_SCHEMA.replace("procedure_id long", "procedure_id string"))
    return linked.withColumn("procedure_id", F.col("procedure_id").cast("long"))


def link_by_key(procedures: DataFrame) -> DataFrame:
    """The fold without its containment rule, in windows: the first procedure with the same parcel, else plan, else
    developer founds the project. Equal to `link` where no token contains another and none joins two others."""
    key = F.coalesce(F.concat(F.lit("parcel:"), "parcel_token"), F.concat(F.lit("plan:"), "plan_token"), F.concat(F.lit("developer:"), "developer_token"), F.concat(F.lit("own:"), F.col("doc_id").cast("string")))
    w = W.partitionBy("municipality_key", "k").orderBy(F.col("seen").asc_nulls_first(), "doc_id")
    return procedures.withColumn("k", key).select("municipality_key", F.col("doc_id").alias("procedure_id"), F.concat(F.lit("project-"), F.first("doc_id").over(w).cast("string")).alias("project_id"), "k")


def stage(types: Column) -> Column:
    """The highest stage that any of the types reaches."""
    out = None
    for s in T.STAGES:
        hit = F.arrays_overlap(types, F.array(*[F.lit(t) for t, x in T.STAGE_OF.items() if x == s]))
        out = F.when(hit, s) if out is None else out.when(hit, s)
    return out.otherwise("DISCOVERED")


def _at() -> Column:
    """The place of a procedure in a project's order."""
    return F.struct(F.coalesce(F.col("seen"), F.lit("1900-01-01").cast("date")).alias("s"), F.col("doc_id").alias("d"))


def _developer() -> Column:
    """The most frequent of a project's companies, from rows (company, n, first), one for each; the first seen of equals."""
    return F.min_by("company", F.when(F.col("company") != "", F.struct(-F.col("n"), F.col("first")))).alias("developer_company_best")


def developers(procedures: DataFrame, key: str = "project_id") -> DataFrame:
    """developer_company_best of each project: the most frequent company, the first seen of equals; null without any.

    One pass. No filter asks for the company: it would be moved below and find the names in each text anew.
    """
    each = procedures.select(key, "company", _at().alias("at")).groupBy(key, "company").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    return each.groupBy(key).agg(_developer())


def rollup(procedures: DataFrame, key: str = "project_id") -> DataFrame:
    """Best values of each project from its procedures, in order of (seen, doc_id).

    Name: the first plan token as "B-Plan token", else the longest title with a plan word, else the longest. Place: the
    first parcel token, else the longest location. Of equals the first. Developer: the most frequent, the first
    seen of equals. Legal basis: §35 before §34 before §36, else the first. Dates: `seen`, or the day of
    `created_at`, if there, where it is null. Aggregations only: a project's rows are combined before they move.
    One pass: the values of each company of a project, then those of the project.
    """
    day = F.coalesce("seen", F.to_date("created_at")) if "created_at" in procedures.columns else F.col("seen")
    low = F.lower("title")
    plan = low.contains("bebauungsplan") | low.contains("b-plan") | low.contains("plan")
    # a value stands behind its order, so that least ones can be combined again
    longest = lambda c, cond=F.lit(True): F.when((F.col(c) != "") & cond, F.struct((-F.char_length(c)).alias("o"), "at", F.col(c).alias("v")))
    first = lambda c: F.when(F.col(c) != "", F.struct("at", F.col(c).alias("v")))
    least = {"plan": first("plan_token"), "planned": longest("title", plan), "titled": longest("title"), "parcel": first("parcel_token"), "place": longest("location"), "basis": first("legal_basis"), "early": day, "first": F.col("at")}
    most = {"mw": "capacity_mw", "mwh": "capacity_mwh", "area": "area_hectares", "late": day, "confidence": "confidence_score", "review": "review_recommended"}
    sets = {"bases": "legal_basis", "types": "procedure_type"}
    each = procedures.withColumn("at", _at()).groupBy(key, "company").agg(
        *[F.min(x).alias(n) for n, x in least.items()], *[F.max(x).alias(n) for n, x in most.items()], *[F.sort_array(F.collect_set(x)).alias(n) for n, x in sets.items()], F.count("*").alias("n"),
    )
    best = lambda n: F.min(n)["v"]
    bases, types = (F.flatten(F.collect_set(n)) for n in sets)
    return each.groupBy(key).agg(
        F.coalesce(F.concat(F.lit("B-Plan "), best("plan")), best("planned"), best("titled")).alias("canonical_project_name"),
        F.coalesce(best("parcel"), best("place")).alias("site_location_best"),
        F.max("mw").alias("capacity_mw_best"), F.max("mwh").alias("capacity_mwh_best"), F.max("area").alias("area_hectares_best"),
        F.when(F.array_contains(bases, "§35"), "§35").when(F.array_contains(bases, "§34"), "§34").when(F.array_contains(bases, "§36"), "§36").otherwise(best("basis")).alias("legal_basis_best"),
        F.min("early").alias("first_seen_date"), F.max("late").alias("last_seen_date"), F.greatest(F.lit(0.0), F.max("confidence")).alias("max_confidence"),
        F.coalesce(F.max("review"), F.lit(False)).alias("needs_review"), stage(types).alias("maturity_stage"), F.sum("n").alias("procedures"), _developer(),
    )
