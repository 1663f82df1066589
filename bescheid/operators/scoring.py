"""Prefilter, gates and the storage and grid scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import terms as T
from ..functions.matcher import has, hits, weight
from ..functions.text import normalize, normalize_sql


def wants_attachments(title: Column, source: Column) -> Column:
    """Council items whose title has an agenda word."""
    return F.coalesce(source == "RIS", F.lit(False)) & has(hits(F.lower(title)), *T.AGENDA)


def skips_file(size: Column, score: Column, mode: str = "fast", most_mb: int = 25) -> Column:
    """Large files of items with a middling score are left out in fast mode."""
    return (size > most_mb * 1024 * 1024) & (score < 0.8) if mode == "fast" else F.lit(False)


def any_sql(x: str, wanted) -> str:
    return "(" + " OR ".join(f"contains({x}, '{t}')" for t in wanted) + ")"


def sum_sql(x: str, weights: dict[str, int]) -> str:
    return "(" + " + ".join(f"CASE WHEN contains({x}, '{t}') THEN {w} ELSE 0 END" for t, w in weights.items()) + ")"


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def part(cond: Column, value: float) -> Column:
    return F.when(cond, F.lit(value)).otherwise(F.lit(0.0))


def prefilter_score(title: Column, url: Column) -> Column:
    """0 to 1 from words of the title and the address alone, before anything is fetched."""
    t, u = hits(F.lower(title)), hits(F.lower(url))
    procedure = has(t, *T.PREFILTER_PROCEDURE)
    total = part(has(t, *T.PREFILTER_STORAGE), 0.6) + part(has(t, *T.PREFILTER_SOLAR), 0.4)
    total = total + part(procedure, 0.3) + part(has(u, *T.PREFILTER_URL), 0.2) - part(has(t, *T.PREFILTER_CONTAINER) & ~procedure, 0.7)
    return clamp(total)


def prefilter_sql(title: str = "title", url: str = "url") -> str:
    t, u = f"lower({title})", f"lower({url})"
    p = any_sql(t, T.PREFILTER_PROCEDURE)
    case = lambda c, v: f"CASE WHEN {c} THEN CAST({v} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
    total = " + ".join((case(any_sql(t, T.PREFILTER_STORAGE), 0.6), case(any_sql(t, T.PREFILTER_SOLAR), 0.4), case(p, 0.3), case(any_sql(u, T.PREFILTER_URL), 0.2)))
    return f"greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), {total} - {case(any_sql(t, T.PREFILTER_CONTAINER) + f' AND NOT {p}', 0.7)}))"


def threshold(source: Column, mode: str = "fast") -> Column:
    """Least score for extraction, by source; other modes than fast and deep ask for 0.6 everywhere."""
    at = {"fast": 0, "deep": 1}.get(mode)
    if at is None:
        return F.lit(0.6)
    out = None
    for name, values in T.THRESHOLDS.items():
        if name:
            cond = source.isin(name, name.lower())
            out = F.when(cond, values[at]) if out is None else out.when(cond, values[at])
    return out.otherwise(T.THRESHOLDS[""][at])


def should_extract(score: Column, source: Column, mode: str = "fast") -> Column:
    return score >= threshold(F.coalesce(source, F.lit("")), mode)


def threshold_sql(source: str = "discovery_source", mode: str = "fast") -> str:
    at = {"fast": 0, "deep": 1}[mode]
    return "CASE " + " ".join(f"WHEN {source} IN ('{k}', '{k.lower()}') THEN {v[at]}" for k, v in T.THRESHOLDS.items() if k) + f" ELSE {T.THRESHOLDS[''][at]} END"


def with_hits(df: DataFrame) -> DataFrame:
    """Adds the normal forms of text and title and what they hold: `hc` (both), `ht` (title), `ho` (as written)."""
    df = df.withColumns({"nt": normalize("text"), "nn": normalize("title")})
    return df.withColumns({"comb": F.concat_ws(" ", "nt", "nn"), "orig": F.lower(F.concat_ws(" ", "text", "title"))}).withColumns({"hc": hits("comb", once=True), "ht": hits("nn", once=True), "ho": hits("orig", once=True)})


#: DuckDB's counterpart over the fixture `fx`.
NORMAL_SQL = f"n0 AS (SELECT *, {normalize_sql('text')} AS nt, {normalize_sql('title')} AS nn FROM fx), n AS (SELECT *, nt || ' ' || nn AS comb, lower(text || ' ' || title) AS orig FROM n0)"


def storage_score_plain(text: Column, penalty_fix: bool = False) -> Column:
    """Sum of word weights and pair bonuses. Negative words raise it, as the rule subtracts negative weights;
    `penalty_fix` makes them a penalty."""
    h = hits(F.lower(text))
    storage, direct = has(h, *T.STORAGE_ANY), has(h, *T.STORAGE_DIRECT)
    bonus = lambda c, v: F.when(c, v).otherwise(0)
    sign = 1 if penalty_fix else -1
    total = weight(h, T.STORAGE_WEIGHTS) + sign * weight(h, T.STORAGE_PENALTIES)
    total = total + bonus(has(h, *T.STORAGE_SOLAR) & storage, 6) + bonus(has(h, *T.STORAGE_WIND) & storage, 5) + bonus(has(h, "energiepark") & storage, 5)
    return F.greatest(F.lit(0), total + bonus(has(h, "batterie") & has(h, "speicher"), 5) + bonus(direct, 3))


def storage_plain_sql(text: str = "text") -> str:
    x = f"lower({text})"
    case = lambda c, v: f"CASE WHEN {c} THEN {v} ELSE 0 END"
    s = any_sql(x, T.STORAGE_ANY)
    return (
        f"greatest(0, {sum_sql(x, T.STORAGE_WEIGHTS)} - {sum_sql(x, T.STORAGE_PENALTIES)} + {case(any_sql(x, T.STORAGE_SOLAR) + ' AND ' + s, 6)} + {case(any_sql(x, T.STORAGE_WIND) + ' AND ' + s, 5)}"
        f" + {case(any_sql(x, ['energiepark']) + ' AND ' + s, 5)} + {case(any_sql(x, ['batterie']) + ' AND ' + any_sql(x, ['speicher']), 5)} + {case(any_sql(x, T.STORAGE_DIRECT), 3)})"
    )


# The words and weights of the rules below.
def grid_score(text: Column) -> Column:
    """Sum of word weights, bonuses for a substation with a voltage and for renewables with a connection or
    feed-in; one generic word alone counts nothing."""
    h = hits(F.lower(text))
    renewable = has(h, "solar", "pv", "wind")
    bonus = lambda c: F.when(c, 2).otherwise(0)
    total = weight(h, T.GRID_WEIGHTS) + bonus(has(h, "umspannwerk", "schaltanlage") & has(h, "110", "220", "380")) + bonus(has(h, "netzanschluss") & renewable) + bonus(has(h, "einspeisung") & renewable)
    return F.when((total == 1) & has(h, "netz") & ~has(h, "anschluss", "einspeisung", "trafo", "spannung", "kv"), 0).otherwise(F.greatest(F.lit(0), total))


def grid_sql(text: str = "text") -> str:
    x = f"lower({text})"
    r = any_sql(x, ["solar", "pv", "wind"])
    case = lambda *c: f"CASE WHEN {' AND '.join(c)} THEN 2 ELSE 0 END"
    total = f"({sum_sql(x, T.GRID_WEIGHTS)} + {case(any_sql(x, ['umspannwerk', 'schaltanlage']), any_sql(x, ['110', '220', '380']))} + {case(any_sql(x, ['netzanschluss']), r)} + {case(any_sql(x, ['einspeisung']), r)})"
    return f"CASE WHEN {total} = 1 AND contains({x}, 'netz') AND NOT {any_sql(x, ['anschluss', 'einspeisung', 'trafo', 'spannung', 'kv'])} THEN 0 ELSE greatest(0, {total}) END"


def confidence(storage: Column, grid: Column) -> Column:
    return F.when((storage >= 3) & (grid >= 3), "high").when((storage >= 1) | (grid >= 1), "medium").otherwise("low")
