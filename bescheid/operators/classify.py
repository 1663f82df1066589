"""Relevance, tags, evidence and validity of announcements, from the hit columns of `scoring.with_hits`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import terms as T
from ..functions.matcher import TERMS, count, has, hits, numbers
from ..functions.text import normalize
from .scoring import any_sql, clamp, part, with_hits


def is_candidate(hc: Column) -> Column:
    """A procedure word with storage, or with energy beside a store or a zone; a negative word needs explicit storage."""
    explicit, energy = has(hc, *T.STORAGE_EXPLICIT), has(hc, *T.ENERGY)
    return ~(has(hc, *T.NEGATIVE) & ~explicit) & has(hc, *T.PROCEDURE) & (explicit | (has(hc, "speicher") & energy) | (has(hc, *T.ZONING) & energy))


def candidate_sql(x: str = "comb") -> str:
    explicit, energy = any_sql(x, T.STORAGE_EXPLICIT), any_sql(x, T.ENERGY)
    return f"(NOT ({any_sql(x, T.NEGATIVE)} AND NOT {explicit}) AND {any_sql(x, T.PROCEDURE)} AND ({explicit} OR (contains({x}, 'speicher') AND {energy}) OR ({any_sql(x, T.ZONING)} AND {energy})))"


def procedure_type(h: Column) -> Column:
    """First match, permits before plans."""
    return (
        F.when(has(h, "bauvorbescheid", "vorbescheid"), "PERMIT_BAUVORBESCHEID")
        .when(has(h, "baugenehmigung"), "PERMIT_BAUGENEHMIGUNG")
        .when(has(h, "§ 36 baugb") | (has(h, "gemeindliches einvernehmen") & has(h, "§ 36")), "PERMIT_36_EINVERNEHMEN")
        .when(has(h, "bauantrag") | (has(h, "antrag auf") & has(h, *T.PERMIT_STRONG)) | has(h, "bauvoranfrage", "bauvorantrag"), "PERMIT_OTHER")
        .when((has(h, "kenntnisnahme") & has(h, "bauantrag", "vorhaben")) | has(h, "antrag auf errichtung"), "PERMIT_OTHER")
        .when(has(h, "aufstellungsbeschluss", "beschluss zur aufstellung", "§ 2 abs. 1 baugb"), "BPLAN_AUFSTELLUNG")
        .when(has(h, "§ 3 abs. 1 baugb", "frühzeitige beteiligung", "fruehzeitige beteiligung"), "BPLAN_FRUEHZEITIG_3_1")
        .when(has(h, "§ 3 abs. 2 baugb", "öffentliche auslegung", "oeffentliche auslegung"), "BPLAN_AUSLEGUNG_3_2")
        .when(has(h, "satzungsbeschluss", "§ 10 baugb", "inkrafttreten"), "BPLAN_SATZUNG")
        .when(has(h, *T.PLANNING_STRONG), "BPLAN_OTHER")
        .otherwise("UNKNOWN")
    )


def procedure_type_sql(x: str = "comb") -> str:
    a = lambda *t: any_sql(x, t)
    return (
        f"CASE WHEN {a('bauvorbescheid', 'vorbescheid')} THEN 'PERMIT_BAUVORBESCHEID' WHEN {a('baugenehmigung')} THEN 'PERMIT_BAUGENEHMIGUNG'"
        f" WHEN {a('§ 36 baugb')} OR ({a('gemeindliches einvernehmen')} AND {a('§ 36')}) THEN 'PERMIT_36_EINVERNEHMEN'"
        f" WHEN {a('bauantrag')} OR ({a('antrag auf')} AND {any_sql(x, T.PERMIT_STRONG)}) OR {a('bauvoranfrage', 'bauvorantrag')} THEN 'PERMIT_OTHER'"
        f" WHEN ({a('kenntnisnahme')} AND {a('bauantrag', 'vorhaben')}) OR {a('antrag auf errichtung')} THEN 'PERMIT_OTHER'"
        f" WHEN {a('aufstellungsbeschluss', 'beschluss zur aufstellung', '§ 2 abs. 1 baugb')} THEN 'BPLAN_AUFSTELLUNG'"
        f" WHEN {a('§ 3 abs. 1 baugb', 'frühzeitige beteiligung', 'fruehzeitige beteiligung')} THEN 'BPLAN_FRUEHZEITIG_3_1'"
        f" WHEN {a('§ 3 abs. 2 baugb', 'öffentliche auslegung', 'oeffentliche auslegung')} THEN 'BPLAN_AUSLEGUNG_3_2'"
        f" WHEN {a('satzungsbeschluss', '§ 10 baugb', 'inkrafttreten')} THEN 'BPLAN_SATZUNG' WHEN {any_sql(x, T.PLANNING_STRONG)} THEN 'BPLAN_OTHER' ELSE 'UNKNOWN' END"
    )


BASES = {p: [f"§ {p[1:]} baugb", f"§{p[1:]} baugb", f"§ {p[1:]}bau gb", f"§{p[1:]}bau gb"] for p in ("§35", "§34", "§36")}
BASES["§35"] += ["außenbereich", "aussenbereich"]
BASES["§34"] += ["innenbereich"]


def legal_basis(h: Column) -> Column:
    """§35 before §34 before §36, with the spellings that broken white space leaves."""
    out = F.when(has(h, *BASES["§35"]), "§35")
    for p in ("§34", "§36"):
        out = out.when(has(h, *BASES[p]), p)
    return out.otherwise("unknown")


def legal_basis_sql(x: str = "comb") -> str:
    return "CASE " + " ".join(f"WHEN {any_sql(x, t)} THEN '{p}'" for p, t in BASES.items()) + " ELSE 'unknown' END"


# Words beside which storage belongs to the grid.
_GRID_CONTEXT = ("netz", "umspannwerk", "trafostation", "mittelspannung", "hochspannung")


def components(h: Column) -> Column:
    store = has(h, *T.STORAGE_EXPLICIT, "speicher", "anlage zur energiespeicherung") | (has(h, "containeranlage") & has(h, *_GRID_CONTEXT))
    return F.when(has(h, "photovoltaik", "pv", "solarpark") & store, "PV+BESS").when(has(h, "windenergie", "windpark") & store, "WIND+BESS").when(store, "BESS_ONLY").otherwise("OTHER/UNCLEAR")


def components_sql(x: str = "comb") -> str:
    store = f"({any_sql(x, [*T.STORAGE_EXPLICIT, 'speicher', 'anlage zur energiespeicherung'])} OR (contains({x}, 'containeranlage') AND {any_sql(x, _GRID_CONTEXT)}))"
    return f"CASE WHEN {any_sql(x, ['photovoltaik', 'pv', 'solarpark'])} AND {store} THEN 'PV+BESS' WHEN {any_sql(x, ['windenergie', 'windpark'])} AND {store} THEN 'WIND+BESS' WHEN {store} THEN 'BESS_ONLY' ELSE 'OTHER/UNCLEAR' END"


# Words that support a storage project; the weights and short lists of the rules below are fixed, too.
_SUPPORT = ("umspannwerk", "netzanschluss", "trafostation", "mittelspannung", "hochspannung", "netzverknuepfungspunkt", "netzverknüpfungspunkt")


def confidence(h: Column, explicit: Column, dated: Column) -> Column:
    """0 to 1; the sums keep their order, so that every engine gets the same double."""
    x = (
        F.when(has(h, "batteriespeicher", "energiespeicher", "stromspeicher"), 0.55).when(has(h, "speicheranlage", "grossspeicher", "großspeicher", "speicherpark"), 0.35)
        .when(has(h, "speicher") & has(h, *T.ENERGY), 0.15).otherwise(0.0)
    )
    x = x + part(has(h, *T.PLANNING_STEP), 0.25) + part(has(h, "bauvorbescheid", "baugenehmigung"), 0.25) + part(has(h, "§ 36 baugb", "gemeindliches einvernehmen"), 0.2) + part(has(h, *_SUPPORT), 0.1)
    x = x - part(has(h, "speicher") & ~has(h, *T.GRID), 0.25) - part(~dated, 0.15)
    return F.when(has(h, *T.NEGATIVE_STORAGE) & ~explicit, 0.0).otherwise(clamp(x))


def confidence_sql(x: str, explicit: str, dated: str) -> str:
    d = lambda v: f"CAST({v} AS DOUBLE)"
    case = lambda c, v: f"CASE WHEN {c} THEN {d(v)} ELSE {d(0)} END"
    s = f"contains({x}, 'speicher')"
    first = f"CASE WHEN {any_sql(x, ['batteriespeicher', 'energiespeicher', 'stromspeicher'])} THEN {d(0.55)} WHEN {any_sql(x, ['speicheranlage', 'grossspeicher', 'großspeicher', 'speicherpark'])} THEN {d(0.35)} WHEN {s} AND {any_sql(x, T.ENERGY)} THEN {d(0.15)} ELSE {d(0)} END"
    total = f"{first} + {case(any_sql(x, T.PLANNING_STEP), 0.25)} + {case(any_sql(x, ['bauvorbescheid', 'baugenehmigung']), 0.25)} + {case(any_sql(x, ['§ 36 baugb', 'gemeindliches einvernehmen']), 0.2)} + {case(any_sql(x, _SUPPORT), 0.1)}"
    total += f" - {case(f'{s} AND NOT {any_sql(x, T.GRID)}', 0.25)} - {case(f'NOT ({dated})', 0.15)}"
    return f"CASE WHEN {any_sql(x, T.NEGATIVE_STORAGE)} AND NOT {explicit} THEN {d(0)} ELSE greatest({d(0)}, least({d(1)}, {total})) END"


def relevance(hc: Column, ht: Column, ho: Column, date: Column) -> tuple[Column, Column]:
    """(relevant, by the ambiguous rule): explicit storage with a procedure; storage in the title of a dated item
    from 2023 on, even beside negative words; or a generic store among two grid terms with a step or permit."""
    explicit = has(hc, *T.STORAGE_STRONG)
    negative = has(hc, *T.NEGATIVE) | has(ho, *T.NEGATIVE)
    recent = F.coalesce(date >= F.lit("2023-01-01").cast("date"), F.lit(False)) & has(ht, "batteriespeicher", "energiespeicher")
    sure = (explicit & has(hc, *T.PROCEDURE) & ~negative) | (recent & ~(negative & ~explicit))
    vague = ~sure & ~negative & has(hc, "speicher", *T.STORAGE_MEDIUM) & (count(hc, T.GRID) >= 2) & has(hc, *T.PLANNING_STEP, *T.PERMIT_STRONG)
    return sure | vague, vague


def relevance_sql(c: str = "comb", t: str = "nn", o: str = "orig", date: str = "date_hint") -> tuple[str, str]:
    explicit, negative = any_sql(c, T.STORAGE_STRONG), f"({any_sql(c, T.NEGATIVE)} OR {any_sql(o, T.NEGATIVE)})"
    recent = f"(coalesce({date} >= DATE '2023-01-01', FALSE) AND {any_sql(t, ['batteriespeicher', 'energiespeicher'])})"
    sure = f"(({explicit} AND {any_sql(c, T.PROCEDURE)} AND NOT {negative}) OR ({recent} AND NOT ({negative} AND NOT {explicit})))"
    grid = "(" + " + ".join(f"CASE WHEN contains({c}, '{g}') THEN 1 ELSE 0 END" for g in T.GRID) + ")"
    vague = f"(NOT {sure} AND NOT {negative} AND {any_sql(c, ['speicher', *T.STORAGE_MEDIUM])} AND {grid} >= 2 AND {any_sql(c, T.PLANNING_STEP + T.PERMIT_STRONG)})"
    return f"({sure} OR {vague})", vague


FAMILIES = (T.STORAGE_EXPLICIT, T.PLANNING_STEP + T.PERMIT_STRONG, T.LEGAL_BASIS)


def evidence(text: Column, comb: Column, hc: Column, most: int = 5) -> Column:
    """Text around the first usable term of each family, 100 characters to either side.

    Places are those in the normal form, applied to the text as written; a term whose slice is empty there gives
    way to the next.
    """
    found = []
    for family in FAMILIES:
        held = F.transform(F.filter(F.lit(numbers(family)), lambda n: F.array_contains(hc, n)), lambda n: F.element_at(F.lit(TERMS), n + 1))

        def cut(t: Column) -> Column:
            at = F.instr(comb, t) - 1
            start = F.greatest(F.lit(0), at - 100)
            return F.regexp_replace(F.substr(text, start + 1, at + F.char_length(t) + 100 - start), r"(?U)^\s+|\s+$", "")

        found.append(F.get(F.filter(F.transform(held, cut), lambda s: (s != "") & (F.char_length(s) <= 250)), 0))
    return F.slice(F.array_compact(F.array(*found)), 1, most)


def evidence_sql(text: str = "text", comb: str = "comb") -> str:
    one = []
    for family in FAMILIES:
        terms = ", ".join(f"'{t}'" for t in family)
        held = f"list_filter([{terms}], lambda t: strpos({comb}, t) > 0)"
        cut = f"list_transform({held}, lambda t: regexp_replace(substr({text}, greatest(0, strpos({comb}, t) - 101) + 1, strpos({comb}, t) - 1 + length(t) + 100 - greatest(0, strpos({comb}, t) - 101)), '^\\s+|\\s+$', '', 'g'))"
        one.append(f"list_filter({cut}, lambda s: s <> '' AND length(s) <= 250)[1]")
    return f"list_filter([{', '.join(one)}], lambda s: s IS NOT NULL)"


def classify(df: DataFrame) -> DataFrame:
    """`df` (title, text, date_hint, ...) with the classifier's fields; irrelevant rows keep null tags."""
    df = with_hits(df)
    h = F.col("hc")
    rel, vague = relevance(h, F.col("ht"), F.col("ho"), F.col("date_hint"))
    explicit = has(h, *T.STORAGE_STRONG)
    df = df.withColumns({"is_relevant": rel, "vague": vague, "explicit": explicit})
    on = lambda x: F.when(F.col("is_relevant"), x)
    df = df.withColumns({
        "procedure_type": on(procedure_type(h)), "legal_basis": on(legal_basis(h)), "project_components": on(components(h)),
        "confidence_score": F.coalesce(on(confidence(h, explicit, F.col("date_hint").isNotNull())), F.lit(0.0)),
        "ambiguity_flag": F.col("is_relevant") & (F.col("vague") | ~F.col("explicit")),
    })
    return df.withColumns({
        "review_recommended": F.col("is_relevant") & F.col("confidence_score").between(0.35, 0.65),
        "evidence_snippets": F.when(F.col("is_relevant"), evidence(F.col("text"), F.col("comb"), h)).otherwise(F.array().cast("array<string>")),
    }).drop("vague", "explicit")


def classify_sql() -> str:
    """DuckDB's counterpart: relation `c` over `n`."""
    rel, vague = relevance_sql()
    explicit = any_sql("comb", T.STORAGE_STRONG)
    return f"""c0 AS (SELECT *, {rel} AS is_relevant, {vague} AS vague, {explicit} AS explicit FROM n),
c1 AS (SELECT *, CASE WHEN is_relevant THEN {procedure_type_sql()} END AS procedure_type, CASE WHEN is_relevant THEN {legal_basis_sql()} END AS legal_basis,
  CASE WHEN is_relevant THEN {components_sql()} END AS project_components, CASE WHEN is_relevant THEN {confidence_sql('comb', 'explicit', 'date_hint IS NOT NULL')} ELSE CAST(0 AS DOUBLE) END AS confidence_score,
  is_relevant AND (vague OR NOT explicit) AS ambiguity_flag FROM c0),
c AS (SELECT *, is_relevant AND confidence_score BETWEEN CAST(0.35 AS DOUBLE) AND CAST(0.65 AS DOUBLE) AS review_recommended, CASE WHEN is_relevant THEN {evidence_sql()} ELSE [] END AS evidence_snippets FROM c1)"""


def storage_score(text: Column, title: Column) -> Column:
    """The classifier's confidence as 0 to 100: fifty points, twenty for a named store, fifteen for high voltage."""
    t = normalize(title)
    both = F.concat_ws(" ", normalize(text), t, t)
    h, ht = hits(both), hits(t)
    rel, _ = relevance(h, ht, h, F.lit("2025-01-01").cast("date"))
    base = (confidence(h, has(h, *T.STORAGE_STRONG), F.lit(True)) * 50).cast("int")
    score = base + F.when(has(h, "batteriespeicher", "energiespeicher", "stromspeicher"), 20).otherwise(0) + F.when(has(h, "umspannwerk", "110 kv", "220 kv", "380 kv"), 15).otherwise(0)
    return F.when(is_candidate(h) & rel, F.least(F.lit(100), score)).otherwise(0)


def storage_score_sql() -> str:
    """Over a relation with `twice` (normal text, title, title) and `nn`."""
    rel, _ = relevance_sql("twice", "nn", "twice", "DATE '2025-01-01'")
    base = f"CAST(floor({confidence_sql('twice', any_sql('twice', T.STORAGE_STRONG), 'TRUE')} * 50) AS INT)"
    return f"CASE WHEN {candidate_sql('twice')} AND {rel} THEN least(100, {base} + CASE WHEN {any_sql('twice', ['batteriespeicher', 'energiespeicher', 'stromspeicher'])} THEN 20 ELSE 0 END + CASE WHEN {any_sql('twice', ['umspannwerk', '110 kv', '220 kv', '380 kv'])} THEN 15 ELSE 0 END) ELSE 0 END"


def is_container(title: Column, url: Column) -> Column:
    """A gazette issue rather than one procedure."""
    x = F.lower(F.concat_ws(" ", title, url))
    h = hits(x)
    return has(h, *T.CONTAINER) & ~has(h, *T.CONTAINER_PROCEDURE) & (x.rlike(r"\b(ausgabe|nummer|nr\.)\s*[0-9]+") | has(h, "amtsblatt"))


def container_sql(title: str = "title", url: str = "url") -> str:
    x = f"lower({title} || ' ' || {url})"
    return f"({any_sql(x, T.CONTAINER)} AND NOT {any_sql(x, T.CONTAINER_PROCEDURE)} AND (regexp_matches({x}, '\\b(ausgabe|nummer|nr\\.)\\s*[0-9]+') OR contains({x}, 'amtsblatt')))"


def validity(title: Column, url: Column, source: Column, procedure_type: Column, text: Column) -> Column:
    """struct(ok, reason): containers need a signal in their text or a type; others a type, or privileged words
    of a council source."""
    h = hits(F.lower(F.concat_ws(" ", title, F.coalesce(text, F.lit("")))))
    council = F.coalesce(source.isin("RIS", "ris"), F.lit(False))
    container = is_container(title, url)
    ok = F.when(container, has(h, *T.CONTAINER_SIGNAL) | procedure_type.isNotNull()).otherwise(procedure_type.isNotNull() | (council & has(h, *T.PRIVILEGED)))
    return F.struct(ok.alias("ok"), F.when(~ok, F.when(container, "SKIP_CONTAINER").otherwise("SKIP_NO_PROCEDURE_SIGNAL")).alias("reason"))


def validity_sql() -> tuple[str, str]:
    """(ok, reason) over `c`, with the normal title."""
    x = "lower(nn || ' ' || text)"
    box = container_sql("nn")
    ok = f"(CASE WHEN {box} THEN {any_sql(x, T.CONTAINER_SIGNAL)} OR procedure_type IS NOT NULL ELSE procedure_type IS NOT NULL OR (coalesce(discovery_source IN ('RIS', 'ris'), FALSE) AND {any_sql(x, T.PRIVILEGED)}) END)"
    return ok, f"CASE WHEN NOT {ok} THEN CASE WHEN {box} THEN 'SKIP_CONTAINER' ELSE 'SKIP_NO_PROCEDURE_SIGNAL' END END"
