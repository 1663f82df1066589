"""Capacities, areas, dates, companies, parcels and tokens from announcement texts."""

from __future__ import annotations

import re
from datetime import date

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..functions import terms as T
from ..functions.text import normalize

# Patterns of quantities, areas, dates, companies and street or place words.
_NUMBER = r"([0-9]+(?:[.,][0-9]+)?)\s*"
QUANTITIES = {
    "MW": (_NUMBER + r"(?:mw|megawatt|m\.?w\.?)", _NUMBER + r"(?:kw|kilowatt|k\.?w\.?)"),
    "MWh": (_NUMBER + r"(?:mwh|megawattstunden|m\.?w\.?h\.?)", _NUMBER + r"(?:kwh|kilowattstunden|k\.?w\.?h\.?)"),
}
AREAS = ((_NUMBER + "(?:ha|hektar|hektare)", 1.0), (_NUMBER + "(?:qm|m²|quadratmeter)", 0.0001), (_NUMBER + "km²", 0.0001), (_NUMBER + "quadratkilometer", 100.0))
DATES = (r"[0-9]{1,2}\.\s*[0-9]{1,2}\.\s*[0-9]{4}", r"[0-9]{1,2}\.\s*[0-9]{1,2}\.\s*[0-9]{2}\b", r"[0-9]{1,2}[/-]\s*[0-9]{1,2}[/-]\s*[0-9]{4}")
COMPANY = r"\b[A-ZÄÖÜ][A-Za-zÄÖÜäöüß0-9\s,&.-]+?(?:GmbH|AG|UG|GmbH & Co\. KG|KG)\b"
_WORDS = r"([a-zäöü][a-zäöüß\s-]+)"


def _values(text: Column, pattern: str, factor: float = 1.0, divide: bool = False) -> Column:
    found = F.regexp_extract_all(text, F.lit("(?i)" + pattern), F.lit(1))
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit(".")).cast("double") / 1000.0 if divide else F.replace(x, F.lit(","), F.lit(".")).cast("double") * factor)


def _values_sql(text: str, pattern: str, change: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '{pattern}', 1, 'i'), lambda x: CAST(replace(x, ',', '.') AS DOUBLE) {change})"


def capacity(text: Column, unit: str = "MW") -> Column:
    """Largest value of a unit, thousandths included; "MW" also takes the start of "MWh", as the pattern does."""
    whole, small = QUANTITIES[unit]
    return F.array_max(F.concat(_values(text, whole), _values(text, small, divide=True)))


def capacity_sql(text: str = "text", unit: str = "MW") -> str:
    whole, small = QUANTITIES[unit]
    return f"list_max(list_concat({_values_sql(text, whole, '* CAST(1 AS DOUBLE)')}, {_values_sql(text, small, '/ CAST(1000 AS DOUBLE)')}))"


def area(text: Column, fix_km2: bool = False) -> Column:
    """Largest area in hectares. A square kilometre counts as a square metre unless `fix_km2`, as the rule does."""
    return F.array_max(F.concat(*[_values(text, p, 100.0 if fix_km2 and "km²" in p else f) for p, f in AREAS]))


def area_sql(text: str = "text") -> str:
    parts = [_values_sql(text, p, f"* CAST({f} AS DOUBLE)") for p, f in AREAS]
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return f"list_max({out})"


def dates(text: Column) -> Column:
    """Valid dates of 2020 to 2030, pattern by pattern; two-digit years below 50 are of this century."""
    out = []
    for p in DATES:
        nums = F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(0)), lambda m: F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)))

        def made(n: Column) -> Column:
            y = n[2]
            year = F.when(F.char_length(y) == 2, F.concat(F.when(y.cast("int") < 50, "20").otherwise("19"), y)).otherwise(y)
            return F.try_to_date(F.concat_ws("-", year, n[1], n[0]), "y-M-d")

        out.append(F.filter(F.transform(nums, made), lambda d: d.isNotNull() & F.year(d).between(2020, 2030)))
    return F.concat(*out)


def dates_sql(text: str = "text") -> str:
    out = []
    for p in DATES:
        nums = f"list_transform(regexp_extract_all({text}, '{p}'), lambda m: regexp_extract_all(m, '[0-9]+'))"
        year = "CASE WHEN length(n[3]) = 2 THEN CASE WHEN CAST(n[3] AS INT) < 50 THEN '20' ELSE '19' END || n[3] ELSE n[3] END"
        out.append(f"list_filter(list_transform({nums}, lambda n: CAST(try_strptime({year} || '-' || n[2] || '-' || n[1], '%Y-%m-%d') AS DATE)), lambda d: d IS NOT NULL AND year(d) BETWEEN 2020 AND 2030)")
    return f"list_concat(list_concat({out[0]}, {out[1]}), {out[2]})"


# How dates near a decision are spelled.
_SPELLED = [re.compile(p) for p in (r"(\d{1,2})\.\s*(\d{1,2})\.\s*(\d{4})", r"(\d{1,2})\.\s*(\d{1,2})\.\s*(\d{2})\b", r"(\d{1,2})[/-]\s*(\d{1,2})[/-]\s*(\d{4})")]


def decided(text: str | None) -> date | None:
    """Date near a word of decision: words in order, then dates in order, closer than 200 characters; else the first.

    A date's place is the first occurrence of its surroundings in the text.
    """
    if not text:
        return None
    low, found = text.lower(), []
    for p in _SPELLED:
        for m in p.finditer(text):
            d, mo, y = m.groups()
            y = ("20" if int(y) < 50 else "19") + y if len(y) == 2 else y
            try:
                day = date(int(y), int(mo), int(d))
            except ValueError:
                continue
            if 2020 <= day.year <= 2030:
                found.append((text[max(0, m.start() - 50) : m.end() + 50].strip(), day))
    for word in T.DECISION:
        at = low.find(word)
        for around, day in found if at >= 0 else ():
            place = low.find(around.lower())
            if place >= 0 and abs(place - at) < 200:
                return day
    return found[0][1] if found else None


@F.pandas_udf(DateType())
def decision_date(text: pd.Series) -> pd.Series:
    """`decided` in Arrow batches: first-occurrence distances have no built-in form."""
    return text.map(decided).astype(object)


#: What a company's name may hold, and the legal form at its end.
_NAMED, _FORM = r"[A-Za-zÄÖÜäöüß0-9\s,&.-]", r"(?:GmbH|AG|UG|KG)\b"


def companies(text: Column) -> Column:
    """All spans from a capital to the next legal form.

    Stretches that a name may run through first lose what follows their last legal form, all of it where they have none:
    else each capital there would walk to their end. What stands around the rest still decides about word edges.
    """
    held = F.regexp_replace(text, rf"(?U)({_NAMED}*{_FORM}){_NAMED}*+|{_NAMED}++", "$1\u0001")
    return F.regexp_extract_all(held, F.lit("(?U)" + COMPANY), F.lit(0))


def companies_sql(text: str = "text") -> str:
    """The same in DuckDB, whose word edges know ASCII only: umlauts stand as letters of their own, other letters as `_`."""
    marks = [(u, f"{'ZQX' if u.isupper() else 'zqx'}{i}q") for i, u in enumerate("ÄÖÜäöüß")]
    plain, back = text, "x"
    for u, m in marks:
        plain, back = f"replace({plain}, '{u}', '{m}')", f"replace({back}, '{m}', '{u}')"
    plain = f"regexp_replace({plain}, '[^\x00-\x7F]', '_', 'g')"
    pattern = COMPANY.replace("ÄÖÜäöüß", "").replace("ÄÖÜ", "")
    return f"list_transform(regexp_extract_all({plain}, '{pattern}'), lambda x: {back})"


def developer_sql(found: str) -> str:
    return f"nullif(array_to_string(({found})[1:3], ', '), '')"


def developer(found: Column) -> Column:
    """One company as it is, several as the first three."""
    return F.nullif(F.array_join(F.slice(found, 1, 3), ", "), F.lit(""))


# Patterns of parcels, streets and coordinates.
LOCATION = (("Gemarkung", r"gemarkung\s+" + _WORDS), ("Flur", r"flur\s+([0-9]+)"), ("Flurstück", r"flurst(?:ue|ü)ck\s+([0-9]+[a-z]?)"), ("Straße", r"(?:strasse|straße|str\.)\s+" + _WORDS))
_COORDINATES = r"([0-9]+[.,][0-9]+)\s*[°]?\s*[NSEW]?\s*[,/]\s*([0-9]+[.,][0-9]+)"


def location(text: Column) -> Column:
    """Parcel, street and coordinates as one line; null without any."""
    t = normalize(text)
    parts = [F.concat(F.lit(f"{name}: "), F.nullif(F.trim(F.regexp_extract(t, p, 1)), F.lit(""))) for name, p in LOCATION]
    parts.append(F.concat(F.lit("Koordinaten: "), F.nullif(F.regexp_extract(t, _COORDINATES, 1), F.lit("")), F.lit(", "), F.regexp_extract(t, _COORDINATES, 2)))
    return F.nullif(F.concat_ws("; ", *parts), F.lit(""))


def location_sql(t: str = "nt") -> str:
    parts = [f"'{name}: ' || nullif(trim(regexp_extract({t}, '{p}', 1)), '')" for name, p in LOCATION]
    parts.append(f"'Koordinaten: ' || nullif(regexp_extract({t}, '{_COORDINATES}', 1), '') || ', ' || regexp_extract({t}, '{_COORDINATES}', 2)")
    return f"nullif(concat_ws('; ', {', '.join(parts)}), '')"


# Patterns of plan numbers and quoted names.
PLAN = r"b(?:ebauungs)?-?plan\s*(?:nr\.?|nummer)?\s*([a-z0-9\-/]+)"
QUOTED = "[„\"']([^„\"']{5,50})[„\"']"


def plan_token(title: Column, text: Column | None = None) -> Column:
    """Number after a plan word, else a quoted name with a planning word in it."""
    x = F.lower(F.concat_ws(" ", title, F.coalesce(text, F.lit("")) if text is not None else F.lit("")))
    quoted = F.trim(F.regexp_extract(x, QUOTED, 1))
    named = quoted.contains("plan") | quoted.contains("gebiet") | quoted.contains("bereich") | quoted.contains("vorhaben")
    return F.coalesce(F.nullif(F.regexp_extract(x, PLAN, 1), F.lit("")), F.when(named, quoted))


def plan_token_sql(title: str = "title", text: str = "''") -> str:
    x = f"lower({title} || ' ' || {text})"
    q = f"trim(regexp_extract({x}, '{QUOTED.replace(chr(39), chr(39) * 2)}', 1))"
    return f"coalesce(nullif(regexp_extract({x}, '{PLAN}', 1), ''), CASE WHEN contains({q}, 'plan') OR contains({q}, 'gebiet') OR contains({q}, 'bereich') OR contains({q}, 'vorhaben') THEN {q} END)"


# Patterns of a parcel's parts.
PARCEL = (("gemarkung", r"gemarkung\s*:?\s*([a-zäöüß\s-]+)"), ("flur", r"flur\s*:?\s*([0-9]+)"), ("flurstueck", r"flurst(?:ue|ü)ck\s*:?\s*([0-9]+[a-z]?)"))


def parcel_token(loc: Column) -> Column:
    """gemarkung=..;flur=..;flurstueck=.. of a location line; the parcel's number ends before a slash."""
    x = F.lower(loc)
    return F.nullif(F.concat_ws(";", *[F.concat(F.lit(f"{k}="), F.nullif(F.trim(F.regexp_extract(x, p, 1)), F.lit(""))) for k, p in PARCEL]), F.lit(""))


def parcel_token_sql(loc: str = "location") -> str:
    parts = ", ".join(f"'{k}=' || nullif(trim(regexp_extract(lower({loc}), '{p}', 1)), '')" for k, p in PARCEL)
    return f"nullif(concat_ws(';', {parts}), '')"


# Legal forms at a name's end.
FORMS = r"\s+(gmbh|ag|ug|kg|gbr|e\.v\.|e\.k\.|ohg)\s*$"


def company_name(name: Column) -> Column:
    """Without one trailing legal form, in lower case; null when nothing is left."""
    return F.nullif(F.lower(F.trim(F.regexp_replace(F.regexp_replace(name, "(?i)" + FORMS, ""), r"\s+", " "))), F.lit(""))


def company_name_sql(name: str) -> str:
    return f"nullif(lower(trim(regexp_replace(regexp_replace({name}, '{FORMS}', '', 'i'), '\\s+', ' ', 'g'))), '')"


def title_signature(title: Column) -> Column:
    """Up to ten telling words of a title."""
    x = F.lower(title)
    for p in T.TITLE_STOP_PHRASES:
        x = F.replace(x, F.lit(p), F.lit(" "))
    words = F.regexp_extract_all(x, F.lit(r"(?U)\b[a-zäöüß]{3,}\b"), F.lit(0))
    return F.array_join(F.slice(F.filter(words, lambda w: ~w.isin(T.TITLE_STOP_WORDS)), 1, 10), " ")


def title_signature_sql(title: str = "title") -> str:
    x = f"lower({title})"
    for p in T.TITLE_STOP_PHRASES:
        x = f"replace({x}, '{p}', ' ')"
    stop = ", ".join(f"'{w}'" for w in T.TITLE_STOP_WORDS)
    return f"array_to_string(list_filter(regexp_split_to_array({x}, '[^\\p{{L}}\\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-zäöüß]{{3,}}') AND w NOT IN ({stop}))[1:10], ' ')"


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two word lines: 1 if both are empty, 0 if one is."""
    x, y = (F.filter(F.array_distinct(F.split(c, " ")), lambda w: w != "") for c in (a, b))
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / union)
