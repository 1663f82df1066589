"""Text as Catalyst expressions: normal forms, slugs, addresses, digests; with the SQL that DuckDB runs for each."""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

UMLAUTS = (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue"), ("ß", "ss"))


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(x: Column, f) -> Column:
    """f(x) with x computed once, however often f names it."""
    return F.get(F.transform(F.array(x), f), 0)


def replace_all(x: Column | str, pairs) -> Column:
    x = col(x)
    for a, b in pairs:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def replace_all_sql(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def normalize_umlauts(x: Column | str) -> Column:
    return replace_all(x, UMLAUTS)


def normalize(x: Column | str) -> Column:
    """Lower case, umlauts as two letters, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(normalize_umlauts(F.lower(col(x))), r"(?U)\s+", " "))


def normalize_sql(x: str) -> str:
    return f"trim(regexp_replace({replace_all_sql(f'lower({x})', UMLAUTS)}, '\\s+', ' ', 'g'))"


def text_variants(x: Column | str) -> Column:
    """The normal form, and the lower-case original where it differs."""
    return F.array_distinct(F.array(normalize(x), F.lower(col(x))))


def _letters(text: str) -> str:
    return re.sub(r"[^a-z0-9äöüß\s]", " ", unicodedata.normalize("NFKD", text).lower())


def title_key(title: str | None) -> str | None:
    """NFKD, lower case, everything but letters, digits and spaces to spaces, collapsed. A combining mark, too,
    becomes a space, so that "ä" decomposes to "a" and a space."""
    return None if title is None else re.sub(r"\s+", " ", _letters(title)).strip()


@functools.cache
def _decomposed() -> dict[str, str]:
    """What each character beyond ASCII gives in a title key, where that has letters or digits; in order of code points."""
    every = (chr(x) for x in range(0x80, sys.maxunicode + 1) if not 0xD800 <= x < 0xE000)
    return {x: key for x in every if x != "ß" and (key := _letters(x)).strip()}


def _character_class(chars: Iterable[str]) -> str:
    """A pattern of any of the characters, neighbours as ranges."""
    spans: list[list[int]] = []
    for x in sorted(map(ord, chars)):
        if spans and spans[-1][1] == x - 1:
            spans[-1][1] = x
        else:
            spans.append([x, x])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in spans) + "]"


def normalize_title(x: Column | str) -> Column:
    """`title_key` of a column, in built-in functions: what a character decomposes to does not hang on its neighbours, so
    each different character of a title that decomposes to letters or digits is replaced at once."""
    table = _decomposed()
    parts = F.from_json(F.lit(json.dumps(table)), "map<string,string>")
    found = F.array_distinct(F.regexp_extract_all(col(x), F.lit(f"({_character_class(table)})")))
    plain = F.aggregate(found, col(x), lambda text, char: F.replace(text, char, F.element_at(parts, char)))
    return F.trim(F.regexp_replace(F.lower(plain), "[^a-z0-9ß]+", " "))


def normalize_title_sql(x: str) -> str:
    """For Latin letters: the mark that an accented letter loses leaves a space behind it."""
    spaced = f"regexp_replace({x}, '([À-ÖØ-Þà-öø-ÿĀ-ſ])', '\\1 ', 'g')"
    return f"trim(regexp_replace(lower(strip_accents({spaced})), '[^a-z0-9ß]+', ' ', 'g'))"


def procedure_hash(title: Column | str, key: Column | str) -> Column:
    return F.concat(col(key), F.lit(":"), normalize_title(title))


_LOWER_UMLAUTS = (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"))


def slug(name: Column | str, variant: str = "A") -> Column:
    """Address part of a place name. A keeps dots; B and C drop dots and commas (C has no fallback for an empty
    result); D drops spaces instead of dashing them."""
    n = col(name)
    bare = F.regexp_replace(F.lower(n), r"\([^)]*\)", "")
    if variant == "D":
        x = replace_all(F.replace(F.replace(F.replace(bare, F.lit(" "), F.lit("")), F.lit("("), F.lit("")), F.lit(")"), F.lit("")), _LOWER_UMLAUTS)
        return F.regexp_replace(x, r"[^a-z0-9\-.]", "")
    x = replace_all(bare, (*_LOWER_UMLAUTS, ("/", "-"), ("\\", "-"), *((() if variant == "A" else ((".", ""), (",", ""))))))
    x = F.regexp_replace(F.regexp_replace(x, r"[\s_]+", "-"), "-+", "-")
    x = F.regexp_replace(F.regexp_replace(x, r"^[-.]+|[-.]+$", ""), r"[^a-z0-9\-.]", "")
    if variant == "C":
        return x
    first = F.regexp_replace(F.get(F.split(F.trim(F.lower(n)), r"\s+"), 0), "[^a-z0-9]", "")
    return F.when(n == "", F.lit("")).when(x.isin("", "-"), F.when(F.trim(n) != "", first).otherwise("unknown")).otherwise(x)


def slug_sql(n: str, variant: str = "A") -> str:
    bare = f"regexp_replace(lower({n}), '\\([^)]*\\)', '', 'g')"
    if variant == "D":
        return f"regexp_replace({replace_all_sql(bare, ((' ', ''), ('(', ''), (')', ''), *_LOWER_UMLAUTS))}, '[^a-z0-9\\-.]', '', 'g')"
    x = replace_all_sql(bare, (*_LOWER_UMLAUTS, ("/", "-"), ("\\", "-"), *(() if variant == "A" else ((".", ""), (",", "")))))
    x = f"regexp_replace(regexp_replace({x}, '[\\s_]+', '-', 'g'), '-+', '-', 'g')"
    x = f"regexp_replace(regexp_replace({x}, '^[-.]+|[-.]+$', '', 'g'), '[^a-z0-9\\-.]', '', 'g')"
    if variant == "C":
        return x
    first = f"regexp_replace(regexp_split_to_array(trim(lower({n})), '\\s+')[1], '[^a-z0-9]', '', 'g')"
    return f"CASE WHEN {n} = '' THEN '' WHEN {x} IN ('', '-') THEN CASE WHEN trim({n}) <> '' THEN {first} ELSE 'unknown' END ELSE {x} END"


def authority(url: Column | str) -> Column:
    """Host and port of an address; null where it cannot be parsed."""
    return F.try_parse_url(col(url), F.lit("AUTHORITY"))


def sha256(x: Column | str) -> Column:
    return F.sha2(col(x), 256)


def grouped(n: Column | str) -> Column:
    """1234567 as 1.234.567."""
    return F.translate(F.format_number(col(n), 0), ",", ".")


def error_status(message: Column | str) -> Column:
    m = F.lower(col(message))
    return F.when(m.contains("ssl") | m.contains("certificate") | m.contains("tls"), "ERROR_SSL").when(m.contains("timeout") | m.contains("connection"), "ERROR_NETWORK").otherwise("ERROR_OTHER")


def reason_code(seeded: Column, failures: Column) -> Column:
    """Why no source was found, from a map of failed addresses; an empty map counts as all 404."""
    v = F.map_values(failures)
    return (
        F.when(~seeded, "NO_SEED_URL")
        .when(F.forall(v, lambda x: x.contains("404") | x.contains("Not Found")), "ALL_URLS_404")
        .when(F.exists(v, lambda x: x.contains("SSL") | x.contains("certificate")), "SSL_BLOCKED")
        .otherwise("NO_MARKERS_FOUND")
    )


# The character references by name that German pages use, besides numbers; the ampersand comes last.
REFERENCES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "shy": "\u00ad", "auml": "ä", "ouml": "ö", "uuml": "ü", "Auml": "Ä", "Ouml": "Ö", "Uuml": "Ü", "szlig": "ß", "eacute": "é", "egrave": "è", "agrave": "à",
    "ccedil": "ç", "ntilde": "ñ", "sect": "§", "para": "¶", "copy": "©", "reg": "®", "deg": "°", "sup2": "²", "sup3": "³", "middot": "·", "times": "×", "laquo": "«", "raquo": "»", "euro": "€", "ndash": "–", "mdash": "—", "bdquo": "„",
    "ldquo": "“", "rdquo": "”", "lsquo": "‘", "rsquo": "’", "sbquo": "‚", "hellip": "…", "bull": "•", "amp": "&",
}


def decode_references(x: Column | str) -> Column:
    """`x` with character references by name (REFERENCES) or number decoded, once; others stay as they are."""
    return let(col(x), _decoded)


#: One literal and one step, not a node of the plan for each name.
_NAMED = "\n".join(f"&{name};\t{value}" for name, value in REFERENCES.items())


def _decoded(x: Column) -> Column:
    parts = F.split(x, "&#(?=[0-9]{1,8};|[xX][0-9a-fA-F]{1,7};)")

    def char(n: Column) -> Column:
        bad = (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        return F.when(bad, "\ufffd").otherwise(F.decode(F.unhex(F.lpad(F.hex(F.when(bad, 65).otherwise(n)), 8, "0")), "UTF-32"))

    def numbered(p: Column, i: Column) -> Column:
        name = F.substring_index(p, ";", 1)
        n = F.when(F.lower(name).startswith("x"), F.conv(F.substr(name, F.lit(2)), 16, 10)).otherwise(name).try_cast("long")
        return F.when(i == 0, p).otherwise(F.concat(char(n), F.substr(p, F.char_length(name) + 2)))

    out = F.array_join(F.transform(parts, numbered), "")
    named = F.split(F.lit(_NAMED), "\n")
    out = F.aggregate(named, out, lambda acc, r: F.replace(acc, F.substring_index(r, "\t", 1), F.substring_index(r, "\t", -1)))
    return F.when(x.contains("&"), out).otherwise(x)
