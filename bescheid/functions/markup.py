"""Markup read in one forward pass: every step looks at a stretch of the page once, however broken the page is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let

#: Scripts, styles and comments, to the page's end where nothing closes them, as browsers read them.
SILENT = r"(?is)<(?:script|style)[^>]*+(?:>.*?(?:</(?:script|style)>|\z)|\z)|<!--.*?(?:-->|\z)"


def _then(array: Column, **made) -> Column:
    """Structs with further fields; each is computed once, which names within one expression would not be."""
    for name, f in made.items():
        array = F.transform(array, _with(name, f))
    return array


def _with(name: str, f):
    return lambda x: x.withField(name, f(x))


def tags(html: Column | str, name: str, attribute: str) -> Column:
    """Start tags `name` of a page that have the attribute, in order: array of (value, inside).

    The value stands in double, single or no quotes, among attributes in any order; a quoted one may hold `>`. `inside` is
    what follows the tag up to the next start tag of that name or the page's end. The page is split at those tags; what is
    looked for in a piece ends with it, so a tag or quote that is never closed costs its own piece only.
    """
    pieces = F.split(col(html), rf"(?i)<{name}(?=\s)", -1)
    x = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: F.struct(p.alias("piece")))
    start = rf"(?is)^(?:.*?\s)?{attribute}\s*+=\s*+"
    x = _then(
        x, head=lambda x: F.char_length(F.regexp_extract(F.substring_index(x["piece"], ">", 1), start, 0)),
        rest=lambda x: F.when(x["head"] > 0, F.substr(x["piece"], x["head"] + 1)),
        quote=lambda x: F.left(x["rest"], F.lit(1)),
        quoted=lambda x: x["quote"].isin('"', "'"),
        body=lambda x: F.when(x["quoted"], F.substr(x["rest"], F.lit(2))),
        value=lambda x: F.when(x["quoted"], F.when(F.contains(x["body"], x["quote"]), F.substring_index(x["body"], '"', 1)).otherwise(None)).otherwise(F.nullif(F.regexp_extract(x["rest"], r"""^[^\s>"']+""", 0), F.lit(""))),
    )
    # substring_index takes a literal, so single quotes are cut apart
    x = _then(
        x, value=lambda x: F.when((x["quote"] == "'") & x["value"].isNotNull(), F.substring_index(x["body"], "'", 1)).otherwise(x["value"]),
        after=lambda x: F.substr(x["rest"], F.char_length(x["value"]) + F.when(x["quoted"], 3).otherwise(1)),
        close=lambda x: F.position(F.lit(">"), x["after"]),
        inside=lambda x: F.when(x["close"] > 0, F.substr(x["after"], x["close"] + 1)),
    )
    return F.transform(F.filter(x, lambda x: x["inside"].isNotNull()), lambda x: F.struct(x["value"].alias("value"), x["inside"].alias("inside")))


def without_tags(x: Column | str, mark: str) -> Column:
    """A text with `mark` in place of each tag. What follows the last `>` can hold none and is not searched."""
    def cut(x: Column, tail: Column) -> Column:
        return F.concat(F.regexp_replace(F.left(x, F.char_length(x) - F.char_length(tail)), "<[^>]*+>", mark), tail)

    return let(col(x), lambda x: F.when(F.contains(x, F.lit(">")), let(F.substring_index(x, ">", -1), lambda tail: cut(x, tail))).otherwise(x))


def inside_first(html: Column | str, name: str) -> Column:
    """The inside of a page's first element of a kind; null if there is none.

    Only the first start tag is looked at: where none of its kind is closed behind it, none is behind a later one.
    """
    html = col(html)
    after = lambda x, mark: let(F.position(F.lit(mark), x), lambda at: F.when(at > 0, at))
    rest = let(after(F.lower(html), f"<{name}"), lambda at: F.substr(html, at))
    inside = let(rest, lambda x: F.substr(x, after(x, ">") + 1))
    return let(F.split(inside, f"(?i)</{name}>", 2), lambda parts: F.when(F.size(parts) > 1, F.get(parts, 0)))


def text_of(html: Column | str) -> Column:
    """A page's text with a line break for each tag; scripts, styles and comments give nothing."""
    return without_tags(F.regexp_replace(col(html), SILENT, ""), "\n")


def lines(x: Column | str) -> Column:
    """A text whose stretches of white space with a line break are that break alone. Stretches are looked at from their start only."""
    return F.regexp_replace(col(x), r"(?<!\s)[^\S\n]*+\n\s*+", "\n")
