"""Which terms a text holds, in one scan.

Rules ask for hundreds of substrings. Instead of one `contains` each, an Aho-Corasick automaton over all terms
of all rules scans a text once (Arrow batches) and gives the numbers of the terms it holds; rules are then
array tests on that small column, in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from . import terms

#: Single words that rules use beside the lists.
LOOSE = [
    "speicher", "windpark", "netz", "§ 36", "vorhaben", "antrag auf", "schaltanlage", "110", "220", "380", "solar", "wind", "anschluss", "spannung", "kv", "batterie", "energiepark",
    "§35 baugb", "§ 35bau gb", "§35bau gb", "§34 baugb", "§ 34bau gb", "§34bau gb", "§36 baugb", "§ 36bau gb", "§36bau gb",
]


def _all() -> list[str]:
    found: dict[str, None] = dict.fromkeys(LOOSE)
    for name in sorted(vars(terms)):
        value = getattr(terms, name)
        if name.isupper() and name not in ("THRESHOLDS", "STAGE_OF", "STAGES", "TITLE_STOP_WORDS"):
            found.update(dict.fromkeys(value))
    return list(found)


TERMS = _all()
NUMBER = {t: i for i, t in enumerate(TERMS)}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for t, i in NUMBER.items():
        a.add_word(t, i)
    a.make_automaton()
    return a


def numbers_in(text: str | None) -> list[int] | None:
    return None if text is None else sorted({i for _, i in _automaton().iter(text)})


@F.pandas_udf(ArrayType(IntegerType()))
def _hits(text: pd.Series) -> pd.Series:
    return text.map(numbers_in)


#: The same, but never moved or repeated by the optimizer: a filter on what follows from it stays above it.
_hits_once = F.pandas_udf(lambda text: text.map(numbers_in), ArrayType(IntegerType())).asNondeterministic()


def hits(text: Column | str, once: bool = False) -> Column:
    """Numbers of all known terms that `text` holds, ascending; null for null. Terms are in lower case.

    `once`: for columns that filters follow, which would else scan below and above the filter.
    """
    return _hits_once(text) if once else _hits(text)


def numbers(wanted: Iterable[str]) -> list[int]:
    return [NUMBER[t] for t in wanted]


def has(found: Column | str, *wanted: str) -> Column:
    """Whether any of the terms is among `found`."""
    col = F.col(found) if isinstance(found, str) else found
    if len(wanted) == 1:
        return F.array_contains(col, NUMBER[wanted[0]])
    return F.arrays_overlap(col, F.lit(numbers(wanted)))


def count(found: Column | str, wanted: Iterable[str]) -> Column:
    """How many of the terms are among `found`."""
    col = F.col(found) if isinstance(found, str) else found
    return F.size(F.array_intersect(col, F.lit(numbers(wanted))))


def weight(found: Column | str, weights: dict[str, int]) -> Column:
    """Sum of the weights of the terms among `found`."""
    col = F.col(found) if isinstance(found, str) else found
    table = [0] * len(TERMS)
    for t, w in weights.items():
        table[NUMBER[t]] = w
    return F.aggregate(col, F.lit(0), lambda s, i: s + F.element_at(F.lit(table), i + 1))
