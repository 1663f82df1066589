"""Which of many tokens each of many texts contains, as joins by equal windows; no pair is tried that shares none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The longest window; longer tokens are found by one of theirs of this length.
WINDOW = 32


def _width(n: Column) -> Column:
    """The greatest power of two up to n, at most WINDOW."""
    out, w = F.when(n >= WINDOW, WINDOW), WINDOW // 2
    while w:
        out = out.when(n >= w, w)
        w //= 2
    return out


def _windows(text: Column, width: Column) -> Column:
    """All stretches of `width` characters of a text, each once."""
    last = F.char_length(text) - width + 1
    made = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(text, i, width))
    return F.when(last >= 1, F.array_distinct(made)).otherwise(F.array().cast("array<string>"))


def contained(tokens: DataFrame, texts: DataFrame, by: list[str]) -> DataFrame:
    """Pairs (by, token, text) of distinct `tokens` (by, token) and `texts` (by, text) where the text contains the token.

    Each token is known by one window: a stretch of it as long as the greatest power of two that fits, of those the one
    that fewest tokens share. Texts are cut into windows of the lengths that occur, so a text meets only tokens that
    share half of themselves with it; the whole token then decides. Empty and null tokens and texts are in no pair.
    """
    held = tokens.where("token != ''").select(*by, "token").distinct().withColumn("width", _width(F.char_length("token")))
    cut = held.select(*by, "token", "width", F.posexplode(_windows(F.col("token"), F.col("width"))).alias("place", "window"))
    shared = cut.groupBy(*by, "width", "window").agg(F.count("*").alias("sharing"))
    keys = cut.join(shared, [*by, "width", "window"]).groupBy(*by, "token", "width").agg(F.min_by("window", F.struct("sharing", "place")).alias("window"))
    widths = held.groupBy(*by).agg(F.collect_set("width").alias("widths"))
    open_ = texts.where("text != ''").select(*by, "text").distinct().join(widths, by).select(*by, "text", F.explode("widths").alias("width"))
    open_ = open_.select(*by, "text", "width", F.explode(_windows(F.col("text"), F.col("width"))).alias("window"))
    return open_.join(keys, [*by, "width", "window"]).where(F.contains("text", F.col("token"))).select(*by, "token", "text")
