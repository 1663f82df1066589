"""Who founds a project and who joins one, settled in rounds over the whole table instead of row by row in each municipality.

A procedure founds a project unless an earlier founder of its municipality has a place that contains its parcel, a name
that contains its plan, or, among the first fifty with one, its developer. So of procedures with the same tokens only
the first can found one, and a procedure joins the earliest founder for its token if that came before it. What has to be
settled is one answer for each combination of tokens, and it depends on earlier combinations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import cut
from .containment import contained

#: Fixed value: founders of a municipality whose developers are looked at.
DEVELOPERS = 50
#: How sure a link is, and why.
PARCEL, PLAN, DEVELOPER = (0.95, "PARCEL_MATCH"), (0.9, "PLAN_TOKEN_MATCH"), (0.8, "DEV+TITLE_MATCH")
PERMIT, NEW = (0.85, "PERMIT_36_NEW"), (1.0, "NEW_PROJECT")

_KEY = ["kind", "m", "token"]


def _some(c: Column | str) -> Column:
    """A text, null if it is empty."""
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))


def slim(procedures: DataFrame) -> DataFrame:
    """What decides, one row per procedure: m, its place in the order, tokens, and what it would give a project.

    Written once: rows alike in `seen` and doc_id are ordered by a hash of their fields, then by their number there.
    """
    x = procedures.select(
        F.coalesce(F.concat(F.lit("="), F.col("municipality_key").cast("string")), F.lit("")).alias("m"), "municipality_key", "doc_id", "seen", _some("parcel_token").alias("parcel"), _some("plan_token").alias("plan"),
        _some("developer_token").alias("developer"), (_some("title_signature").isNotNull()).alias("worded"), _some("title").alias("title"), _some("location").alias("location"), (_some("company").isNotNull()).alias("named"),
        F.coalesce(F.col("procedure_type") == "PERMIT_36_EINVERNEHMEN", F.lit(False)).alias("permit"),
    )
    tie = F.xxhash64("parcel", "plan", "developer", "worded", "title", "location", "named", "permit")
    at = F.struct(F.coalesce(F.unix_date("seen"), F.lit(-(1 << 31))).alias("day"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), tie.alias("tie"), F.monotonically_increasing_id().alias("row"))
    asks, lone = F.when(F.col("worded"), F.col("developer")), F.col("parcel").isNull() & F.col("plan").isNull()
    x = x.select(
        "m", "municipality_key", "doc_id", at.alias("at"), "parcel", "plan", asks.alias("asks"), F.when(F.col("named"), F.col("developer")).alias("gives"), F.coalesce("parcel", "location").alias("place"),
        F.when(F.col("plan").isNotNull(), F.concat(F.lit("B-Plan "), "plan")).otherwise(F.col("title")).alias("name"), "permit", (lone & asks.isNull()).alias("free"), (lone & asks.isNotNull()).alias("lone"),
    )
    # a lone developer without a company asks but never gives: each such row stands for itself
    own = F.when(F.col("lone") & F.col("gives").isNull(), F.col("at.row"))
    fields = ["m", "parcel", "plan", "asks", own]
    # null and text differ in a hash only by chance: their pattern is hashed, too
    shape = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in ("parcel", "plan", "asks")])
    return cut(x.withColumn("unit", F.struct(F.xxhash64(shape, *fields).alias("x"), F.xxhash64(F.lit(1), shape, *fields).alias("y"))))


def _units(rows: DataFrame) -> DataFrame:
    """One row for each combination of tokens (its first procedure), and one for the later procedures that have only a developer."""
    held = rows.where("not free").withColumn("tail", F.lit(False))
    first = F.min("at").alias("at")
    values = [F.min_by(c, "at").alias(c) for c in ("m", "parcel", "plan", "asks", "gives", "place", "name", "lone")]
    heads = held.groupBy("unit").agg(first, *values).withColumn("tail", F.lit(False))
    later = held.where("lone").join(heads.where("lone").select("unit", F.col("at").alias("head")), "unit").where("at > head")
    tails = later.groupBy("unit").agg(first, F.min_by("m", "at").alias("m"), F.min_by("asks", "at").alias("asks")).withColumn("tail", F.lit(True))
    return heads.unionByName(tails, allowMissingColumns=True)


def _texts(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Texts that tokens may be in, with the earliest procedure of a unit that would give them: kind, m, text, unit, tail, at; no unit for free rows."""
    kinds = F.explode(F.array(F.struct(F.lit("parcel").alias("kind"), F.col("place").alias("text")), F.struct(F.lit("plan").alias("kind"), F.col("name").alias("text")))).alias("x")
    given = lambda df: df.select("m", "unit", "tail", "at", kinds).select("x.kind", "m", "x.text", "unit", "tail", "at").where("text is not null")
    later = rows.where("lone").join(units.where("not tail and lone").select("unit", F.col("at").alias("head")), "unit").where("at > head").withColumn("tail", F.lit(True))
    free = rows.where("free").withColumn("unit", F.lit(None).cast(rows.schema["unit"].dataType)).withColumn("tail", F.lit(False))
    many = given(later).unionByName(given(free)).groupBy("kind", "m", "text", "unit", "tail").agg(F.min("at").alias("at"))
    return given(units.where("not tail")).unionByName(many)


def _first(givers: DataFrame, n: int = DEVELOPERS) -> DataFrame:
    """The first n of each municipality, with their place."""
    return givers.withColumn("nth", F.row_number().over(W.partitionBy("m").orderBy("at"))).where(F.col("nth") <= n)


def _answers(founded: DataFrame, possible: DataFrame, givers: DataFrame, maybe: DataFrame) -> DataFrame:
    """(kind, m, token, hi, lo): the earliest sure founder for a token, and the earliest that may turn out to be one.

    A developer counts within the first fifty founders that have one: surely, if with all that are still open it is among
    them, possibly, if with the sure founders alone it is.
    """
    both = givers.withColumn("sure", F.lit(True)).unionByName(maybe.withColumn("sure", F.lit(False)))
    hi = _first(both).where("sure").groupBy("m", "token").agg(F.min("at").alias("hi"))
    end = _first(givers).where(F.col("nth") == DEVELOPERS).select("m", F.col("at").alias("end"))
    lo = both.join(end, "m", "left").where("end is null or at <= end").groupBy("m", "token").agg(F.min("at").alias("lo"))
    dev = lo.join(hi, ["m", "token"], "left").select(F.lit("developer").alias("kind"), "m", "token", "hi", "lo")
    texts = founded.select(*_KEY, F.col("at").alias("hi"), F.col("at").alias("lo")).unionByName(possible.select(*_KEY, F.lit(None).cast(founded.schema["at"].dataType).alias("hi"), F.col("at").alias("lo")))
    return texts.groupBy(*_KEY).agg(F.min("hi").alias("hi"), F.min("lo").alias("lo")).unionByName(dev)


def _asked(units: DataFrame) -> DataFrame:
    """One row for each token of a unit: unit, tail, at, kind, m, token."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("token")) for k, c in (("parcel", "parcel"), ("plan", "plan"), ("developer", "asks"))])).alias("x")
    return units.select("unit", "tail", "at", "m", each).select("unit", "tail", "at", "m", "x.kind", "x.token").where("token is not null")


def settled(rows: DataFrame) -> DataFrame:
    """The earliest founder for each token (kind, m, token, at) that any procedure asks for.

    Round by round every unit is decided for which nothing earlier is open: it founds a project if no token of its has a
    founder before it, and does not as soon as one surely has. The first open unit of each municipality is always
    decided, so rounds end; they are as many as the longest chain of units that hang on one another. Work falls with
    what is open. Only a count reaches the driver.
    """
    units = cut(_units(rows))
    texts = cut(_texts(rows, units))
    tokens = _asked(units).where("kind != 'developer'").select(*_KEY).distinct()
    pairs = contained(tokens, texts, ["kind", "m"])
    cover = pairs.join(texts, ["kind", "m", "text"]).groupBy(*_KEY, "unit", "tail").agg(F.min("at").alias("at"))
    cover = cut(cover)
    founded = cut(cover.where("unit is null").select(*_KEY, "at"))
    possible = cover.where("unit is not null")
    givers = _first(rows.where("free and gives is not null").select("m", F.col("gives").alias("token"), "at")).drop("nth")
    givers = cut(givers)
    open_ = units
    while True:
        maybe = open_.where("gives is not null").select("m", F.col("gives").alias("token"), "at")
        answers = _answers(founded, possible, givers, maybe)
        said = _asked(open_).join(answers, _KEY, "left").groupBy("unit", "tail").agg(
            F.bool_or(F.coalesce(F.col("hi") < F.col("at"), F.lit(False))).alias("joins"), F.bool_and(F.coalesce(F.col("lo") >= F.col("at"), F.lit(True))).alias("founds")
        )
        now = cut(open_.join(said, ["unit", "tail"]))
        new = now.where("founds").select("unit", "tail")
        givers = cut(_first(givers.unionByName(now.where("founds and gives is not null").select("m", F.col("gives").alias("token"), "at"))).drop("nth"))
        founded = cut(founded.unionByName(possible.join(new, ["unit", "tail"], "left_semi").select(*_KEY, "at")).groupBy(*_KEY).agg(F.min("at").alias("at")))
        open_ = now.where("not founds and not joins").drop("joins", "founds")
        if open_.isEmpty():
            break
        possible = cut(possible.join(open_.select("unit", "tail"), ["unit", "tail"], "left_semi"))
    final = _first(givers).groupBy("m", "token").agg(F.min("at").alias("at")).select(F.lit("developer").alias("kind"), "m", "token", "at")
    return founded.unionByName(final)


def linked(procedures: DataFrame) -> DataFrame:
    """Procedure to project links: municipality_key, procedure_id, project_id, link_confidence, link_reason.

    The same links as procedures taken one by one in the order (seen, doc_id) would get. A municipality is spread over
    tasks by its tokens, as it is only looked up by them. Rows with a null doc_id or key, empty tokens and repeated rows
    keep their place. Empty table: no rows.
    """
    rows = slim(procedures)
    first = settled(rows)
    asked = _asked(rows.where("not free").groupBy("unit").agg(F.min("at").alias("at"), *[F.min_by(c, "at").alias(c) for c in ("m", "parcel", "plan", "asks")]).withColumn("tail", F.lit(False)))
    of = asked.join(first.withColumnRenamed("at", "found"), _KEY).groupBy("unit").agg(*[F.max(F.when(F.col("kind") == k, F.col("found"))).alias(k) for k in ("parcel", "plan", "developer")])
    own = F.struct(F.col("doc_id").alias("doc"), F.when(F.col("permit"), F.lit(PERMIT[0])).otherwise(NEW[0]).alias("sure"), F.when(F.col("permit"), PERMIT[1]).otherwise(NEW[1]).alias("why"))
    pick = lambda k, link: F.struct(F.nullif(F.col(f"{k}.doc"), F.lit(-(1 << 63))).alias("doc"), F.lit(link[0]).alias("sure"), F.lit(link[1]).alias("why"))
    known = rows.where("not free").drop("parcel", "plan").join(of, "unit", "left")
    link = F.when(F.col("parcel") < F.col("at"), pick("parcel", PARCEL)).when(F.col("plan") < F.col("at"), pick("plan", PLAN)).when(F.col("developer") < F.col("at"), pick("developer", DEVELOPER)).otherwise(own)
    columns = ["municipality_key", "doc_id", "link"]
    found = known.withColumn("link", link).select(*columns).unionByName(rows.where("free").withColumn("link", own).select(*columns))
    return found.select("municipality_key", F.col("doc_id").alias("procedure_id"), F.concat(F.lit("project-"), F.coalesce(F.col("link.doc").cast("string"), F.lit("None"))).alias("project_id"), F.col("link.sure").alias("link_confidence"), F.col("link.why").alias("link_reason"))
