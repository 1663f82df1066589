"""Chat formatting by prefix-target expansion, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: A turn is OPEN role MID text END. Texts and roles never hold OPEN's or END's marks, nor roles MID's, once escaped.
OPEN, MID, END = "### ", ": ", "</turn>\n"
#: Escapes, in order; the backslash first, so that afterwards each backslash begins an escape.
ESCAPES = (("\\", "\\b"), ("</turn>", "\\e"), ("###", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escape(text: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def unescape(text: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    """The inverse of `escape`: the backslash's own escape comes last."""
    for a, b in reversed(pairs):
        text = F.replace(text, F.lit(b), F.lit(a))
    return text


def expand(conversations: DataFrame, target: str = "assistant") -> DataFrame:
    """Training examples of `conversations` (conv_id, turn, role, text), one for each turn of the `target` role.

    Columns: conv_id, position (of the turn, from 0), formatted (all turns before it, then the reply),
    loss_start and loss_end (code points of `formatted` that are trainable: the reply's escaped text alone),
    complete (the example that shows the whole conversation). Where a conversation does not end with such a
    turn, one more row shows all of it with an empty loss, so that no turn is lost.

    Turns are ordered by (turn, role, text), nulls first, so ties and repeated rows have one result. Null texts
    and roles are empty; rows with a null conv_id are one conversation. Empty table: no rows. Other columns are
    not read. A conversation's examples grow with the square of its turns, as the method wants: each holds all
    turns before it. A conversation's turns meet in one task, for its digest and each context are one string.
    """
    turns = conversations.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    packed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"], ROLE_ESCAPES), F.lit(MID))
    whole = packed.select(
        "conv_id", F.transform("turns", lambda t: F.struct((t["role"] == target).alias("reply"), head(t).alias("head"), escape(t["text"]).alias("body"))).alias("turns"),
    ).select("conv_id", "turns", F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))).alias("marked"), F.size("turns").alias("n"))
    each = whole.select("conv_id", "marked", "n", F.posexplode("turns").alias("position", "t")).where("t.reply or position = n - 1")
    before = F.array_join(F.slice("marked", F.lit(1), F.col("position")), "")
    made = each.select("conv_id", "position", "n", "t", F.concat(before, F.col("t.head")).alias("prompt"))
    start = F.char_length("prompt")
    return made.select(
        "conv_id", F.col("position").cast("long").alias("position"), F.concat("prompt", "t.body", F.lit(END)).alias("formatted"),
        start.cast("long").alias("loss_start"), (start + F.when(F.col("t.reply"), F.char_length("t.body")).otherwise(0)).cast("long").alias("loss_end"),
        (F.col("position") == F.col("n") - 1).alias("complete"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted examples alone: the turns and the trainable text, unescaped, with digests."""
    loss = unescape(F.substr("formatted", F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int")))
    slim = examples.select("conv_id", "position", F.struct("position", loss.alias("text")).alias("loss"), F.char_length("formatted").alias("chars"), F.when(F.col("complete"), F.col("formatted")).alias("whole"))
    per = slim.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["text"]), "").alias("loss"), F.sum("chars").alias("formatted_chars"), F.max("whole").alias("whole"))
    parts = F.filter(F.split("whole", END), lambda x: x != "")  # a turn always holds its opening mark
    role = lambda x: F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), MID, 1)
    body = lambda x: F.substr(x, F.char_length(role(x)) + len(OPEN) + len(MID) + 1)
    return per.select("conv_id", "loss", "formatted_chars", F.transform(parts, lambda x: F.struct(unescape(role(x), ROLE_ESCAPES).alias("role"), unescape(body(x)).alias("text"))).alias("turns")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


PROBE = "\\### Assistant: </turn> ok"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one with control strings, formatted and read back; see `expand` and `read_back`."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(PROBE).alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("x")).select("x.*")
    return read_back(expand(rows.unionByName(probe)))


def _sql(text: str, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> str:
    for a, b in pairs:
        text = f"replace({text}, '{a}', '{b}')"
    return text


SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'
), sized AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    sum({len(OPEN + MID + END)} + length({_sql('role', ROLE_ESCAPES)}) + length({_sql('text')})) OVER (w ROWS UNBOUNDED PRECEDING) AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) FILTER (role = 'assistant' OR pos = n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
