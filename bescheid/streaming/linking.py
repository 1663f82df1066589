"""Project links as a stream: what a municipality's projects are so far is keyed state that outlives restarts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.entities import FIELDS, LINK_SCHEMA, Fold

#: What arrives: the fields that decide, and the place in the order.
ARRIVAL = "municipality_key string, seen date, doc_id long, plan_token string, parcel_token string, developer_token string, title_signature string, title string, location string, company string, procedure_type string"
#: The state of a municipality: its projects in order, the first project of each token looked up so far with the number
#: of projects looked at, the project of each developer, and how many projects and counted developers there are.
PROJECTS, TOKENS, DEVELOPERS, SIZE = "project string, place string, name string", "project int, looked int", "project string", "projects int, counted int"


class _Stored(Fold):
    """A fold that goes on from what is stored: a token's answer is read by its key, and changes are written once."""

    def __init__(self, held: Linker) -> None:
        super().__init__()
        self.held = held
        self.stored, self.counted = held.size.get() if held.size.exists() else (0, 0)
        rows = list(held.projects.get()) if self.stored else []
        self.projects, self.places, self.names = ([r[i] for r in rows] for i in range(3))
        self.changed: dict[tuple[str, str], tuple[int | None, int]] = {}

    def _first(self, kind: str, token: str, values: list[str | None]) -> int | None:
        key = (kind, token)
        if key not in self.known and self.held.tokens.containsKey(key):
            found, looked = self.held.tokens.getValue(key)
            self.known[key] = (None if found < 0 else found, looked)
        before = self.known.get(key)
        found = super()._first(kind, token, values)
        if self.known[key] != before:
            self.changed[key] = self.known[key]
        return found

    def link(self, pid, plan, parcel, developer, words, title, place, company, kind) -> tuple[str, float, str]:
        if developer and developer not in self.developers and self.held.developers.containsKey((developer,)):
            self.developers[developer] = self.held.developers.getValue((developer,))[0]
        return super().link(pid, plan, parcel, developer, words, title, place, company, kind)

    def save(self) -> None:
        new = list(zip(self.projects, self.places, self.names, strict=True))[self.stored :]
        if new:
            self.held.projects.appendList(new)
        for key, (found, looked) in self.changed.items():
            self.held.tokens.updateValue(key, (-1 if found is None else found, looked))
        for developer, project in self.developers.items():
            if not self.held.developers.containsKey((developer,)):
                self.held.developers.updateValue((developer,), (project,))
        self.held.size.update((len(self.projects), self.counted))


class Linker(StatefulProcessor):
    """Links the arriving procedures of one municipality to its projects, each micro-batch in order of (seen, doc_id)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.projects = handle.getListState("projects", PROJECTS)
        self.tokens = handle.getMapState("tokens", "kind string, token string", TOKENS)
        self.developers = handle.getMapState("developers", "developer string", DEVELOPERS)
        self.size = handle.getValueState("size", SIZE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        b = pd.concat(list(rows), ignore_index=True)
        b = b.sort_values(["day", "place"], kind="stable")
        state, out = _Stored(self), []
        for row in b[FIELDS].itertuples(index=False, name=None):
            row = [None if pd.isna(v) else v for v in row]
            out.append((key[0][1:] if key[0] else None, row[0], *state.link(*row)))
        state.save()
        found = pd.DataFrame(out, columns=["municipality_key", "procedure_id", "project_id", "link_confidence", "link_reason"])
        found["procedure_id"] = pd.array([None if x is None else int(x) for x in found["procedure_id"]], "Int64")
        yield found

    def close(self) -> None:
        pass


def linked(arrivals: DataFrame) -> DataFrame:
    """Links of a stream of procedures (ARRIVAL). A procedure joins a project founded by any that arrived before it, or
    in its micro-batch stands before it; so procedures that arrive in their order get the links of the batch form.

    The key is the municipality, null as one of its own. The state grows with projects and different tokens, not with
    procedures. Needs the RocksDB state store (`store`).
    """
    keyed = arrivals.withColumns({
        "m": F.coalesce(F.concat(F.lit("="), "municipality_key"), F.lit("")), "day": F.coalesce(F.unix_date("seen"), F.lit(-(1 << 31))), "place": F.coalesce("doc_id", F.lit(-(1 << 63))),
        # ids travel as text: beside nulls Python would see them as floating point
        "doc_id": F.col("doc_id").cast("string"),
    })
    return keyed.groupBy("m").transformWithStateInPandas(statefulProcessor=Linker(), outputStructType=LINK_SCHEMA, outputMode="Append", timeMode="None")


def store(spark: SparkSession) -> None:
    """Keep streams' state in RocksDB, which keyed state of several parts asks for."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def start(arrivals: DataFrame, table: str, checkpoint: str):
    """A stream query that appends the links of what arrives to the Parquet folder `table`, micro-batch by micro-batch, until
    nothing waits. Started again with its checkpoint it goes on where it ended; a replayed batch overwrites its own folder."""
    store(arrivals.sparkSession)

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{table}/n={number}")

    return linked(arrivals).writeStream.foreachBatch(batch).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run(procedures: DataFrame, folder: str, parts: int) -> DataFrame:
    """All links of `procedures` by way of a stream that is stopped and restarted: they arrive in `parts` files by their
    order, and each is read by a new query over the same checkpoint. They are written once before they are parted, so what
    gives them is computed once, not for their bounds and for each part."""
    spark = procedures.sparkSession
    procedures.select(*[x.split()[0] for x in ARRIVAL.split(", ")]).withColumn("_day", F.coalesce(F.unix_date("seen"), F.lit(-(1 << 31)))).write.parquet(f"{folder}/procedures")
    order = spark.read.parquet(f"{folder}/procedures")
    # by days in order: bounds of equal numbers of rows, a value for each part
    ends = order.agg(F.percentile_approx("_day", [(i + 1) / parts for i in range(parts)], 10_000)).first()[0] or []
    for i in range(parts):
        low, high = (None if i == 0 else ends[i - 1]) if ends else None, None if i == parts - 1 or not ends else ends[i]
        some = order if low is None else order.where(F.col("_day") > low)
        some = some if high is None else some.where(F.col("_day") <= high)
        some.drop("_day").write.mode("append").parquet(f"{folder}/arrivals")
        q = start(spark.readStream.schema(ARRIVAL).parquet(f"{folder}/arrivals"), f"{folder}/links", f"{folder}/checkpoint")
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return spark.read.schema(LINK_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{folder}/links")
