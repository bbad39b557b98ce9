"""The newest row of each key in state: of what a stream brings, only what changes a key's values goes on.

Rows of a key are conflated within a task's batch before they are shuffled, so a key with a third of all rows sends one row
a batch; the state holds one row a key and lasts over restarts. An older row than the state's changes nothing, in
whatever order rows come. Of rows of equal order the larger values win, so results don't depend on the order of files.

Defined results: null keys are a key; rows with a null order are older than all others; nulls in values compare as equal
to each other and are smaller than values; repeated rows change nothing; an empty stream gives an empty log and snapshot.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from .events import shared

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def rank(values) -> tuple:
    """Orders rows of columns that may be null: null first."""
    return tuple((v is not None, v) if v is not None else (False,) for v in values)


def conflate(batches: Iterator[pa.RecordBatch], keys: list[str], order: list[str]) -> Iterator[pa.RecordBatch]:
    """The newest row of each key of a batch."""
    for batch in batches:
        others = [c for c in batch.schema.names if c not in (*keys, *order)]
        places = pc.sort_indices(pa.table(batch), [(c, "ascending") for c in (*order, *others)], null_placement="at_start")
        kept = ~pd.DataFrame({k: batch.column(k).to_pandas() for k in keys}).iloc[places.to_numpy()].duplicated(keep="last")
        yield batch.take(places.filter(pa.array(kept.to_numpy())))


class Newest(StatefulProcessor):
    def __init__(self, keys: list[str], order: list[str], values: list[str], schema: StructType) -> None:
        self.keys, self.order, self.values, self.schema = keys, order, values, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("newest", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803  Spark's names
        columns = [*self.order, *self.values]
        best = max((tuple(row[c] for c in columns) for row in rows), key=rank)
        known = tuple(self.state.get()) if self.state.exists() else None
        if known is not None and rank(known) >= rank(best):
            return
        self.state.update(best)
        n = len(self.order)
        if known is None or known[n:] != best[n:]:
            told = (*key, *best, "added" if known is None else "revised")
            yield Row(**dict(zip((*self.keys, *columns, "state"), told, strict=True)))

    def close(self) -> None:
        pass


def changes(stream: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """keys, order, values and state (added or revised): a row for each key whose values a batch changes."""
    rows = stream.select(*keys, *order, *values)
    fewer = rows.mapInArrow(lambda batches: conflate(batches, keys, order), rows.schema)
    held = StructType([rows.schema[c] for c in (*order, *values)])
    out = StructType([rows.schema[c] for c in (*keys, *order, *values)]).add("state", "string")
    return fewer.groupBy(*keys).transformWithState(statefulProcessor=Newest(keys, order, values, held), outputStructType=out, outputMode="Update", timeMode="None")


@contextlib.contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """State on disk, which such processors need, while a query starts and runs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


class Conflation:
    """A log of changes below the shared folder. Each call of advance() takes in the files that a folder holds by then and
    goes on from the state of the call before, also in another session that is given the same folders."""

    def __init__(self, spark: SparkSession, source: str, schema: StructType, keys: list[str], order: list[str], values: list[str], log: str | None = None, state: str | None = None) -> None:
        self.spark, self.source, self.schema = spark, source, schema
        self.keys, self.order, self.values = keys, order, values
        self.log, self.state = log or shared(spark, "conflation-log"), state or shared(spark, "conflation-state")
        names = [schema[c] for c in (*keys, *order, *values)]
        self.changed = StructType(names).add("state", "string").add("batch", "long")

    def advance(self) -> None:
        def store(batch: DataFrame, number: int) -> None:
            # a batch that is repeated after a failure writes its own folder anew
            batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{self.log}/{number}")

        with rocks_state(self.spark):
            rows = changes(self.spark.readStream.schema(self.schema).parquet(self.source), self.keys, self.order, self.values)
            query = rows.writeStream.outputMode("update").option("checkpointLocation", self.state).trigger(availableNow=True).foreachBatch(store).start()
            query.awaitTermination()

    def history(self) -> DataFrame:
        """All changes, with the number of the batch that brought them."""
        self.spark.createDataFrame([], self.changed).write.mode("overwrite").parquet(f"{self.log}/none")
        return self.spark.read.schema(self.changed).option("recursiveFileLookup", True).parquet(self.log)

    def snapshot(self) -> DataFrame:
        """Each key's values as they are, with the order of the row that brought them: that of its last change."""
        newest = F.max_by(F.struct(*self.order, *self.values), "batch").alias("_row")
        return self.history().groupBy(*self.keys).agg(newest, F.count(F.lit(1)).alias("changes")).select(*self.keys, "_row.*", "changes")
