"""Streams: event-time windows, deduplication, delivery of growing results and cancellable queries.

Windows, watermarks and sessions extend the surface of batch queries; the same functions serve batch and stream.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def timestamped(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time with a zone, which watermarks need."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")) if dict(df.dtypes)[ts] == "timestamp_ntz" and df.isStreaming else df


def tumbling(df: DataFrame, size: str, slide: str | None = None, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """start, event_type, n, total by tumbling (or, with slide, sliding) window; a stream gets a watermark."""
    rows = timestamped(df, ts)
    if rows.isStreaming:
        rows = rows.withWatermark(ts, late)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    counted = rows.groupBy(window, "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


def sessions(df: DataFrame, gap: str, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """user_id, start, n of stretches of a user's events without a gap."""
    rows = timestamped(df, ts)
    if rows.isStreaming:
        rows = rows.withWatermark(ts, late)
    counted = rows.groupBy(F.session_window(ts, gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("user_id", F.col("s.start").cast("timestamp_ntz").alias("start"), "n")


def deduplicated(df: DataFrame, keys: list[str], late: str, ts: str = "ts") -> DataFrame:
    """The first event of each key; state is dropped behind the watermark."""
    if df.isStreaming:
        return timestamped(df, ts).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def shared(spark: SparkSession, purpose: str) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset a temporary one will do for a local session; on a
    cluster, whose executors don't see it, that is an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="agrolith-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def run_available(spark: SparkSession, path: str, transform: Callable[[DataFrame], DataFrame], mode: str) -> DataFrame:
    """Streams all that a folder or file of parquet holds through a transformation; the result as a table.

    In complete mode a batch replaces what earlier ones wrote; in append mode each batch has a folder of its own, which
    a repeated batch writes anew, so none counts twice.
    """
    out, schema = shared(spark, "stream-out"), spark.read.parquet(path).schema
    pattern = path[:-1] + f"[{path[-1]}]"  # a glob, since a stream's path may not be a single file
    rows = spark.readStream.schema(schema).parquet(pattern)
    result = transform(rows)

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/{number}")

    query = result.writeStream.outputMode(mode).option("checkpointLocation", shared(spark, "stream-state")).trigger(availableNow=True).foreachBatch(store).start()
    query.awaitTermination()
    if mode != "complete":
        spark.createDataFrame([], result.schema).write.parquet(f"{out}/none")  # a stream without rows has a result too
    return spark.read.schema(result.schema).option("recursiveFileLookup", True).parquet(out)


def growing(df: DataFrame, interval: float = 0.15) -> Iterator[Growing]:
    """Rows as they come, yielded as a growing list at most every interval, at last with done = True; an error ends it
    with the rows so far. For results that a user looks at; partitions are fetched one by one."""
    out, last = Growing([], df.schema), time.monotonic()
    try:
        for row in df.toLocalIterator(prefetchPartitions=True):
            out.rows.append(row)
            if time.monotonic() - last > interval:
                last = time.monotonic()
                yield out
    except Exception as error:  # noqa: BLE001  what a query raises is part of what is delivered
        out.error = error
    out.done = True
    yield out


@dataclass
class Growing:
    rows: list
    schema: StructType
    done: bool = False
    error: Exception | None = None


def batches(df: DataFrame) -> Iterator[pa.RecordBatch]:
    """Arrow batches of a result as the executors make them: a row of the fetched frame is a whole batch in IPC form."""

    def packed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, batch.schema) as writer:
                writer.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], ["ipc"])

    for row in df.mapInArrow(packed, "ipc binary").toLocalIterator(prefetchPartitions=True):
        yield from pa.ipc.open_stream(pa.BufferReader(bytes(row[0])))


def generated(spark: SparkSession, start: int, stop: int, step: int = 1) -> DataFrame:
    """The values of a range, as rows."""
    return spark.range(start, stop, step).withColumnRenamed("id", "value")


def ticks(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """A stream of (timestamp, value), the value counting up: a clock."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load()


def filtered_stream(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(condition)


def mapped_stream(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*(column.alias(name) for name, column in columns.items()))


def value_at(df: DataFrame, order: str, place: int, value: str):
    """The value at a place (from 0) of an order; None beyond the end. Only place + 1 rows are ordered by the driver's
    plan (a top-k), and one comes to it."""
    row = df.orderBy(order).offset(place).limit(1).select(value).collect()
    return row[0][0] if row else None


class Mutable:
    """A value that readers of a Views definition see anew when it is set."""

    def __init__(self, views: Views, name: str, value: DataFrame) -> None:
        self.views, self.name = views, name
        self.set(value)

    def set(self, value: DataFrame) -> None:
        self.views.define(self.name, [], lambda: value, replace=True)


def refreshed(old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """A snapshot after a refresh, and what changed (state: added or revised): rows of new replace those of their key where
    they differ, keys that new lacks stay. A refresh without changes gives no changed rows, so nothing need be written."""
    values = [c for c in old.columns if c not in keys]
    own = old.select(*keys, F.xxhash64(*values).alias("_hash"), F.lit(True).alias("_there"))
    told = new.join(own, keys, "left").withColumn("state", F.when(F.col("_there").isNull(), "added").when(F.xxhash64(*values) != F.col("_hash"), "revised"))
    changed = told.where(F.col("state").isNotNull()).select(*old.columns, "state")
    kept = old.join(changed.select(*keys), keys, "left_anti")
    return kept.select(*old.columns).unionByName(changed.drop("state")), changed


class Cancellable:
    """Jobs started within carry a tag, by which cancel() stops them."""

    def __init__(self, spark: SparkSession) -> None:
        self.context, self.tag = spark.sparkContext, f"agrolith-{uuid.uuid4().hex}"

    def __enter__(self) -> Cancellable:
        self.context.addJobTag(self.tag)
        return self

    def __exit__(self, *_: object) -> None:
        self.context.removeJobTag(self.tag)

    def cancel(self) -> None:
        self.context.cancelJobsWithTag(self.tag)


class Latest:
    """A foreachBatch sink that keeps the newest batch's frame: a slow reader skips what came between.

    Each batch is written whole to a folder of its own below the shared one; the folders of earlier batches stay, since
    a reader may still be at one. Nothing comes to the driver.
    """

    def __init__(self) -> None:
        self.number, self.path, self.schema = -1, None, None

    def __call__(self, batch: DataFrame, number: int) -> None:
        path = shared(batch.sparkSession, "latest")
        batch.write.parquet(path)
        self.number, self.path, self.schema = number, path, batch.schema

    def frame(self, spark: SparkSession) -> DataFrame | None:
        """All rows of the newest batch; None before the first."""
        return None if self.path is None else spark.read.schema(self.schema).parquet(self.path)


class Queue:
    """A foreachBatch sink that keeps the numbers of all batches and hands each to a function in turn."""

    def __init__(self, handle: Callable[[DataFrame, int], None]) -> None:
        self.handle, self.numbers = handle, []

    def __call__(self, batch: DataFrame, number: int) -> None:
        self.handle(batch, number)
        self.numbers.append(number)


class Views:
    """Named frames that depend on each other: defined in any order, built once, rebuilt when what they need changes."""

    def __init__(self) -> None:
        self.definitions: dict[str, tuple[list[str], Callable[..., DataFrame]]] = {}
        self.built: dict[str, DataFrame] = {}

    def define(self, name: str, needs: list[str], build: Callable[..., DataFrame], replace: bool = False) -> None:
        if name in self.definitions and not replace:
            raise ValueError(f"{name} is defined twice")
        self.definitions[name] = (needs, build)
        stale = {name}
        while more := {n for n, (own, _) in self.definitions.items() if n not in stale and stale & set(own)}:
            stale |= more
        for n in stale:
            self.built.pop(n, None)

    def get(self, name: str, path: tuple[str, ...] = ()) -> DataFrame:
        if name in path:
            raise ValueError("circular definition: " + " -> ".join((*path, name)))
        if name not in self.built:
            if name not in self.definitions:
                raise KeyError(name)
            needs, build = self.definitions[name]
            self.built[name] = build(*(self.get(n, (*path, name)) for n in needs))
        return self.built[name]
