"""Pages of a service as a stream: the offset is the cursor, so a stopped harvest goes on at the page where it stood.

A client tells how many pages there are and gives a page's text; it is sent to the tasks, each of which fetches a
stretch of pages, tries again after a pause that doubles, and raises when a page cannot be had. Spark writes down the cursor
before a batch runs and commits it afterwards; a batch that failed is fetched again from its first page, and its rows are
written to the batch's own folder, so each page is there once. Network access is the client's.

Defined results: a service without pages gives no rows; pages that come later are fetched by the next harvest; a page whose
text is null is a row with a null text; a page that states another number than the one asked for counts as a failure.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..streaming.events import shared

SCHEMA = "page bigint, text string"
NAME = "agrolith_pages"
#: A batch costs its log and its commit, whatever it holds, so of many pages it has one part in so many at least; each is
#: fetched by so many tasks a core, if these have more pages then.
BATCHES, TASKS = 20, 4
#: Pages of a task, unless told otherwise.
EACH = 20


class Client:
    """What a service must offer; pages count from 0. Sent to tasks, so it holds settings, not connections."""

    def pages(self) -> int:
        raise NotImplementedError

    def page(self, number: int) -> str | None:
        raise NotImplementedError

    def echo(self, text: str | None, number: int) -> int:
        """The number that a page states."""
        return number


class Stretch(InputPartition):
    def __init__(self, first: int, end: int) -> None:
        self.first, self.end = first, end


def fetched(client: Client, number: int, tries: int, pause: float) -> str | None:
    problem: Exception | None = None
    for turn in range(tries):
        if turn:
            time.sleep(pause * 2 ** (turn - 1))
        try:
            text = client.page(number)
            if client.echo(text, number) != number:
                raise ValueError(f"page {client.echo(text, number)} came instead of {number}")
            return text
        except Exception as error:  # noqa: BLE001  whatever a client raises is tried again
            problem = error
    raise RuntimeError(f"page {number} could not be had in {tries} tries") from problem


class PageReader(DataSourceStreamReader):
    """from: the page where a batch begins until Spark names another; until: the last batch's end; batch: most pages of one."""

    def __init__(self, client: Client, options: dict) -> None:
        self.client, self.until = client, int(options["until"]) if "until" in options else None
        self.at, self.batch = int(options.get("from", 0)), int(options["batch"]) if "batch" in options else None
        self.each, self.tries, self.pause = int(options.get("each", EACH)), int(options.get("tries", 4)), float(options.get("pause", 2.0))

    def initialOffset(self) -> dict:  # noqa: N802  Spark's name
        return {"page": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        there = self.client.pages() if self.until is None else self.until
        return {"page": there if self.batch is None else min(there, self.at + self.batch)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.at = end["page"]  # a batch that is run; the next one begins behind it
        return [Stretch(low, min(low + self.each, end["page"])) for low in range(start["page"], end["page"], self.each)]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        for number in range(partition.first, partition.end):
            yield number, fetched(self.client, number, self.tries, self.pause)

    def commit(self, end: dict) -> None:
        """Spark keeps the cursor; the service needs none."""


def register(spark: SparkSession, client: Client) -> None:
    """Makes the client's pages readable as a stream of format NAME."""

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return NAME

        def schema(self) -> str:
            return SCHEMA

        def streamReader(self, schema) -> PageReader:  # noqa: N802
            return PageReader(client, self.options)

    spark.dataSource.register(Pages)


class Harvest:
    """Pages below the shared folder. advance() fetches what is there beyond the cursor, so many pages a batch, or one part in
    BATCHES of all pages where that is more; another session that is given the same folders goes on from there."""

    def __init__(self, spark: SparkSession, client: Client, pages_a_batch: int = 1000, out: str | None = None, state: str | None = None, **options) -> None:
        self.spark, self.client, self.batch, self.options = spark, client, pages_a_batch, options
        self.out, self.state = out or shared(spark, "harvest"), state or shared(spark, "harvest-state")

    def rows(self) -> DataFrame:
        self.spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(f"{self.out}/none")
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(self.out)

    def cursor(self) -> int:
        """The page behind the last one that is written: where the committed cursor stands, or, where a run ended between
        writing and committing, the end of the batch that is repeated first."""
        last = self.rows().agg({"page": "max"}).first()[0]
        return 0 if last is None else last + 1

    def advance(self) -> None:
        """One stream runs all batches, so a batch costs its fetching and no stream's start. Their number doesn't grow with the
        pages, and what is fetched again after a failure is a fixed share of them at most."""
        register(self.spark, self.client)
        there, at = self.client.pages(), self.cursor()
        if at >= there:
            return
        batch = max(self.batch, -(-there // BATCHES))
        each = max(int(self.options.get("each", EACH)), -(-batch // (TASKS * self.spark.sparkContext.defaultParallelism)))
        options = {"from": at, "until": there, "batch": batch, **self.options, "each": each}
        stream = self.spark.readStream.format(NAME).options(**options).load()

        def store(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.out}/{number}")

        query = stream.writeStream.option("checkpointLocation", self.state).foreachBatch(store).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
