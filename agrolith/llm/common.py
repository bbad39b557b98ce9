"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Where the setting is absent (tests, a single machine) a temporary folder becomes the checkpoint folder.
    """
    return f"{checkpoint_dir(spark).rstrip('/')}/agrolith-{purpose}-{uuid.uuid4().hex}"


def checkpoint_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, also made known to DataFrame.checkpoint(). Where it is unset, a local session gets a temporary
    folder; on a cluster, whose executors would not see that, it is an error."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    known = context.getCheckpointDir()
    if base is None:
        if known is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = known or tempfile.mkdtemp(prefix="agrolith-")
    if known is None:
        context.setCheckpointDir(base)
    return base


def unused(name: str, df: DataFrame) -> str:
    """The name, or a longer one that none of the frame's columns has."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_az(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. ASCII texts take the byte-wise built-in; others are translated."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of doc_id as text, modulo modulus; a null doc_id counts as the empty string."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)).cast("int")


def crc32_sql(text: str) -> str:
    """DuckDB's SQL for the unsigned CRC-32 of a text's UTF-8 bytes, from the reversed polynomial."""
    digit = lambda at: f"strpos('0123456789ABCDEF', substr(hex({text}), {at}, 1)) - 1"
    bytes_of = f"list_transform(range(strlen({text})), lambda i: (({digit('2 * i + 1')}) * 16 + ({digit('2 * i + 2')}))::UBIGINT)"
    step = "list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END, xor(c, b) & 255)"
    return f"xor(list_reduce({bytes_of}, lambda c, b: xor(c >> 8, {step}), 4294967295::UBIGINT), 4294967295::UBIGINT)"


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of 8 MB at most for what runs meanwhile: each is held by the JVM and by a worker. The session's own
    setting comes back afterwards; where there was none, it is unset again."""
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, "8m")
    try:
        yield
    finally:
        spark.conf.unset(ARROW_BYTES) if before is None else spark.conf.set(ARROW_BYTES, before)


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame's rows as a table in the shared folder, read again: computed once, lineage cut, columns compressed."""
    spark, path = frame.sparkSession, shared_dir(frame.sparkSession, purpose)
    with small_batches(spark):
        frame.write.parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    out.agrolith_path = path
    return out


def discarded(*frames: DataFrame) -> None:
    """Deletes tables that stored() wrote and that nothing reads any more; other frames are left alone."""
    for frame in frames:
        if frame is not None and (path := vars(frame).get("agrolith_path")):
            context = frame.sparkSession.sparkContext
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def stored_meanwhile(frame: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The frame as stored() gives it, for what runs meanwhile; the table goes afterwards."""
    table = stored(frame, purpose)
    try:
        yield table
    finally:
        discarded(table)


def tidy(*caches: dict) -> None:
    """Called by workers at a partition's end: they serve other stages later, and shouldn't carry memory there."""
    for cache in caches:
        cache.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc alone has it
        ctypes.CDLL(None).malloc_trim(0)


def released() -> None:
    """Lets go of what earlier work left: frames that nothing names any more keep their plans alive in the JVM until
    Python's collector finds them, and freed memory stays with the process until it is trimmed. Spark deletes the files of
    exchanges and broadcasts that nothing reads any more when the JVM's collector finds those, which a driver with memory
    to spare seldom runs."""
    gc.collect()
    tidy()
    if spark := SparkSession.getActiveSession():
        spark.sparkContext._jvm.System.gc()


def steady(docs: DataFrame) -> DataFrame:
    """docs if it is a scan of files with projections and filters, whose row numbers are the same in every plan; any
    other frame is written to the shared folder first, since its rows may come in another order each time."""
    nodes, names = [docs._jdf.queryExecution().optimizedPlan()], set()
    while nodes:
        node = nodes.pop()
        names.add(node.nodeName().split(" ")[0])
        children = node.children()
        nodes += [children.apply(at) for at in range(children.size())]
    return docs if names <= {"Project", "Filter", "LogicalRelation", "Relation"} else stored(docs, "input")
