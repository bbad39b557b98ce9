"""Exact deduplication with disk-backed streaming state.

A compact log (digest, doc_id, content locator) of the documents is consumed by a Structured Streaming query whose
keyed state lives in RocksDB and never expires: per digest it keeps the largest (doc_id, locator) and the number of
rows. A later call with the same state folder continues from that state, so new files are judged against all earlier
ones. Rows that hit an occupied digest are then compared with the stored document's full text, found by its locator;
a difference stops the query instead of dropping a document.

Only DataFrame and SQL functions run on the executors.

Defined results: a null text counts as empty; a null doc_id sorts below all others; of rows with equal text and equal
doc_id the one with the larger locator stays, so exactly one row of a group is kept; an empty table gives no rows;
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .common import checkpoint_dir, lower_az, read, shared_dir, steady, stored, unused
from .components import rows_wanted

LOG_SCHEMA = "_doc bigint, _file bigint, _row bigint, _digest binary"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(docs: DataFrame):
    return lower_az(F.coalesce(docs["text"], F.lit("")))


def located(docs: DataFrame) -> DataFrame:
    """_doc, _text and the locator (_file, _row): hash of the file's path and row number in the file.

    A frame without files behind it gets Spark's row number instead; deduplicate() writes such a frame to files first.
    """
    try:
        file, row = F.xxhash64(docs["_metadata.file_path"]), docs["_metadata.row_index"]
        return docs.select(docs["doc_id"].cast("long").alias("_doc"), file.alias("_file"), row.alias("_row"), normalised(docs).alias("_text"))
    except AnalysisException:
        row = F.monotonically_increasing_id()
        return docs.select(docs["doc_id"].cast("long").alias("_doc"), F.lit(0).cast("long").alias("_file"), row.alias("_row"), normalised(docs).alias("_text"))


def append_log(docs: DataFrame, log_dir: str) -> None:
    rows = located(docs)
    rows.select("_doc", "_file", "_row", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_digest")).write.mode("append").parquet(log_dir)


def advance(spark: SparkSession, log_dir: str, state_dir: str) -> None:
    """Feeds what is new in the log to the keyed state; each changed key is appended to state_dir/keys."""
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        keys = (
            spark.readStream.schema(LOG_SCHEMA)
            .parquet(log_dir)
            .groupBy("_digest")
            .agg(F.max(F.struct("_doc", "_file", "_row")).alias("_keep"), F.count(F.lit(1)).alias("_size"))
        )

        def store(batch: DataFrame, _: int) -> None:
            batch.write.mode("append").parquet(f"{state_dir}/keys")

        query = (
            keys.writeStream.outputMode("update")
            .option("checkpointLocation", f"{state_dir}/stream")
            .trigger(availableNow=True)
            .foreachBatch(store)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def state(spark: SparkSession, state_dir: str) -> DataFrame:
    """The newest entry of each key: its maximum and count only grow, so the newest is the largest."""
    keys = spark.read.schema("_digest binary, _keep struct<_doc:bigint,_file:bigint,_row:bigint>, _size bigint").parquet(f"{state_dir}/keys")
    return keys.groupBy("_digest").agg(F.max("_keep").alias("_keep"), F.max("_size").alias("_size"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """Every row of docs with what became of it: doc_id, keep_id, group_size, kept, text_sha256, and the locator.

    The texts of hits (groups of two or more) alone are read again and compared. Joins are on the digest with the
    long side unaggregated, which adaptive execution splits where one text is held by many rows.
    """
    spark, docs = docs.sparkSession, steady(docs)
    checkpoint_dir(spark)
    log_dir, state_dir = shared_dir(spark, "dedup-log"), shared_dir(spark, "dedup-state")
    append_log(docs, log_dir)
    advance(spark, log_dir, state_dir)
    log = spark.read.schema(LOG_SCHEMA).parquet(log_dir)
    # as a table, the state is one row a digest behind a plain exchange, so adaptive execution splits the log's rows of a
    # digest that many share, and gives each part that one row
    joined = log.join(stored(state(spark, state_dir), "dedup-newest"), "_digest")
    joined = joined.withColumn("_kept", F.col("_keep").eqNullSafe(F.struct("_doc", "_file", "_row")))

    hits = joined.where("_size > 1")
    texts = located(docs).select("_file", "_row", "_text")
    hit_texts = rows_wanted(texts, hits, ("_file", "_row"))
    keepers = hit_texts.where("_kept").select(F.col("_digest").alias("_digest_k"), F.col("_text").alias("_stored"))
    checked = hit_texts.join(keepers, F.col("_digest") == F.col("_digest_k"))
    same = F.when(F.col("_text") == F.col("_stored"), F.col("_keep._doc")).otherwise(F.raise_error(F.lit("two texts share a digest")).cast("long"))

    def out(frame: DataFrame, keep_id) -> DataFrame:
        return frame.select(
            F.col("_doc").alias("doc_id"),
            keep_id.alias("keep_id"),
            F.col("_size").alias("group_size"),
            F.col("_kept").alias("kept"),
            F.lower(F.hex("_digest")).alias("text_sha256"),
            F.col("_file").alias("locator_file"),
            F.col("_row").alias("locator_row"),
        )

    return out(joined.where("_size = 1"), F.col("_keep._doc")).unionByName(out(checked, same))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their columns as they were."""
    docs = steady(docs)
    decided = deduplicate(docs).where("kept").select("locator_file", "locator_row")
    own_file, own_row = unused("agrolith_file", docs), unused("agrolith_row", docs)
    try:
        file, row = F.xxhash64(docs["_metadata.file_path"]), docs["_metadata.row_index"]
        rows = docs.select("*", file.alias(own_file), row.alias(own_row))
    except AnalysisException:
        rows = docs.select("*", F.lit(0).cast("long").alias(own_file), F.monotonically_increasing_id().alias(own_row))
    key = (rows[own_file] == decided["locator_file"]) & (rows[own_row] == decided["locator_row"])
    return rows.join(decided, key, "left_semi").drop(own_file, own_row)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256 FROM t
"""
