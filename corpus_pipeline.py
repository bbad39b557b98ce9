"""A corpus pipeline of the llm operators: each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept. All but the last return the columns of documents; the last returns one row a document with its encoding.

Nulls, repeated rows, empty tables and extra columns are handled as the operators' docstrings state; a stage passes on
extra columns as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agrolith.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from agrolith.llm.common import read, released, shared_dir


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar scores at its threshold or above go."""
    released()
    return toxicity.keep_clean(docs, toxicity.fit_labelled(docs, read(spark, sf_dir, "labels")))


def exact_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    released()
    return exact_dedup.keep_first(docs)


def near_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of the n-gram Jaccard join (five words, 80 %) the document with the smallest doc_id stays."""
    released()
    return jaccard_join.keep_one(docs, words=5, percent=80)


def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay by their rate in the target mixture; rates are in [0, 1], so nothing is repeated."""
    released()
    return mixing.thin(docs, read(spark, sf_dir, "labels"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    released()
    return bpe.encoded_digests(docs)


STAGES = [
    ("toxicity", toxic_documents_go),
    ("exact dedup", exact_copies_go),
    ("n-gram Jaccard join", near_copies_go),
    ("mixing sources to target weights", mixed_to_targets),
    ("BPE encoding and decoding", encoded),
]

#: The grammar, the fitted mixture and the encoding have no SQL form; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return out
        path = shared_dir(spark, f"stage-{number}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
