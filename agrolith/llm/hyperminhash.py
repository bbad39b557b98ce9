"""Near-duplicate documents by HyperMinHash: compressed registers give candidates, whole shingle sets confirm them.

A set's shingles are hashed to 64 bits; the highest BUCKET_BITS bits choose one of REGISTERS buckets and the least of the
remaining bits counts there. A register keeps how many zeros that minimum begins with and the MANTISSA bits behind the
first one: 16 bits, of which four registers, one number, are a band. An empty bucket takes the register of another bucket,
drawn by a fixed sequence until one is filled, so that small sets have full bands whose registers still agree as often as
the sets do.

Sets that share a band meet. Of 32 bands of four registers, sets of similarity 0.85 miss all with a chance of about 5e-11.
A meeting pair is screened by a parity signature of its sets, which bounds from below in how many shingles they differ, and
by one bit a register, then by the estimate of its similarity: the share of equal registers less those that agree by chance. Two minima of rates u and v fall into one register's range, which is about 0.7213 /
2 ** MANTISSA of its place, with a chance of 0.7213 / 2 ** MANTISSA * u * v / (u + v) ** 2. The screens by registers leave DOUBT standard
deviations below the asked similarity, taken for the buckets that are filled. What is left is compared on the sets of the
whole texts.

A band is not turned into pairs: every set meets the least one of its band, then components grow by drawn partners, and
what stays open meets in full (components.closed). Documents of equal sets, by 128 bits, are one node before that.

Defined results: null texts and texts without words have an empty set, no links, and themselves as component; texts
with fewer words than the shingle length have the whole sequence as one shingle; rows with a null doc_id take part and
get the smallest doc_id of their class, if any; a row is kept if its doc_id is its component, rows of a class without any
doc_id never; repeated rows are one node and share its result; ties cannot occur, since the test is on integers; an empty
table gives no rows; very long texts are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, small_batches, steady, stored, tidy
from .components import closed, connected_components, near_pairs
from .jaccard_join import SIGNS, parity, possible, set_value, shingles, signed, verified, word_names

WORDS, PERCENT = 5, 85
BUCKET_BITS, MANTISSA, BAND = 7, 10, 4
REGISTERS = 1 << BUCKET_BITS
BANDS = REGISTERS // BAND
#: Standard deviations that a screen leaves below the asked similarity.
DOUBT = 6.0
#: The most that may be missed: similarities from 0.78 on.
MISSED = 1e-6
ROWS = 500
EMPTY = 0xFFFF
SETS = "row bigint, doc_id bigint, n bigint, s1 bigint, s2 bigint, filled int, bits array<bigint>, bands array<bigint>"


def borrowed(step: int, registers: np.ndarray) -> np.ndarray:
    """Which bucket an empty one looks at in a step; after REGISTERS steps all have been looked at."""
    if step >= REGISTERS:
        return (registers + step) % REGISTERS
    mixed = (registers.astype(np.uint64) * np.uint64(REGISTERS) + np.uint64(step + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def compressed(minima: np.ndarray) -> np.ndarray:
    """Registers of minima that stand in the highest bits: leading zeros, then the bits behind the first one."""
    mantissa, exponent = np.frexp(np.maximum(minima, np.uint64(1)).astype(float))
    zeros = np.minimum(64 - exponent, 62).astype(np.uint16)
    behind = np.minimum((mantissa * 2 - 1) * (1 << MANTISSA), (1 << MANTISSA) - 1).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA)) | behind


EDGES = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(registers, filled): a row of REGISTERS a set, and how many buckets were filled. Sets are sorted and not empty."""
    minima, has = np.zeros((len(sets), REGISTERS), np.uint64), np.zeros((len(sets), REGISTERS), bool)
    for at, own in enumerate(sets):
        firsts = np.searchsorted(own, EDGES)
        ends = np.append(firsts[1:], len(own))
        has[at] = firsts < ends
        minima[at, has[at]] = own[firsts[has[at]]]
    out = compressed(minima << np.uint64(BUCKET_BITS))
    rows, columns = np.nonzero(~has)
    step = 0
    while len(rows):
        source = borrowed(step, columns)
        found = has[rows, source]
        out[rows[found], columns[found]] = out[rows[found], source[found]]
        rows, columns, step = rows[~found], columns[~found], step + 1
    return out, has.sum(axis=1)


def by_chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The chance that registers of different minima agree."""
    return 0.7213 / (1 << MANTISSA) * (n * m) / (n + m).astype(float) ** 2


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal registers."""
    chance = by_chance(n, m)
    return (equal - chance) / (1 - chance)


def least_estimate(filled: np.ndarray, percent: int) -> np.ndarray:
    """What sets of the similarity reach but for DOUBT standard deviations."""
    t = percent / 100
    return t - DOUBT * np.sqrt(t * (1 - t) / np.maximum(filled, 1))


def described(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in SETS.split(", ")]
    for whole in batches:
        for low in range(0, whole.num_rows, ROWS):
            batch = whole.slice(low, ROWS)
            sets = [shingles(word_names(value.as_py()), words) for value in batch.column(2).cast(pa.binary())]
            sums = [tuple(signed(x.sum(dtype=np.uint64)) for x in set_value(own)) for own in sets]
            some = [at for at, own in enumerate(sets) if len(own)]
            registers, filled = sketches([sets[at] for at in some])
            bits = np.packbits((registers & np.uint16(1)).astype(np.uint8), axis=1).view("<i8")
            signs = [parity(sets[at]) for at in some]
            bands = np.ascontiguousarray(registers).astype("<u2").view("<i8")
            held: list[list] = [[None] * len(sets) for _ in range(3)]
            for place, at in enumerate(some):
                held[0][at], held[1][at], held[2][at] = int(filled[place]), np.concatenate([bits[place], signs[place]]), bands[place]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(x) for x in sets], pa.int64()), pa.array([x[0] for x in sums], pa.int64()), pa.array([x[1] for x in sums], pa.int64()),
                pa.array(held[0], pa.int32()), pa.array(held[1], longs), pa.array(held[2], longs),
            ], names)
    tidy()


def screened(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimated similarity doesn't rule them out."""
    own = lambda side: nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("filled").alias(f"f_{side}"), F.col("bands").alias(f"r_{side}"))
    both = pairs.join(own("a"), "a").join(own("b"), "b").select("a", "b", "n_a", "n_b", "f_a", "f_b", "r_a", "r_b")

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, f, g = (batch.column(at).to_numpy() for at in (2, 3, 4, 5))
            one, two = (batch.column(at).flatten().to_numpy().astype("<i8").view("<u2").reshape(-1, REGISTERS) for at in (6, 7))
            close = estimate((one == two).mean(axis=1), n, m) >= least_estimate(np.minimum(f, g), percent)
            yield batch.select([0, 1]).filter(pa.array(close, pa.bool_()))

    return both.mapInArrow(screen, "a bigint, b bigint")


def missed(percent: int) -> float:
    """The chance that sets of the similarity share no band."""
    return (1 - (percent / 100) ** BAND) ** BANDS


class NearDuplicates:
    """documents: one row a document with its node and size. links: enough links between nodes to give all components."""

    def __init__(self, docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> None:
        if missed(percent) > MISSED:
            raise ValueError(f"sets of {percent} % miss all bands too often")
        docs = steady(docs)
        rows = docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
        with small_batches(docs.sparkSession):
            sets = stored(rows.mapInArrow(lambda batches: described(batches, words), SETS), "sketches")
        nodes = stored(sets.where("n > 0").groupBy("s1", "s2").agg(F.min("row").alias("node"), *(F.min(c).alias(c) for c in ("n", "filled", "bits", "bands"))), "nodes")
        self.documents = sets.select("row", "doc_id", "n", "s1", "s2").join(nodes.select("s1", "s2", "node"), ["s1", "s2"], "left").select("row", "doc_id", "n", "node")
        banded = stored(nodes.select(F.col("node").alias("a"), F.posexplode("bands").alias("band", "value")).select(F.xxhash64("band", "value").alias("key"), "a"), "bands")
        # a band's first set, by an aggregate that is combined before it is shuffled; the join's long keys are split
        shared = banded.groupBy("key").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
        lists = stored(banded.join(shared, "key"), "lists")

        own = ["n", "filled", "bits"]

        def near(one, two):
            apart = [F.bit_count(F.get(one("bits"), F.lit(i)).bitwiseXOR(F.get(two("bits"), F.lit(i)))) for i in range(REGISTERS // 64 + SIGNS)]
            differ, signs = (sum(part, F.lit(0)) for part in (apart[: REGISTERS // 64], apart[REGISTERS // 64 :]))
            t, filled = percent / 100, F.least(one("filled"), two("filled"))
            # half of the registers that differ do so in this bit; two deviations in one bound
            most = (1 - t) / 2 + DOUBT * F.sqrt(F.lit(t * (1 - t) / 4) / filled) + DOUBT * F.sqrt(F.lit(1 / 16) / filled)
            bound = signs * (100 + percent) <= (one("n") + two("n")) * (100 - percent)
            return possible(one("n"), two("n"), percent) & bound & (differ <= most * REGISTERS)

        def verify(pairs: DataFrame) -> DataFrame:
            return verified(stored(screened(pairs, nodes, percent), "pairs"), rows, words, percent)

        votes = lists.where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("votes"))
        best = votes.groupBy("a").agg(F.max(F.struct("votes", (-F.col("b")).alias("b"))).alias("best")).select("a", (-F.col("best.b")).alias("b"))
        links = stored(verify(near_pairs(best, nodes, own, near)), "links")
        self.links = closed(lists.select("key", "a"), links, nodes, own, near, verify)

    def classes(self) -> DataFrame:
        """row, doc_id, n_shingles, component_id, kept of every document."""
        members = self.documents.join(connected_components(self.links), "node", "left")
        members = stored(members.withColumn("class", F.when(F.col("n") == 0, -1 - F.col("row")).otherwise(F.coalesce("component", "node"))), "members")
        least = stored(members.groupBy("class").agg(F.min("doc_id").alias("component_id")), "least")
        kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
        return members.join(least, "class").select("row", "doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def op13_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NearDuplicates(read(spark, sf_dir, "documents")).classes().drop("row")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, shingle FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sized AS (SELECT s.doc_id, shingle, n FROM s JOIN n USING (doc_id)),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS common FROM sized a JOIN sized b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY ALL),
link AS (SELECT x, y FROM p WHERE 100 * common >= 85 * (nx + ny - common)),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, y FROM reach JOIN link ON other = x),
c AS (SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.other) AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id)
SELECT *, doc_id = component_id AS kept FROM c
"""
