"""Size-aware heavy-light Jaccard join of word n-gram sets, and the classes that its links form.

A document's set is a 128-bit value (two sums over its shingles), so documents with equal sets are one node. Distinct
sets are joined by size:

* Small sets enumerate subsets: with at most 17 shingles, two different sets reach 90 % (the default; the sizes follow
  from the similarity) only if one is the other less one shingle, so each set offers its subsets of one shingle fewer
  by value, and an equi-join with the sets of that size finds every link without candidates.
* Large sets scan inverted lists of their rarest shingles: among its n - ceil(t n) + 1 rarest ones a set has one
  that any partner has among its own. Rare is measured by the counts of the shingle's words in a
  fixed-size table of word counts by hashed word: a global order in which common words and passages come last; its
  errors cost time, never links.

The boundary is the size up to which enumerating costs less than scanning lists of the measured mean length.

A list is not turned into pairs. First each set meets the one that most of its lists begin with, screened by size, by a
1024-bit parity signature and by a histogram, which bound the difference from below; verified pairs give components.
While lists hold many pairs of different components, each set then tries a few partners of its lists, drawn by a hash,
and components grow; what stays open meets in full, the sets outside a list's largest component with the others, screened
alike. Pairs within one component are never needed. All are verified on whole shingle sets.

Defined results: null texts and texts without words have an empty set, no links, and themselves as component; texts
with fewer words than the shingle length have the whole sequence as one shingle; rows with a null doc_id take part and
get the smallest doc_id of their class, if any; repeated rows are one node; an empty table gives no rows; very long
texts are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read, steady, stored, tidy, unused
from .components import closed, connected_components, near_pairs, rows_wanted
from .recompression import K1, K2, mix

#: Counters of the table of word counts by hashed word.
COUNTERS = 1 << 18
#: Sets of one list that are compared under one leader; a longer list is dealt to several leaders.
LIST_PART = 1000
SLICES = 32
WORDS, PERCENT = 3, 90
#: Longs of the parity signature: sets of up to about twice as many shingles as bits are told apart by it.
SIGNS = 16
DOC_SCHEMA = "row bigint, doc_id bigint, n bigint, s1 bigint, s2 bigint, " + "".join(f"b{i} bigint, " for i in range(SIGNS)) + "hist binary, slice int, counts binary"


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of a word from which it is named by itself.
LONG_WORD = 512
#: The bits of the first k of eight bytes.
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_names(text: bytes | None) -> np.ndarray:
    """64 bits a word. A-Z are lower-cased; words are [^\\x20\\x09-\\x0D]+. All words of a text advance together, eight
    bytes a step."""
    lowered = (text or b"").lower()
    if not lowered:
        return np.empty(0, np.uint64)
    edges = np.ones(len(lowered) + 2, bool)
    np.take(SPACE, np.frombuffer(lowered, np.uint8), out=edges[1:-1], mode="clip")
    edges = np.flatnonzero(edges[1:] != edges[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray((len(lowered) + 1,), "<u8", lowered + bytes(8), 0, (1,))
    names = mix((eight[starts] & FIRST_BYTES[np.minimum(sizes, 8)]) + sizes.astype(np.uint64) * K1)
    for at in np.flatnonzero(sizes > LONG_WORD).tolist():
        names[at] = xxhash.xxh3_64_intdigest(lowered[starts[at] : starts[at] + sizes[at]])
    sizes[sizes > LONG_WORD] = 0
    own = np.flatnonzero(sizes > 8)
    while len(own):
        starts, sizes = starts[sizes > 8] + 8, sizes[sizes > 8] - 8
        names[own] = mix(names[own] * K1 + (eight[starts] & FIRST_BYTES[np.minimum(sizes, 8)]))
        own = own[sizes > 8]
    return names


def in_order(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def shingles(names: np.ndarray, words: int, counts: np.ndarray | None = None, logs: np.ndarray | None = None):
    """The distinct shingles' 64-bit names, in order; with counts, and the logarithms of one more than each, also how often
    each is to be expected (as the logarithm of its words' counters) and the least counter of its words."""
    if not len(names):
        return (names, np.empty(0), np.empty(0)) if counts is not None else names
    width = min(words, len(names))
    stop = len(names) - width + 1
    out = mix(names[:stop] + np.uint64(width))
    for at in range(1, width):
        out = mix(out * K1 + names[at : stop + at])
    if counts is None:
        return in_order(out)
    order = np.argsort(out)
    out = out[order]
    fresh = np.append(True, out[1:] != out[:-1])
    out, first = out[fresh], order[fresh]
    counter = (names % np.uint64(COUNTERS)).astype(np.int64)
    own, logs = counts[counter], (np.log(counts + 1.0) if logs is None else logs)[counter]
    expected, least = logs[:stop].copy(), own[:stop].copy()
    for at in range(1, width):
        expected += logs[at : stop + at]
        np.minimum(least, own[at : stop + at], out=least)
    return out, expected[first], least[first]


def set_value(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Addends of the two sums; a subset's value is the sum less what is left out."""
    return mix(names + K2), mix(names ^ K1)


def signed(x) -> int:
    x = int(x)
    return x - (1 << 64) if x >= 1 << 63 else x


def parity(names: np.ndarray) -> np.ndarray:
    """64 * SIGNS bits, each the parity of the shingles dealt to it: two sets differ in at least as many shingles as bits."""
    odd = np.bincount((names & np.uint64(64 * SIGNS - 1)).astype(np.int64), minlength=64 * SIGNS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def histogram(names: np.ndarray) -> bytes:
    """Counts by 256 buckets, at most 255 each: two sets differ in at least as many shingles as their counts do."""
    counts = np.bincount(((names >> np.uint64(16)) & np.uint64(255)).astype(np.int64), minlength=256)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def needed(n: int, percent: int) -> int:
    """The least overlap of a set of n with a partner."""
    return (percent * n + 99) // 100


def small_sizes(percent: int) -> range:
    """Sizes of sets that have different partners and whose partners of their size or more differ by one shingle:
    n / (n + 1) reaches the similarity, n / (n + 2) doesn't. At 90 % 9 to 17, at 80 % 4 to 7."""
    least = -(-percent // (100 - percent))
    return range(least, -(-2 * percent // (100 - percent)))


def describe(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """One row a document; after the last, the partition's counts by hashed word, cut in slices."""
    counts = np.zeros(COUNTERS, np.int64)
    names = [part.split()[0] for part in DOC_SCHEMA.split(", ")]
    for batch in batches:
        rows: list[list] = [[] for _ in range(3 + SIGNS)]
        hists: list[bytes] = []
        for value in batch.column(2).cast(pa.binary()):
            text = value.as_py()
            names_of = word_names(text)
            own = shingles(names_of, words)
            first, second = set_value(own)
            bits = parity(own)
            hists.append(histogram(own))
            np.add.at(counts, (names_of % np.uint64(COUNTERS)).astype(np.int64), 1)
            for column, value in zip(rows, [len(own), signed(first.sum(dtype=np.uint64)), signed(second.sum(dtype=np.uint64)), *bits.tolist()], strict=True):
                column.append(value)
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in rows), pa.array(hists, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
    tidy()
    parts = np.array_split(counts.astype("<u4"), SLICES)
    none = [pa.nulls(SLICES, pa.int64())] * (5 + SIGNS)
    yield pa.RecordBatch.from_arrays([*none, pa.nulls(SLICES, pa.binary()), pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names)


def add_slices(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: np.ndarray | None = None
    for batch in batches:
        for block in batch.column(1).to_pylist():
            own = np.frombuffer(block, "<u4").astype(np.int64)
            total = own if total is None else total + own
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slice", "counts"])


def boundary(counts: np.ndarray, percent: int) -> int:
    """The largest size for which n + 1 subset keys cost less than the scan of its lists; one below the small sizes if
    there is none. The mean list that a word meets is F2 / F1; F2 is the sum of squared counters less what chance adds
    to it.
    """
    sizes, f1 = small_sizes(percent), float(counts.sum())
    if not f1:
        return sizes.start - 1
    f2 = max(float((counts.astype(float) ** 2).sum()) - f1 * f1 / len(counts), f1)
    cheaper = [n for n in sizes if n + 1 <= (n - needed(n, percent) + 1) * (1 + f2 / f1)]
    return max(cheaper, default=sizes.start - 1)


KEY_SCHEMA = "kind int, key bigint, key2 bigint, s1 bigint, s2 bigint, parts int"
SUBSET, LIST = 0, 1


def keys_of(batches: Iterator[pa.RecordBatch], words: int, percent: int, counts: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """SUBSET: a subset's value (key, key2) and the set. LIST: a shingle (key), the part of its list that the set is
    dealt to (key2), and the set. A shingle whose words are all very frequent may have a long list, which is dealt to
    parts, by the count of its rarest word."""
    names = [part.split()[0] for part in KEY_SCHEMA.split(", ")]
    seen: set[tuple[int, int]] = set()
    common, least = 4 * counts.mean(), small_sizes(percent).start
    logs = np.log(counts + 1.0)
    columns: list[list[np.ndarray]] = [[] for _ in names]
    held = 0

    def put(*values: np.ndarray) -> int:
        for column, value in zip(columns, values, strict=True):
            column.append(value)
        return len(values[0])

    def out() -> pa.RecordBatch:
        kind, *longs, parts = (np.concatenate(column) for column in columns)
        for column in columns:
            column.clear()
        return pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), *(pa.array(x.view(np.int64)) for x in longs), pa.array(parts.astype(np.int32))], names)

    for batch in batches:
        for value in batch.column(0).cast(pa.binary()):
            text = value.as_py()
            own, expected, rarest = shingles(word_names(text), words, counts, logs)
            n = len(own)
            if n < least:  # linked with equal sets only
                continue
            a, b = set_value(own)
            s1, s2 = a.sum(dtype=np.uint64), b.sum(dtype=np.uint64)
            if (int(s1), int(s2)) in seen:
                continue
            if len(seen) > 100_000:
                seen.clear()
            seen.add((int(s1), int(s2)))
            if least < n <= limit + 1:
                held += put(np.full(n, SUBSET), s1 - a, s2 - b, np.full(n, s1), np.full(n, s2), np.ones(n, np.int64))
            if n > limit:
                order = np.argsort(expected, kind="stable")[: n - needed(n, percent) + 1]  # of equal ones the least name
                rare, parts = own[order], 1 + np.maximum(rarest[order] - common, 0).astype(np.int64) // LIST_PART
                k = len(rare)
                held += put(np.full(k, LIST), rare, s1 % parts.astype(np.uint64), np.full(k, s1), np.full(k, s2), parts)
            if held >= 200_000:
                yield out()
                held = 0
    if held:
        yield out()
    tidy()


def overlap_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(a) + len(b) - len(in_order(np.concatenate([a, b])))
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(pairs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the similarity; only their documents' texts are read again, and
    travel as texts, which compress better than sets."""
    wanted = pairs.select(F.col("a").alias("row")).union(pairs.select(F.col("b").alias("row"))).distinct()
    texts = rows_wanted(rows, wanted).select(F.col("row").alias("node"), "text")
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (batch.column(at).cast(pa.binary()) for at in (2, 3))
            good = [overlap_at_least(shingles(word_names(x.as_py()), words), shingles(word_names(y.as_py()), words), percent) for x, y in zip(one, two, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))
        tidy()

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a bigint, b bigint")


def sifted(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the histograms of their sets allow, which tells long sets apart."""
    both = pairs.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("hist").alias("h_a")), "a")
    both = both.join(nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("hist").alias("h_b")), "b")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(at).to_pylist()), np.uint8).reshape(-1, 256).astype(np.int16) for at in (2, 3))
            differ = np.abs(one - two).sum(axis=1)
            sizes = batch.column(4).to_numpy() + batch.column(5).to_numpy()
            yield batch.select([0, 1]).filter(pa.array(differ * (100 + percent) <= sizes * (100 - percent), pa.bool_()))

    return both.select("a", "b", "h_a", "h_b", "n_a", "n_b").mapInArrow(sift, "a bigint, b bigint")


def possible(n, m, percent: int):
    """The larger set cannot hold the smaller one often enough otherwise."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


class Joined:
    """documents: one row a document with its node. links: links between nodes, enough to give all components."""

    def __init__(self, documents: DataFrame, links: DataFrame) -> None:
        self.documents, self.links = documents, links


def similarity_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> Joined:
    spark, docs = docs.sparkSession, steady(docs)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    described = stored(rows.mapInArrow(lambda batches: describe(batches, words), DOC_SCHEMA), "sets")
    added = described.where("slice is not null").select("slice", "counts").groupBy("slice").applyInArrow(add_slices, "slice int, counts binary").collect()
    counts = np.concatenate([np.frombuffer(bytes(x[1]), np.int64) for x in sorted(added, key=lambda x: x[0])]) if added else np.zeros(COUNTERS, np.int64)
    limit = boundary(counts, percent)
    table = spark.sparkContext.broadcast(counts)

    documents = described.where("slice is null").drop("slice", "counts")
    nodes = stored(documents.groupBy("s1", "s2").agg(F.min("row").alias("node"), F.min("n").alias("n"), F.min("hist").alias("hist"), *(F.min(f"b{i}").alias(f"b{i}") for i in range(SIGNS))), "nodes")

    keys = docs.select(docs["text"].alias("text")).mapInArrow(lambda batches: keys_of(batches, words, percent, table.value, limit), KEY_SCHEMA)
    # one exchange: the rows of a list's part meet, and each subset key passes through under a place of its own
    place = F.when(F.col("kind") == LIST, F.xxhash64("key", "key2")).otherwise(F.xxhash64("key", "key2", "s1", "s2"))
    by_part = W.partitionBy("place", "kind", "key", "key2").orderBy("s1", "s2")
    shared = stored(
        keys.withColumn("place", place)
        .withColumn("l1", F.first("s1").over(by_part))
        .withColumn("l2", F.first("s2").over(by_part))
        .withColumn("before", F.lag("s1").over(by_part))
        .withColumn("after", F.lead("s1").over(by_part))
        .where((F.col("kind") == SUBSET) | (F.col("parts") > 1) | F.col("before").isNotNull() | F.col("after").isNotNull())
        .select("kind", "key", "key2", "s1", "s2", "l1", "l2", "parts"),
        "keys",
    )
    named = nodes.select("s1", "s2", "node")
    subsets = shared.where(F.col("kind") == SUBSET).select("key", "key2", "s1", "s2").distinct()
    whole = nodes.where(F.col("n").between(small_sizes(percent).start, limit)).select(F.col("s1").alias("key"), F.col("s2").alias("key2"), F.col("node").alias("b"))
    small_links = subsets.join(whole, ["key", "key2"]).join(named, ["s1", "s2"]).select(F.col("node").alias("a"), "b")

    lists = shared.where(F.col("kind") == LIST).drop("kind", "key2").distinct()
    # the leaders of a list's parts meet the first of them: as many rows as parts
    by_list = W.partitionBy("key").orderBy("s1", "s2")
    heads = lists.where((F.col("parts") > 1) & (F.col("s1") == F.col("l1")) & (F.col("s2") == F.col("l2")))
    heads = heads.withColumn("l1", F.first("s1").over(by_list)).withColumn("l2", F.first("s2").over(by_list))
    lists = lists.unionByName(heads).drop("parts")
    lists = lists.join(named.withColumnRenamed("node", "a"), ["s1", "s2"])
    lists = lists.join(named.select(F.col("s1").alias("l1"), F.col("s2").alias("l2"), F.col("node").alias("b")), ["l1", "l2"])
    lists = stored(lists.select("key", "a", "b"), "lists")

    def near(one, two):
        differ = sum((F.bit_count(one(f"b{i}").bitwiseXOR(two(f"b{i}"))) for i in range(SIGNS)), F.lit(0))
        # of n + m shingles, sets with d in one of them only share (n + m - d) / 2: d is (1 - t) / (1 + t) of n + m at most
        return (differ * (100 + percent) <= (one("n") + two("n")) * (100 - percent)) & possible(one("n"), two("n"), percent)

    own = ["n", *(f"b{i}" for i in range(SIGNS))]
    votes = lists.where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("a").agg(F.max(F.struct("votes", (-F.col("b")).alias("b"))).alias("best")).select("a", (-F.col("best.b")).alias("b"))

    def verify(pairs: DataFrame) -> DataFrame:
        return verified(stored(sifted(pairs, nodes, percent), "pairs"), rows, words, percent)

    links = stored(small_links.unionByName(verify(near_pairs(best, nodes, own, near))), "links")
    links = closed(lists.select("key", "a").distinct(), links, nodes, own, near, verify)
    return Joined(documents.join(named, ["s1", "s2"]), links)


def members_of(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """row, doc_id, n, class for every row of docs; a row without shingles is a class of its own."""
    joined = similarity_join(docs, words, percent)
    members = joined.documents.join(connected_components(joined.links), "node", "left")
    # as a table, it is read by aggregates and joins as plain exchanges, which adaptive execution splits
    return stored(members.select("row", "doc_id", "n", F.when(F.col("n") == 0, -1 - F.col("row")).otherwise(F.coalesce("component", "node")).alias("class")), "members")


def classes_of(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """row, doc_id, n_shingles, component_id for every row of docs."""
    members = members_of(docs, words, percent)
    least = stored(members.groupBy("class").agg(F.min("doc_id").alias("component_id")), "least")
    return members.join(least, "class").select("row", "doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each class stays, the one with the smallest doc_id (of equal ones the first row, null last)."""
    docs = steady(docs)
    number = unused("agrolith_row", docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    kept = members_of(docs, words, percent).groupBy("class").agg(first).select(F.col("first.row").alias(number))
    return docs.withColumn(number, F.monotonically_increasing_id()).join(kept, number, "left_semi").drop(number)


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes_of(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, shingle FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS shingle FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sized AS (SELECT s.doc_id, shingle, n FROM s JOIN n USING (doc_id)),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS common FROM sized a JOIN sized b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
link AS (SELECT x, y FROM p WHERE 100 * common >= 90 * (nx + ny - common)),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, y FROM reach JOIN link ON other = x)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.other) AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id
"""
