"""Target-distribution importance resampling: documents are drawn so that their hashed word features look like the
target's.

Texts are read as the bytes that Arrow holds, a batch at once. A lookup table gives each byte its class and lower case;
where the class changes, a word begins or ends, and so at every text's ends. A feature is a run of 1 to GRAMS consecutive words
of a text, joined by one space; its bucket is the CRC-32 of its bytes, modulo BUCKETS. All features' CRCs advance together,
one byte of each a step through the CRC's table, the longest features first, so that those that go on are a prefix. Words
beyond LONG bytes advance by themselves, so one endless word doesn't make as many steps. No text is cut.

Each partition gives its counts by bucket, in slices that are added up: BUCKETS numbers, however large the corpus. A
bucket's gain is the logarithm of its share in the target against its share in the documents, each count plus one, in
thousandths. A document's weight is the mean gain of its features, its score adds Gumbel noise drawn by a hash of seed and doc_id;
the highest scores are a draw without replacement in proportion to exp(weight / 1000). Ranks come from ranges of the score,
not from one sort.

Defined results: a null text has no features, like an empty one, and weight 0; nulls in other columns don't matter; a null
doc_id is drawn by the hash of the seed alone, its ties coming last; ties go to the smaller doc_id, rows of one doc_id to
the earlier row; repeated rows count each; without documents or target texts the counts are 0; very long texts are read
whole; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import numbered
from .common import crc32_sql, read, small_batches, stored, tidy

GRAMS, BUCKETS, SEED = 1, 10_000, 2024
LEAST_WORDS, PERCENT = 20, 10
#: Bytes up to which words advance together, and bytes of texts that are classified together.
LONG, CHUNK = 64, 1 << 20
SLICES = 8


def crc_table() -> np.ndarray:
    """What a byte does to CRC-32, from its reversed polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = crc_table()
BYTES = np.arange(256, dtype=np.uint8)
#: Lower case of A-Z, and whether a byte is part of a word: digits, letters and all bytes of other scripts.
FOLD = np.where((BYTES >= 0x41) & (BYTES <= 0x5A), BYTES + 32, BYTES).astype(np.uint8)
IS_WORD = ((FOLD >= 0x30) & (FOLD <= 0x39)) | ((FOLD >= 0x61) & (FOLD <= 0x7A)) | (FOLD >= 0x80)


def advanced(states: np.ndarray, folded: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CRC states behind the bytes from starts on, sizes many each."""
    out = states.copy()
    order = np.argsort(-np.minimum(sizes, LONG + 1), kind="stable")
    longer = int((sizes > LONG).sum())
    for at in order[:longer]:
        first = starts[at]
        out[at] = zlib.crc32(folded[first : first + sizes[at]], int(out[at]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    order = order[longer:]
    state, place = out[order], starts[order]
    going = np.searchsorted(-sizes[order], -np.arange(LONG + 1), side="left")  # how many have more bytes than a step's number
    for step in range(LONG):
        n = going[step]
        if not n:
            break
        own = state[:n]
        state[:n] = CRC[(own ^ folded[place[:n] + step]) & np.uint32(255)] ^ (own >> np.uint32(8))
    out[order] = state
    return out


def words_of(folded: np.ndarray, is_word: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; none crosses a border between texts."""
    before = np.empty(len(folded), bool)
    before[0], before[1:] = False, is_word[:-1]
    before[borders] = False
    after = np.empty(len(folded), bool)
    after[-1], after[:-1] = False, is_word[1:]
    after[borders[borders > 0] - 1] = False
    return np.flatnonzero(is_word & ~before), np.flatnonzero(is_word & ~after) + 1


def features(texts: pa.Array, grams: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of stretches of the texts, one after the other: each word's text, and each feature's text and bucket."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inner = offsets[:-1][offsets[:-1] < offsets[-1]]
    low = 0
    while low < len(data):
        high = stretch_end(data, inner, low, grams)
        folded = FOLD[data[low:high]]
        borders = inner[np.searchsorted(inner, low) : np.searchsorted(inner, high)] - low
        starts, ends = words_of(folded, IS_WORD[folded], borders)
        sizes, text = ends - starts, np.searchsorted(offsets, starts + low, side="right") - 1
        states = advanced(np.full(len(starts), 0xFFFFFFFF, np.uint32), folded, starts, sizes)
        found, owners = [states], [text]
        for width in range(2, grams + 1):  # a run of one word more: a space and the word behind it
            more = len(starts) - width + 1
            if more < 1:
                break
            spaced = CRC[(states[:more] ^ np.uint32(0x20)) & np.uint32(255)] ^ (states[:more] >> np.uint32(8))
            states = advanced(spaced, folded, starts[width - 1 :], sizes[width - 1 :])
            same = text[:more] == text[width - 1 :]
            found.append(states[same])
            owners.append(text[:more][same])
        crcs = np.concatenate(found) ^ np.uint32(0xFFFFFFFF)
        yield text, np.concatenate(owners), (crcs % np.uint32(buckets)).astype(np.int64)
        low = high


def stretch_end(data: np.ndarray, inner: np.ndarray, low: int, grams: int) -> int:
    """Where the stretch from low on ends: CHUNK bytes on, moved to the end of a text, or, for single words, of a word."""
    high = low + CHUNK
    if high >= len(data):
        return len(data)
    at = np.searchsorted(inner, high)
    border = int(inner[at]) if at < len(inner) else len(data)
    if grams > 1:
        return border  # runs of words don't reach beyond a text
    while high < border:
        gaps = np.flatnonzero(~IS_WORD[data[high : min(high + CHUNK, border)]])
        if len(gaps):
            return high + int(gaps[0])
        high = min(high + CHUNK, border)
    return border


def counted(batches: Iterator[pa.RecordBatch], grams: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, _, found in features(batch.column(0), grams, buckets):
            total += np.bincount(found, minlength=buckets)
    parts = np.array_split(total, SLICES)
    yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], ["slice", "counts"])
    tidy()


def added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for block in batch.column(1).to_pylist():
            own = np.frombuffer(block, np.int64)
            total = own if total is None else total + own
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slice", "counts"])


def bucket_counts(texts: Column, frame: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all the frame's texts by bucket: SLICES rows a partition are added up, SLICES rows come to the driver."""
    schema = "slice int, counts binary"
    parts = frame.select(texts.cast("string").alias("text")).mapInArrow(lambda batches: counted(batches, grams, buckets), schema)
    with small_batches(frame.sparkSession):
        rows = parts.groupBy("slice").applyInArrow(added, schema).collect()
    found = [np.frombuffer(bytes(row["counts"]), np.int64) for row in sorted(rows, key=lambda row: row["slice"])]
    return np.concatenate(found) if found else np.zeros(buckets, np.int64)


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket, in thousandths: how much likelier it is in the target."""
    s, t, k = own.astype(float), target.astype(float), float(len(own))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def weighed(batches: Iterator[pa.RecordBatch], gain: np.ndarray, grams: int) -> Iterator[pa.RecordBatch]:
    """doc_id, words, features and weight of every document."""
    for batch in batches:
        n = batch.num_rows
        words, held, sums = (np.zeros(n, np.int64) for _ in range(3))
        for text, owners, found in features(batch.column(1), grams, len(gain)):
            words += np.bincount(text, minlength=n)
            held += np.bincount(owners, minlength=n)
            if len(owners):
                order = np.argsort(owners, kind="stable") if grams > 1 else slice(None)
                owner, value = owners[order], gain[found[order]]
                firsts = np.flatnonzero(np.diff(owner, prepend=-1))
                sums[owner[firsts]] += np.add.reduceat(value, firsts)
        weight = np.where(held > 0, sums // np.maximum(held, 1), 0)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (words, held, weight))], ["doc_id", "n_words", "n_features", "weight"])
    tidy()


def gumbel(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resampled(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, least: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score of every document, and the rank of those drawn: percent of the documents with at
    least so many words."""
    gain = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(docs["text"], docs, grams, buckets), bucket_counts(target["text"], target, grams, buckets)))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    scored = rows.mapInArrow(lambda batches: weighed(batches, gain.value, grams), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    scored = stored(scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scores")
    numbers = scored.withColumn("row", F.monotonically_increasing_id()).withColumn("fit", F.col("n_words") >= least)
    placed = numbered(numbers, ["fit"], F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc(), name="place", total="of")
    drawn = F.col("fit") & (F.col("place") < F.floor(F.col("of") * percent / 100))
    return placed.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("place") + 1).alias("rank"), "n_words")


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents' rows; doc_id tells rows apart."""
    chosen = resampled(docs, target, **options).where("rank is not null").select("doc_id").distinct()
    return docs.join(chosen, "doc_id", "left_semi")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("n_words")


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {WORDS_SQL} AS w FROM documents), f AS MATERIALIZED (SELECT row, unnest(w) AS word FROM d),
g AS MATERIALIZED (SELECT unnest({WORDS_SQL}) AS word FROM benchmark),
v AS MATERIALIZED (SELECT word, {crc32_sql("word")} % {BUCKETS} AS bucket FROM (SELECT word FROM f UNION SELECT word FROM g)),
s AS (SELECT bucket, count(*) AS s FROM f JOIN v USING (word) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM g JOIN v USING (word) GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM f)::DOUBLE AS sa, (SELECT count(*) FROM g)::DOUBLE AS ta),
k AS MATERIALIZED (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (sa + {BUCKETS}) / ((s + 1) * (ta + {BUCKETS}))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), n),
m AS (SELECT row, sum(gain)::BIGINT AS total, count(*) AS n_features FROM f JOIN v USING (word) JOIN k USING (bucket) GROUP BY 1),
x AS (SELECT row, doc_id, coalesce(n_features, 0) AS n_features, coalesce(CASE WHEN total < 0 THEN -((-total + n_features - 1) // n_features) ELSE total // n_features END, 0) AS weight,
  ('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h FROM d LEFT JOIN m USING (row)),
y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM x),
z AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, row) AS place, count(*) OVER () AS fit FROM y WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * fit // 100 THEN place END AS rank FROM y LEFT JOIN z USING (row)
"""
