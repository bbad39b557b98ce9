"""A hidden Markov language model of the words of documents, beside an additive unigram base.

A word's probability in a state factors through its class: P(word | state) = P(class | state) P(word | class). The
class is a hash of the word's first and last letters into `CLASSES` values, so short and frequent words have nearly a
class of their own and unseen words still have one; the model's parameters have a fixed size, whatever the
vocabulary. P(word | class) comes from the counts of all training words, with one unseen word per class, so the
probabilities of a text's words and its end sum to one.

Training is Baum-Welch: a pass over all training texts adds up expected counts in each partition (scaled forward and
backward recursions over many texts at once); the partitions' fixed-size counts are added by a tree of sums, and the
next pass starts from the new parameters. Parameters start from a few passes over `START_DOCS` documents, the first in the
order of a hash of doc_id.
Scoring is the scaled forward recursion, which gives the exact likelihood of the class sequence.

Word counts are joined by hashed keys. A word with at least `HEAVY` of all tokens goes to a table of at most 1 / HEAVY
rows, which every worker holds; the other words have short lists by definition and meet their counts in a join.

Defined results: a null text counts as empty (one token, its end); a null doc_id is passed on and counts as the empty
string for the remainder; repeated rows are scored each; with no training rows every score is that of the additive
model with N = V = 0; an empty table gives no rows; very long texts are read whole; other columns are ignored.
"""

from __future__ import annotations

import contextlib
import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint_dir, read, remainder, stored, tidy

STATES = 6
CLASSES = 1 << 14
PASSES = 3
START_DOCS, START_PASSES = 400, 12
HEAVY = 4e-6
HELD_OUT = (10, 0)
ALPHA = 0.1
#: No token holds white space, so this key is the end's alone.
END = b" "
#: Texts are recursed together up to so many tokens, held for that (as class numbers) up to so many, so that long ones
#: meet others of their length, and counted together up to so many.
TOKENS_AT_ONCE = 600_000
HELD_TOKENS = 5_000_000
COUNT_AT_ONCE = 1_500_000
CACHE = 500_000
SOME_TEXTS = 64


def tokens_of(text: bytes | None) -> list[bytes]:
    """bytes.lower() changes A-Z alone and bytes.split() splits at [\\x20\\x09-\\x0D]+."""
    return (text or b"").lower().split()


LENGTHS = [b"\t%d" % n for n in range(8)]


def word_class(word: bytes) -> int:
    if word.isascii():
        return xxhash.xxh3_64_intdigest(word[:3] + word[-3:] + LENGTHS[min(len(word), 7)]) % CLASSES
    text = word.decode()
    return xxhash.xxh3_64_intdigest(f"{text[:3]}\t{text[-3:]}\t{min(len(text), 7)}".encode()) % CLASSES


def classes_of(words: list[bytes]) -> np.ndarray:
    """The classes of many words (END's too) at once."""
    keys = [word[:3] + word[-3:] + LENGTHS[min(len(word), 7)] if word.isascii() else None for word in words]
    out = np.fromiter((word_class(word) if key is None else xxhash.xxh3_64_intdigest(key) % CLASSES for word, key in zip(words, keys, strict=True)), np.int32, len(words))
    out[[at for at, word in enumerate(words) if word == END]] = CLASSES
    return out


class ClassCache(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        found = self[word] = CLASSES if word == END else word_class(word)
        return found


CLASS_OF = ClassCache()


class Numbers(dict):
    """Words numbered as they come; the classes of all of them are found at once, when texts have been numbered."""

    def __init__(self) -> None:
        self.words, self.classes, self.cleared = [], np.empty(0, np.int32), 0

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self.words)
        self.words.append(word)
        return found

    def of(self, tokenised: list[list[bytes]]) -> list[np.ndarray]:
        """The numbers of each text's words. Earlier ones hold no more once there were CACHE words."""
        if len(self) >= CACHE:
            self.clear()
        numbers = [np.fromiter(map(self.__getitem__, words), np.int32, len(words)) for words in tokenised]
        if len(self.words) > len(self.classes):
            self.classes = np.concatenate([self.classes, classes_of(self.words[len(self.classes) :])])
        return numbers

    def clear(self) -> None:
        super().clear()
        self.words, self.classes, self.cleared = [], np.empty(0, np.int32), self.cleared + 1


NUMBERS = Numbers()


def class_sequences(tokenised: list[list[bytes]]) -> list[np.ndarray]:
    return [np.append(NUMBERS.classes[row], np.int32(CLASSES)) for row in NUMBERS.of(tokenised)]


class Parameters:
    """start (K), move (K x K), emit (classes + end x K), all probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit

    @staticmethod
    def initial(states: int = STATES) -> Parameters:
        noise = np.random.default_rng(7)
        emit = noise.dirichlet(np.full(CLASSES + 1, 5.0), states).T
        move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        return Parameters(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), np.ascontiguousarray(emit))

    @staticmethod
    def estimated(start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Parameters:
        """From expected counts, smoothed so that no class has probability zero in a state."""
        prior = emit.sum(axis=1) + ALPHA
        emit = emit + 20.0 * (prior / prior.sum())[:, None] + 1e-3
        start, move = start + 1e-3, move + 1e-3
        return Parameters(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0, keepdims=True))


def batches_by_length(sequences: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Indices of sequences, longest first, in groups of at most TOKENS_AT_ONCE tokens."""
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    start, total = 0, 0
    for at, index in enumerate(order):
        if total and total + len(sequences[index]) > TOKENS_AT_ONCE:
            yield order[start:at]
            start, total = at, 0
        total += len(sequences[index])
    if start < len(order):
        yield order[start:]


def by_step(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of sequences sorted by falling length, laid out step by step; where each step begins; and whose
    token is where. A step's tokens stand in the order of their sequences, so the longer ones' places stay the same."""
    lengths = np.array([len(s) for s in sequences])
    width = np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left")
    begins = np.concatenate([[0], np.cumsum(width)])
    flat = np.concatenate(sequences)
    within = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    own = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    place = begins[within] + own
    tokens, owners = np.empty(len(flat), np.int32), np.empty(len(flat), np.int32)
    tokens[place], owners[place] = flat, own
    return tokens, begins, owners


def forward(p: Parameters, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Log10 likelihood of each sequence (sorted by falling length); tokens, begins, scaled alphas and scales by step."""
    tokens, begins, owners = by_step(sequences)
    alphas, scales = p.emit[tokens], np.empty(len(tokens))
    ones, moved = np.ones(len(p.start)), np.empty((len(sequences), len(p.start)))
    moved[:] = p.start
    places = begins.tolist()
    for a, b in zip(places, places[1:], strict=False):
        rows, scale = alphas[a:b], scales[a:b]
        np.multiply(rows, moved[: b - a], out=rows)
        np.dot(rows, ones, out=scale)
        np.divide(rows, scale[:, None], out=rows)
        np.dot(rows, p.move, out=moved[: b - a])
    return np.bincount(owners, weights=np.log10(scales), minlength=len(sequences)), tokens, begins, alphas, scales


def expected_counts(p: Parameters, sequences: list[np.ndarray], totals: tuple[np.ndarray, np.ndarray, np.ndarray]) -> float:
    """Adds the sequences' expected counts to totals (start, move, emit); returns their log10 likelihood."""
    start, move, emit = totals
    likelihood = 0.0
    for group in batches_by_length(sequences):
        logs, tokens, begins, alphas, scales = forward(p, [sequences[at] for at in group])
        likelihood += logs.sum()
        betas, weighted = np.empty_like(alphas), p.emit[tokens]
        np.divide(weighted, scales[:, None], out=weighted)
        beta, back = np.ones((len(group), len(p.start))), np.ascontiguousarray(p.move.T)
        places = begins.tolist()
        for step in range(len(places) - 2, -1, -1):
            a, b = places[step], places[step + 1]
            own, rows = beta[: b - a], weighted[a:b]
            betas[a:b] = own
            np.multiply(rows, own, out=rows)
            np.dot(rows, back, out=own)
        later = np.arange(begins[1], len(tokens))
        before = later - np.repeat(begins[1:-1] - begins[:-2], np.diff(begins)[1:])
        move += p.move * (alphas[before].T @ weighted[begins[1] :])
        np.multiply(betas, alphas, out=betas)
        np.divide(betas, betas.sum(axis=1, keepdims=True), out=betas)
        start += betas[: begins[1]].sum(axis=0)
        for state in range(len(p.start)):
            emit[:, state] += np.bincount(tokens, weights=betas[:, state], minlength=CLASSES + 1)
    return likelihood


def blank(states: int = STATES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.zeros(states), np.zeros((states, states)), np.zeros((CLASSES + 1, states))


def training(docs: DataFrame) -> DataFrame:
    return docs.where(remainder(docs["doc_id"], HELD_OUT[0]) != HELD_OUT[1]).select(docs["text"].alias("_text"), docs["doc_id"].cast("long").alias("_doc"))


def sampled_texts(rows: DataFrame, size: int) -> list[bytes | None]:
    """Whole texts of the size doc_ids that come first in the order of a hash (of a repeated one the last in order), so
    another order of rows gives the same. Row counts, which bound what comes to the driver, are at most size."""
    ids = [row[0] for row in rows.select("_doc").where("_doc IS NOT NULL").distinct().orderBy(F.xxhash64("_doc"), "_doc").limit(size).collect()]
    found = rows.where(F.col("_doc").isin(*ids)).groupBy("_doc").agg(F.max("_text").alias("_text")).orderBy(F.xxhash64("_doc"), "_doc").select("_text") if ids else rows.limit(0).select("_text")
    return found.toArrow().column(0).cast(pa.binary()).to_pylist()


def start_parameters(docs: DataFrame, start_docs: int = START_DOCS) -> Parameters:
    """A starting point only: all parameters are re-estimated on all training texts afterwards."""
    texts = [text for text in sampled_texts(training(docs), start_docs) if text]
    p = Parameters.initial()
    sequences = class_sequences([tokens_of(text) for text in texts])
    for _ in range(START_PASSES if sequences else 0):
        totals = blank()
        expected_counts(p, sequences, totals)
        p = Parameters.estimated(*totals)
    return p


def slices_of(column: pa.Array) -> Iterator[list[bytes | None]]:
    """A column's values, SOME_TEXTS at a time, so that few texts' words are held."""
    for at in range(0, len(column), SOME_TEXTS):
        yield column.slice(at, SOME_TEXTS).to_pylist()


def baum_welch(docs: DataFrame, p: Parameters, passes: int = PASSES) -> Parameters:
    """Each pass covers all training texts. The first one also stores their class sequences (two bytes a token), which
    the others read instead of the texts. What a partition sends is one fixed-size block of counts, cut in slices
    that are added up by slice, so neither the shuffle's tasks nor the driver get more with more partitions."""
    states, slices = len(p.start), 64
    names = ["part", "counts"]
    table: DataFrame | None = None
    for _ in range(passes):
        current = p

        def count(batches: Iterator[pa.RecordBatch], p: Parameters = current, first: bool = table is None) -> Iterator[pa.RecordBatch]:
            totals, seen = blank(states), False
            held, size = [], 0
            for batch in batches:
                sequences = []
                for some in slices_of(batch.column(0).cast(pa.binary())):
                    own = class_sequences([tokens_of(value) for value in some]) if first else [np.frombuffer(value, "<u2").astype(np.int32) for value in some]
                    sequences += [row.astype("<u2").tobytes() for row in own] if first else []
                    held += own
                    size += sum(map(len, own))
                    seen = True
                    if size >= HELD_TOKENS:
                        expected_counts(p, held, totals)
                        held, size = [], 0
                if sequences:
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(sequences), pa.int32()), pa.array(sequences, pa.binary())], names)
            if held:
                expected_counts(p, held, totals)
            tidy(NUMBERS)
            if seen:
                vector = np.concatenate([x.ravel() for x in totals]).astype(np.float64)
                parts = np.array_split(vector, slices)
                yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names)

        def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: np.ndarray | None = None
            for batch in batches:
                for block in batch.column(1).to_pylist():
                    total = np.frombuffer(block).copy() if total is None else total + np.frombuffer(block)
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names)

        source = training(docs).select("_text") if table is None else table.where("part IS NULL").select("counts")
        counted = source.mapInArrow(count, "part int, counts binary")
        if table is None:
            table = counted = stored(counted, "classes")
        counted = counted.where("part IS NOT NULL")
        added = counted.groupBy("part").applyInArrow(add, "part int, counts binary").collect()
        if not added:
            break
        vector = np.concatenate([np.frombuffer(bytes(row[1])) for row in sorted(added, key=lambda row: row[0])])
        start, rest = vector[:states], vector[states:]
        p = Parameters.estimated(start, rest[: states * states].reshape(states, states), rest[states * states :].reshape(CLASSES + 1, states))
    return p


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all training texts; END stands for the texts' ends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for value in batch.column(0).cast(pa.binary()):
                words = tokens_of(value.as_py())
                counts.update(words)
                counts[END] += 1
                size += len(words)
                if size >= COUNT_AT_ONCE:
                    yield out()
                    counts.clear()
                    size = 0
        if counts:
            yield out()

    return training(docs).select("_text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Lexical:
    """What P(word | class) and the base need: totals of the corpus and of each class, and the heavy words' counts."""

    def __init__(self, tokens: int, kinds: int, class_tokens: np.ndarray, class_kinds: np.ndarray, heavy: dict[bytes, int]) -> None:
        self.tokens, self.kinds, self.heavy = tokens, kinds, heavy
        self.base = math.log10(tokens + ALPHA * (kinds + 1))
        self.by_class = np.log10(class_tokens + ALPHA * (class_kinds + 1))
        self.light = {}


def lexical(counts: DataFrame) -> Lexical:
    """Totals by class (a fixed number) and the heavy words (at most 1 / HEAVY of them) come to the driver."""

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, kinds = np.zeros(CLASSES + 1, np.int64), np.zeros(CLASSES + 1, np.int64)
        for batch in batches:
            own = classes_of(batch.column(0).to_pylist())
            n = batch.column(1).to_numpy()
            tokens += np.bincount(own, weights=n, minlength=CLASSES + 1).astype(np.int64)
            kinds += np.bincount(own, minlength=CLASSES + 1)
        used = np.flatnonzero(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(tokens[used]), pa.array(kinds[used])], ["class", "tokens", "kinds"])

    rows = counts.mapInArrow(classes, "class bigint, tokens bigint, kinds bigint").groupBy("class").agg(F.sum("tokens"), F.sum("kinds")).collect()
    class_tokens, class_kinds = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for own, tokens, kinds in rows:
        class_tokens[own], class_kinds[own] = tokens, kinds
    total = int(class_tokens.sum())
    heavy = counts.where(F.col("n") >= F.lit(max(1.0, HEAVY * total))).collect() if total else []
    return Lexical(total, int(class_kinds.sum()), class_tokens, class_kinds, {bytes(word): n for word, n in heavy})


def score_documents(docs: DataFrame, p: Parameters, lex: Lexical, counts: DataFrame) -> DataFrame:
    """One row a document, whatever its doc_id. A worker scores classes and heavy words; the light words of a text travel as (word, how
    often) to their counts and come back as sums by row."""
    broadcast = docs.sparkSession.sparkContext.broadcast((p, lex))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, lex = broadcast.value
        log_of = {word: math.log10(n + ALPHA) for word, n in lex.heavy.items()}.get
        end, logs_of = log_of(END, math.nan), np.empty(0)
        ends = [END] if math.isnan(end) else []
        cleared = NUMBERS.cleared - 1
        names = ["key", "n", "row", "n_tokens", "known", "sum", "model", "doc"]
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            sequences, keys, times, lights = [], [], [], np.zeros(len(texts), np.int64)
            known, sums, model = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts))
            at = -1
            for some in slices_of(texts):
                numbered, words = NUMBERS.of([tokens_of(text) for text in some]), NUMBERS.words
                if NUMBERS.cleared != cleared:
                    logs_of, cleared = np.empty(0), NUMBERS.cleared
                fresh = words[len(logs_of) :]
                logs_of = np.append(logs_of, np.fromiter(map(log_of, fresh, itertools.repeat(math.nan)), np.float64, len(fresh)))
                for at, row in enumerate(numbered, at + 1):
                    sequences.append(np.append(NUMBERS.classes[row], np.int32(CLASSES)))
                    own, often = np.unique(row, return_counts=True)
                    logs = logs_of[own]
                    light = np.isnan(logs)
                    keys += map(words.__getitem__, own[light].tolist())
                    keys += ends
                    times += [often[light], np.ones(len(ends), np.int64)]
                    lights[at] = light.sum() + len(ends)
                    known[at], sums[at] = often[~light].sum() + 1 - len(ends), logs[~light] @ often[~light] + (0.0 if ends else end)
            times, owners = np.concatenate(times) if times else np.empty(0, np.int64), np.repeat(np.array(ids, np.int64), lights)
            for group in batches_by_length(sequences):
                model[group] = forward(p, [sequences[at] for at in group])[0]
            model -= np.array([lex.by_class[sequence].sum() for sequence in sequences])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(times, pa.int64()), pa.array(owners, pa.int64()), *(pa.nulls(len(keys), t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()))], names)
            row_keys = [b" row" + i.to_bytes(8, "little") for i in ids]  # no word holds a space: these join with nothing
            yield pa.RecordBatch.from_arrays([pa.array(row_keys, pa.binary()), pa.array([0] * len(ids), pa.int64()), pa.array(ids, pa.int64()), pa.array([len(s) for s in sequences], pa.int64()), pa.array(known), pa.array(sums), pa.array(model), batch.column(2)], names)

    numbered = docs.select(docs["doc_id"].cast("long").alias("_doc"), docs["text"].alias("_text"), F.monotonically_increasing_id().alias("_row"))
    scored = numbered.select("_row", "_text", "_doc").mapInArrow(score, "key binary, n bigint, row bigint, n_tokens bigint, known bigint, sum double, model double, doc bigint")
    light = counts.where(F.col("n") < F.lit(max(1.0, HEAVY * lex.tokens))).select(F.col("word").alias("key"), F.col("n").alias("c"))
    joined = scored.join(light, "key", "left")
    unseen = F.lit(ALPHA)
    return joined.groupBy("row").agg(
        F.max("doc").alias("doc_id"),
        F.max("n_tokens").alias("n_tokens"),
        (F.sum("known") + F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0))).alias("n_known"),
        (F.sum("sum") + F.sum(F.col("n") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + unseen))).alias("words"),
        F.max("model").alias("model"),
    )


HASHED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


@contextlib.contextmanager
def hashed_where_small(spark: SparkSession) -> Iterator[None]:
    """Meanwhile adaptive execution joins by hash where every partition of one side is seen to have at most 64 MB, which
    spares the sort of the other one; beyond that it sorts and merges, which can spill."""
    before = spark.conf.get(HASHED, None)
    spark.conf.set(HASHED, "64m")
    try:
        yield
    finally:
        spark.conf.unset(HASHED) if before is None else spark.conf.set(HASHED, before)


def language_model(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, score_per_token for every row of docs."""
    checkpoint_dir(docs.sparkSession)
    counts = word_counts(docs).checkpoint()
    lex = lexical(counts)
    p = baum_welch(docs, start_parameters(docs))
    with hashed_where_small(docs.sparkSession):
        scored = stored(score_documents(docs, p, lex, counts), "scores")
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(lex.tokens).cast("long").alias("train_tokens"),
        (F.col("words") - F.col("n_tokens") * F.lit(lex.base)).alias("base_score"),
        (F.col("words") + F.col("model")).alias("score"),
        ((F.col("words") + F.col("model")) / F.col("n_tokens")).alias("score_per_token"),
    )


def op1_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model(read(spark, sf_dir, "documents"))
