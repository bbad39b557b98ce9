"""Toxicity by a weighted finite-state grammar over clauses.

A document's clauses become strings of token classes (insult, threat, target, negation, reported speech, other). Four
small transducers rewrite them: reported speech turns later insults of the clause into quoted ones, negation mutes the
insults close behind it, a target close by makes an insult or threat an aimed one, and the last gives every rewritten
class its weight. They are composed into one machine, which reads a clause once. Only clauses that hold a word of the
lexicon are read, since the others add nothing.

The insult lexicon (words, and beginnings of words for languages that compound) is chosen greedily from at most
`SAMPLE_LABELS` labelled rows whose remainder is not the held-out one; the weights of the last transducer are fitted on
the same rows by logistic regression. Closed-class words (targets, negations, verbs of speech, threats) are given.

Defined results: a null or empty text has the score of a text without matches; a null doc_id is passed on and counts
as not held out unless the remainder of the empty string says so; rows repeat as they come in; empty tables give no
rows, and without usable labels the lexicon is empty and every score next to 0; very long texts are read whole in linear
time; other columns, clashing names included, are ignored.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, remainder, tidy

SAMPLE_LABELS = 12_000
HELD_OUT = (4, 2)
THRESHOLD = 0.3
LEXICON = 256
#: Words whose patterns are kept at hand while the lexicon is learnt.
MEMO_WORDS = 50_000
PREFIXES = range(3, 9)
#: A pattern enters the lexicon for at least this log-likelihood ratio.
LEAST_GAIN = 12.0

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTED, MUTED, AIMED, AIMED_THREAT = range(10)
CLASSES = 10
MATCHED = (INSULT, THREAT, QUOTED, MUTED, AIMED, AIMED_THREAT)
#: Closed-class words of English, German, French and Spanish.
WORDS = {
    TARGET: "you your yours yourself u du dich dir euch ihr dein deine tu toi te vous votre ton tú ti usted ustedes vosotros",
    NEGATION: "not never no isn't aren't wasn't nicht nie kein keine niemals pas jamais aucun aucune nunca jamás ningún ninguna",
    REPORT: "said says wrote called quoted reported claims sagte sagt schrieb nannte berichtet disait écrit appelé rapporté dijo dice escribió llamó informó",
    THREAT: "kill hurt destroy töten umbringen vernichten tuer frapper détruire matar golpear destruir",
}
CLOSED = {word: kind for kind, words in WORDS.items() for word in words.split()}
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.!?;:\n|]")
#: A verb of speech and the colon that opens what is said, with up to three words between.
SPEECH = re.compile(rf"(?<![^\W\d_])(?:{'|'.join(WORDS[REPORT].split())})(?:[ \t]+[^\W\d_]+){{0,3}}[ \t]*:")


def lowered(text: str | None) -> str:
    """Lower case, with one kind of apostrophe."""
    return (text or "").lower().replace("\u2019", "'")


def opened(text: str) -> str:
    """A colon behind a verb of speech as a comma, so that the clause goes on into what is said."""
    return SPEECH.sub(lambda match: match[0][:-1] + ",", text) if ":" in text else text


class Transducer:
    """Deterministic: step[state, class] -> (state, class out); weight[state, class] is added."""

    def __init__(self, states: int) -> None:
        self.next = np.zeros((states, CLASSES), dtype=np.int64)
        self.out = np.tile(np.arange(CLASSES), (states, 1))
        self.weight = np.zeros((states, CLASSES))

    def arc(self, state: int, kind: int, to: int, out: int | None = None, weight: float = 0.0) -> None:
        self.next[state, kind], self.weight[state, kind] = to, weight
        self.out[state, kind] = kind if out is None else out

    def compose(self, other: Transducer) -> Transducer:
        """The machine that feeds this one's output to the other."""
        width = len(other.next)
        joint = Transducer(len(self.next) * width)
        for a in range(len(self.next)):
            for b in range(width):
                for kind in range(CLASSES):
                    middle = self.out[a, kind]
                    joint.arc(a * width + b, kind, self.next[a, kind] * width + other.next[b, middle], other.out[b, middle], self.weight[a, kind] + other.weight[b, middle])
        return joint


def within(trigger: int, reach: int, rewrites: dict[int, int], keeps: bool = False) -> Transducer:
    """Rewrites classes up to reach tokens behind a trigger (to the clause's end if keeps)."""
    machine = Transducer(reach + 1)
    for state in range(reach + 1):
        for kind in range(CLASSES):
            later = state if keeps else max(state - 1, 0)
            machine.arc(state, kind, reach if kind == trigger else later, rewrites.get(kind, kind) if state else kind)
    return machine


def scorer(weights: dict[int, float]) -> Transducer:
    machine = Transducer(1)
    for kind in range(CLASSES):
        machine.arc(0, kind, 0, kind, weights.get(kind, 0.0))
    return machine


def grammar(weights: dict[int, float]) -> Transducer:
    reported = within(REPORT, 1, {INSULT: QUOTED, THREAT: QUOTED}, keeps=True)
    negated = within(NEGATION, 3, {INSULT: MUTED, THREAT: MUTED})
    aimed = within(TARGET, 3, {INSULT: AIMED, THREAT: AIMED_THREAT})
    return reported.compose(negated).compose(aimed).compose(scorer(weights))


def clauses(text: str, hits: re.Pattern) -> Iterator[str]:
    """The clauses of a lower-case text in which the lexicon has a word, each once."""
    end = 0
    for match in hits.finditer(text):
        if match.start() < end:
            continue
        start = end
        for mark in ".!?;:\n|":
            start = max(start, text.rfind(mark, end, match.start()) + 1)
        stop = CLAUSE_END.search(text, match.end())
        end = stop.start() if stop else len(text)
        yield text[start:end]


class Model:
    def __init__(self, words: dict[str, float], prefixes: dict[str, float], weights: dict[int, float], bias: float, top: float) -> None:
        self.words, self.prefixes, self.bias, self.top = words, prefixes, bias, top
        self.lengths = sorted({len(p) for p in prefixes}, reverse=True)
        exact = [*words, *(word for word, kind in CLOSED.items() if kind == THREAT)]
        parts = [rf"(?:{'|'.join(map(re.escape, sorted(exact)))})(?![^\W\d_])"] if exact else []
        parts += [rf"(?:{'|'.join(map(re.escape, sorted(prefixes)))})"] if prefixes else []
        self.hits = re.compile(rf"(?<![^\W\d_])(?:{'|'.join(parts)})")
        self.machine = grammar(weights)

    def strength(self, word: str) -> float:
        """The lexicon's weight of a word, 0 if it has none."""
        found = self.words.get(word, 0.0)
        for length in self.lengths:
            if len(word) >= length:
                found = max(found, self.prefixes.get(word[:length], 0.0))
        return found

    def read(self, clause: str) -> tuple[Counter, float, float]:
        """Matches by rewritten class, the clause's weight and its strongest word."""
        state, total, strongest, matches = 0, 0.0, 0.0, Counter()
        machine = self.machine
        for word in WORD.findall(clause):
            strength = self.strength(word)
            kind = INSULT if strength else CLOSED.get(word, OTHER)
            out = machine.out[state, kind]
            total += machine.weight[state, kind]
            state = machine.next[state, kind]
            if out in MATCHED:
                matches[int(out)] += 1
                strongest = max(strongest, strength)
        return matches, total, strongest

    def ranked(self, text: str | None) -> list[tuple[Counter, float, float]]:
        """What read() gives for each matched clause, clauses with most matches first, equal ones in order of the text."""
        lower = lowered(text)
        if not self.hits.search(lower):
            return []
        found = [self.read(clause) for clause in clauses(opened(lower), self.hits)]
        return sorted(found, key=lambda own: -own[0].total())

    def describe(self, text: str | None) -> np.ndarray:
        """Features of a text: matches by class, each clause's with half the weight of the one ranked before it, so that
        length alone doesn't tell; and the strongest word."""
        out = np.zeros(len(MATCHED) + 1)
        for rank, (matches, _, strongest) in enumerate(self.ranked(text)):
            out[:-1] += 0.5**rank * np.array([matches[kind] for kind in MATCHED])
            out[-1] = max(out[-1], strongest)
        return out

    def score(self, text: str | None) -> float:
        """The fitted function: arc weights are the weights of the classes, so the clauses' weights, halved by rank, add
        up to the features' weighted sum."""
        total, strongest = 0.0, 0.0
        for rank, (_, weight, word) in enumerate(self.ranked(text)):
            total += 0.5**rank * weight
            strongest = max(strongest, word)
        logit = self.bias + self.top * strongest + total
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def learn_lexicon(texts: list[str], toxic: np.ndarray) -> tuple[dict[str, float], dict[str, float]]:
    """Words ("=word") and beginnings ("word") picked one by one: each time the one that tells the most about the toxic
    texts not covered so far. One text of those that begin alike counts, so copies don't speak for their words. Then the
    words that clean texts all but lack, since a text may hold one of them alone."""
    first: dict[tuple, int] = {}
    for at, text in enumerate(texts):
        first.setdefault((bool(toxic[at]), *lowered(text).split(None, 6)[:6]), at)
    texts, toxic = [texts[at] for at in first.values()], toxic[[*first.values()]]

    def keys(word: str) -> list[str]:
        return [f"={word}", *(word[:n] for n in PREFIXES if n <= len(word))]

    support: dict[str, list[int]] = defaultdict(list)
    positives = np.flatnonzero(toxic)
    # most patterns are rare: a first pass counts hashed patterns, so that the second one stores few of those
    counted, mask = np.zeros(1 << 20, np.int32), (1 << 20) - 1
    for at in positives:
        own_keys = {key for word in set(WORD.findall(lowered(texts[at]))) for key in keys(word)}
        counted[np.unique(np.array([hash(key) & mask for key in own_keys], np.int64))] += 1
    for at in positives:
        for key in {key for word in set(WORD.findall(lowered(texts[at]))) for key in keys(word)}:
            if counted[hash(key) & mask] >= 4:
                support[key].append(int(at))
    support = {key: rows for key, rows in support.items() if len(rows) >= 4}
    against: Counter = Counter()
    clean = np.flatnonzero(~toxic)
    wanted: dict[str, list[str]] = {}
    for at in clean:
        own: set[str] = set()
        for word in set(WORD.findall(lowered(texts[at]))):
            hit = wanted.get(word)
            if hit is None:
                if len(wanted) >= MEMO_WORDS:
                    wanted.clear()
                hit = wanted[word] = [key for key in keys(word) if key in support]
            own.update(hit)
        against.update(own)
    share = len(positives) / max(len(texts), 1)
    odds = share / (1 - share)

    def gain(covered: int, against: int) -> float:
        """Log-likelihood ratio of the rule's own rate of toxic texts against the rate overall; 0 below that."""
        rate = covered / (covered + against)
        return covered * math.log(rate / share) + (against and against * math.log((1 - rate) / (1 - share))) if rate > share else 0.0

    words, prefixes = {}, {}
    alive = {k: (gain(len(rows), against[k]), set(rows)) for k, rows in support.items() if len(rows) > 2 * odds * against[k]}
    alive = {k: v for k, v in alive.items() if v[0] >= LEAST_GAIN}
    while alive and len(words) + len(prefixes) < LEXICON:
        key = max(alive, key=lambda k: (alive[k][0], k.startswith("="), len(k), k))
        rows = alive.pop(key)[1]
        weight = math.log((len(support[key]) + 0.5) / (odds * against[key] + 0.5))
        (words if key.startswith("=") else prefixes)[key.removeprefix("=")] = weight
        alive = {k: (gain(len(left), against[k]), left) for k, (_, old) in alive.items() if (left := old - rows)}
        alive = {k: v for k, v in alive.items() if v[0] >= LEAST_GAIN}
    sure = [k for k, rows in support.items() if k.startswith("=") and len(rows) >= max(8, 0.02 * len(positives), 20 * odds * against[k])]
    for key in sorted(sure, key=lambda k: (-len(support[k]), k))[: LEXICON - len(words) - len(prefixes)]:
        words.setdefault(key[1:], math.log((len(support[key]) + 0.5) / (odds * against[key] + 0.5)))
    return words, prefixes


def fit(texts: list[str], toxic: list[int], steps: int = 50, ridge: float = 1e-3) -> Model:
    if not texts:
        return Model({}, {}, {}, -30.0, 0.0)
    labels = np.array(toxic, dtype=bool)
    words, prefixes = learn_lexicon(texts, labels) if labels.any() and (~labels).any() else ({}, {})
    blank = Model(words, prefixes, {}, 0.0, 0.0)
    x = np.array([blank.describe(text) for text in texts]).reshape(len(texts), len(MATCHED) + 1)
    x = np.hstack([x, np.ones((len(x), 1))])
    y, all_weights = labels.astype(float), np.zeros(x.shape[1])
    penalty = np.diag([ridge * max(len(x), 1)] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):  # Newton
        p = 1 / (1 + np.exp(-np.clip(x @ all_weights, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (p - y) + penalty @ all_weights)
        all_weights -= step
        if np.abs(step).max(initial=0.0) < 1e-8:
            break
    weights, bias = all_weights[:-1], all_weights[-1]
    return Model(words, prefixes, {kind: float(w) for kind, w in zip(MATCHED, weights, strict=False)}, float(bias), float(weights[-1]))


def fit_labelled(docs: DataFrame, labels: DataFrame, sample_labels: int = SAMPLE_LABELS) -> Model:
    """Fits on at most sample_labels labelled rows outside the held-out remainder, in the order of a hash of doc_id.

    The rows that one task fits are bounded by sample_labels, and so is the table that is broadcast; the driver gets the
    model alone. The fit is the same whatever the order of the rows in their files.
    """
    chosen = (
        labels.where(labels["toxic"].isNotNull() & labels["doc_id"].isNotNull())
        .select(labels["doc_id"].cast("long").alias("_doc"), labels["toxic"].cast("int").alias("_toxic"))
        .where(remainder(F.col("_doc"), HELD_OUT[0]) != HELD_OUT[1])
        .distinct()
        .orderBy(F.xxhash64("_doc"), "_doc", "_toxic")
        .limit(sample_labels)
    )
    rows = docs.select(docs["doc_id"].cast("long").alias("_doc"), docs["text"].alias("_text")).join(F.broadcast(chosen), "_doc")
    # one text for each chosen label, the last in order where a doc_id has several: at most sample_labels rows
    sample = rows.groupBy("_doc", "_toxic").agg(F.max("_text").alias("_text")).select("_text", "_toxic", "_doc")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if own := [*batches]:
            table = pa.Table.from_batches(own).sort_by([("_doc", "ascending"), ("_toxic", "ascending")])
            model = fit([text or "" for text in table.column(0).to_pylist()], table.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])
            tidy()

    found = sample.coalesce(1).mapInArrow(fitted, "model binary").collect()
    return pickle.loads(found[0][0]) if found else fit([], [])


SCHEMA = "doc_id bigint, score double"


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, SCHEMA)
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score stays below the threshold, with all their columns."""
    names = docs.columns
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.score(text.as_py()) < THRESHOLD for text in batch.column(text_at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score_documents(docs, fit_labelled(docs, read(spark, sf_dir, "labels")))
