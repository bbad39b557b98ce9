"""Personal data by a skip-chain conditional random field over the tokens of a document.

Patterns with checks (part ranges, Luhn, digit counts) give the base spans. The field then labels the document's
candidate tokens (those with a digit or an at sign, and copies of tokens in base spans): a chain potential joins
neighbouring candidates, and a skip potential joins distant tokens with the same or a similar canonical form, so that
a number recognised once in a telling form is also labelled where it stands bare. Loopy sum-product message passing runs until the messages
settle or `ROUNDS` is reached. Base spans are clamped; the field can only add spans.

Emission, chain and skip weights are fitted together by pseudo-likelihood on a bounded sample of documents (`SAMPLE_DOCS`,
the first in the order of a hash of doc_id), whose base spans are the labels while the features see no clamp.

Defined results: a null text counts as empty and has no spans; a null doc_id is passed on; repeated rows give repeated
results; an empty table gives no rows; very long texts are scanned whole in linear time (each pattern starts only
where it can match); equal candidates are grouped, so messages grow linearly with the number of tokens; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .hmm import sampled_texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
ROUNDS, SETTLED = 60, 1e-5
SAMPLE_DOCS = 2000
#: A token joins a base span's copies by canonical form only from this length on, so that short numbers never spread.
LEAST_KEY = 7
#: An added span needs at least this marginal.
THRESHOLD = 0.5
#: The prior on emissions and chains when the field is fitted: the labels come from patterns over the same forms.
FORM_RIDGE = 0.1

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
#: A candidate token: a maximal stretch without white space that holds a digit or an at sign.
CANDIDATE = re.compile(r"[^\s0-9@]*+[0-9@]\S*+")
#: Stretches of digits with blanks, brackets, points and hyphens between them, and at most so many taken as one number.
STRETCHES = re.compile(r"\(?[0-9]++(?:[ ().-]{1,3}[0-9]++)++")
DIGITS = re.compile(r"[0-9]++")
PARTS = 6
TRIM = "\"'()[]{}<>,;:!?.*#$%&|"


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if at % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches: a domain is looked for at each at sign, then the local part is the run before it."""
    end = 0
    for match in DOMAIN.finditer(text):
        start = match.start()
        while start > end and text[start - 1] in LOCAL_LETTERS:
            start -= 1
        if start < match.start():
            end = match.end()
            yield start, end


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Kind -> (start, end) in code points. Matches that fail their check are dropped and not retried."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = list(emails(text))
    if DIGIT.search(text):
        for match in IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in match[0].split(".")):
                found["ip"].append(match.span())
        for match in CARD.finditer(text):
            if match.end() - match.start() >= 16:
                digits = match[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(match.span())
        if "+" in text:
            for match in PHONE.finditer(text):
                if 8 <= len(NOT_DIGIT.sub("", match[0])) <= 15:
                    found["phone"].append(match.span())
    return found


def canonical(token: str) -> str:
    """What copies of an identifier have in common: its letters in lower case and its digits."""
    return "".join(letter for letter in token.lower() if letter.isalnum() or letter == "@")


def digits_tail(token: str) -> str:
    """Similar numbers share their last seven digits, whatever prefix or separators they carry."""
    digits = NOT_DIGIT.sub("", token)
    return digits[-7:] if len(digits) >= 7 else ""


def spaced(text: str, numbers: list[str]) -> Iterator[tuple[int, int]]:
    """Spans of neighbouring stretches of digits that together give one of the numbers or its end, or end in it. At
    each last stretch the longest such span counts."""
    tails: dict[str, list[str]] = {}
    for number in dict.fromkeys(numbers):
        tails.setdefault(number[-7:], []).append(number)
    for match in STRETCHES.finditer(text):
        parts = [(part.start() + match.start(), part[0]) for part in DIGITS.finditer(match[0])]
        end = len(parts)
        while end > 1:
            digits, best = "", None
            for first in range(end - 1, max(end - 1 - PARTS, -1), -1):
                digits = parts[first][1] + digits
                if len(digits) > 19:
                    break
                if first < end - 1 and len(digits) >= 7 and any(number.endswith(digits) or digits.endswith(number) for number in tails.get(digits[-7:], ())):
                    best = first
            if best is None:
                end -= 1
                continue
            start = parts[best][0] - (text[max(parts[best][0] - 1, 0)] == "(")
            yield start, parts[end - 1][0] + len(parts[end - 1][1])
            end = best


class Tokens:
    """The field's nodes: base spans (clamped) and the candidates outside them, in order of the text. Digits in several
    stretches that make up a base span's number are one candidate."""

    def __init__(self, text: str, spans: dict[str, list[tuple[int, int]]]) -> None:
        covered = sorted((start, end, number + 1) for number, kind in enumerate(KINDS) for start, end in spans[kind])
        nodes, blocked = [(start, end, label) for start, end, label in covered], []
        for start, end, _ in covered:
            if blocked and start <= blocked[-1][1]:
                blocked[-1][1] = max(blocked[-1][1], end)
            else:
                blocked.append([start, end])
        starts = np.array([start for start, _ in blocked], dtype=np.int64)
        ends = np.array([end for _, end in blocked], dtype=np.int64)
        free = lambda start, end: (at := int(np.searchsorted(ends, start, side="right"))) == len(ends) or starts[at] >= end
        numbers = [digits for start, end, _ in covered if len(digits := NOT_DIGIT.sub("", text[start:end])) >= LEAST_KEY]
        joined = sorted(span for span in spaced(text, numbers) if free(*span)) if numbers else []
        nodes += [(start, end, 0) for start, end in joined]
        joined_ends = np.array([end for _, end in joined], dtype=np.int64)
        for match in CANDIDATE.finditer(text):
            token = match[0]
            start = match.start() + len(token) - len(token.lstrip(TRIM))
            end = match.start() + len(token.rstrip(TRIM))
            if end <= start:
                continue
            at = int(np.searchsorted(joined_ends, start, side="right"))
            if free(start, end) and (at == len(joined) or joined[at][0] >= end):
                nodes.append((start, end, 0))
        nodes.sort()
        self.nodes = nodes
        self.words = [text[start:end] for start, end, _ in nodes]
        self.clamped = np.array([label for _, _, label in nodes], dtype=np.int64)


def features(word: str) -> list[int]:
    """Indices of the binary features of a token."""
    digits = sum(letter.isdigit() for letter in word)
    return [
        0,
        1 + min(digits, 20),
        22 + min(word.count("."), 4),
        27 + ("@" in word),
        29 + word.startswith("+"),
        31 + (digits == len(word)),
        33 + any(letter.isalpha() for letter in word),
        35 + min(word.count("-"), 3),
        39 + min(len(word) // 4, 8),
    ]


WIDTH = 48


def groups_of(words: list[str]) -> list[list[int]]:
    """Skip cliques: nodes with the same canonical form, or with the same last seven digits. One hub each."""
    by: dict[str, list[int]] = {}
    for at, word in enumerate(words):
        form = canonical(word)
        if len(form) >= LEAST_KEY:
            by.setdefault(f"={form}", []).append(at)
        if tail := digits_tail(word):
            by.setdefault(f"~{tail}", []).append(at)
    return [members for members in by.values() if len(members) > 1]


def hub_strength(skip: float) -> float:
    """The strength between a member and its hub at which two members agree as by a skip potential between them: where
    (e^2h + k - 1) / (2 e^h + k - 2) is e^skip."""
    k, e = len(LABELS), np.exp(skip)
    return float(np.log(e + np.sqrt(e * e + (k - 2) * e - (k - 1))))


class Field:
    """Weights: emission (label x feature), chain (label x label) and the strength of skip potentials."""

    def __init__(self, emission: np.ndarray, chain: np.ndarray, skip: float) -> None:
        self.emission, self.chain, self.skip = emission, chain, skip

    def unary(self, words: list[str]) -> np.ndarray:
        return np.array([self.emission[:, features(word)].sum(axis=1) for word in words])

    def marginals(self, words: list[str], clamped: np.ndarray) -> np.ndarray:
        """Loopy sum-product. A skip clique of any size costs two messages a member: its potential is attached to a
        hub variable with the same labels, which all members are drawn to."""
        n, k = len(words), len(LABELS)
        unary = self.unary(words)
        unary[clamped > 0] = -30.0
        unary[clamped > 0, clamped[clamped > 0]] = 30.0
        groups = groups_of(words)
        pair = np.exp(self.chain)
        hub_pair = np.exp(hub_strength(self.skip) * np.eye(k))
        right, left = np.zeros((n, k)), np.zeros((n, k))
        to_hub = [np.zeros((len(g), k)) for g in groups]
        from_hub = [np.zeros((len(g), k)) for g in groups]
        skip_in = np.zeros((n, k))

        def through(belief: np.ndarray, table: np.ndarray) -> np.ndarray:
            top = belief.max(axis=-1, keepdims=True)
            out = np.log(np.exp(belief - top) @ table)
            return out - out.max(axis=-1, keepdims=True)

        for turn in range(ROUNDS):
            before = skip_in.copy()
            for at in range(1, n):
                right[at] = through(unary[at - 1] + right[at - 1] + skip_in[at - 1], pair)
            for at in range(n - 2, -1, -1):
                left[at] = through(unary[at + 1] + left[at + 1] + skip_in[at + 1], pair.T)
            belief = unary + right + left + skip_in
            skip_in = np.zeros((n, k))
            for number, group in enumerate(groups):
                out = through(belief[group] - from_hub[number], hub_pair)
                to_hub[number] = out
                hub = out.sum(axis=0) - out
                sent = through(np.clip(hub, -60, 60), hub_pair)
                from_hub[number] = sent if turn < 10 else (sent + from_hub[number]) / 2  # messages that swing settle
                np.add.at(skip_in, group, from_hub[number])
            if np.abs(skip_in - before).max(initial=0.0) < SETTLED:
                break
        belief = unary + right + left + skip_in
        belief -= belief.max(axis=1, keepdims=True)
        out = np.exp(belief)
        return out / out.sum(axis=1, keepdims=True)

    def added(self, text: str, spans: dict[str, list[tuple[int, int]]]) -> list[tuple[str, int, int]]:
        """Spans beyond the base: candidates tied to other tokens by a skip clique, whose marginal is telling."""
        if not any(spans.values()):
            return []
        tokens = Tokens(text, spans)
        if (tokens.clamped == 0).sum() == 0:
            return []
        tied = {at for group in groups_of(tokens.words) if tokens.clamped[group].any() for at in group}
        if not any(tokens.clamped[at] == 0 for at in tied):
            return []
        marginals = self.marginals(tokens.words, tokens.clamped)
        out = []
        for at in sorted(tied):
            label = int(marginals[at].argmax())
            if tokens.clamped[at] == 0 and label and marginals[at, label] >= THRESHOLD:
                out.append((KINDS[label - 1], *tokens.nodes[at][:2]))
        return out


def fit(texts: list[str], steps: int = 200, rate: float = 0.5, ridge: float = 1e-3, form_ridge: float = FORM_RIDGE) -> Field:
    """Emission, chain and skip weights together, by pseudo-likelihood: each token's label given those of its neighbours
    and of the tokens tied to it. Labels are the base spans; a token without one that is tied to one is unknown, not
    "none", and takes no part, as do the tokens beside it on that side. Emissions and chains have the stronger prior,
    since the labels come from patterns over the same forms."""
    k = len(LABELS)
    rows, labels, lefts, rights, ties = [], [], [], [], []
    for text in texts:
        tokens = Tokens(text, base_spans(text))
        groups = groups_of(tokens.words)
        unknown = np.zeros(len(tokens.words), bool)
        for group in groups:
            if tokens.clamped[group].any():
                unknown[[at for at in group if not tokens.clamped[at]]] = True
        agree = np.zeros((len(tokens.words), k))
        for group in groups:
            own = np.eye(k)[tokens.clamped[group]] * ~unknown[group][:, None]
            agree[group] += np.minimum(own.sum(axis=0) - own, 1.0)
        for at, word in enumerate(tokens.words):
            if unknown[at]:
                continue
            rows.append(features(word))
            labels.append(tokens.clamped[at])
            lefts.append(tokens.clamped[at - 1] if at and not unknown[at - 1] else -1)
            rights.append(tokens.clamped[at + 1] if at + 1 < len(tokens.words) and not unknown[at + 1] else -1)
            ties.append(agree[at])
    emission, chain, skip = np.zeros((k, WIDTH)), np.zeros((k, k)), 0.0
    if rows:
        x, y = np.zeros((len(rows), WIDTH)), np.eye(k)[labels]
        for at, own in enumerate(rows):
            x[at, own] = 1
        left = np.eye(k + 1)[lefts][:, :k]
        right = np.eye(k + 1)[rights][:, :k]
        tied, n = np.array(ties), len(rows)
        for _ in range(steps):
            score = x @ emission.T + left @ chain + right @ chain.T + skip * tied
            score -= score.max(axis=1, keepdims=True)
            p = np.exp(score)
            p /= p.sum(axis=1, keepdims=True)
            miss = p - y
            emission -= rate * (miss.T @ x / n + form_ridge * emission)
            chain -= rate * ((left.T @ miss + miss.T @ right) / n + form_ridge * chain)
            skip -= rate * ((miss * tied).sum() / max(tied.any(axis=1).sum(), 1) + ridge * skip)
    return Field(emission, chain, float(max(skip, 0.0)))


def fit_sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """Fits on at most sample_docs documents that hold a digit, the first in the order of a hash of doc_id, whole; the
    number bounds what reaches the driver."""
    rows = docs.select(docs["doc_id"].cast("long").alias("_doc"), docs["text"].alias("_text")).where(F.col("_text").rlike("[0-9]"))
    return fit([text.decode() for text in sampled_texts(rows, sample_docs) if text])


SCHEMA = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint, n_spans bigint"


def find(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, base counts by kind, digest of the base spans, all spans, how many the field added, and how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            columns: list[list] = [[] for _ in names[1:]]
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = base_spans(text)
                added = field.added(text, spans)
                base = ",".join(f"{kind}:{start}:{end}" for kind in KINDS for start, end in spans[kind])
                every = base
                if added:
                    merged = {kind: sorted({*spans[kind], *((start, end) for k, start, end in added if k == kind)}) for kind in KINDS}
                    every = ",".join(f"{kind}:{start}:{end}" for kind in KINDS for start, end in merged[kind])
                row = [*(len(spans[kind]) for kind in KINDS), hashlib.sha256(base.encode()).hexdigest(), every, len(added), len(every.split(",")) if every else 0]
                for column, cell in zip(columns, row, strict=True):
                    column.append(cell)
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, SCHEMA)


def redact(text: str, spans: str) -> str:
    """The text with each span of find() replaced by its kind in brackets; overlapping spans become one."""
    parsed = sorted((int(s), int(e), k) for k, s, e in (part.split(":") for part in spans.split(",") if part))
    out, at = [], 0
    for start, end, kind in parsed:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return find(docs, fit_sample(docs))
