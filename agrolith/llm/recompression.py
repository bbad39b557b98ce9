"""Substring deduplication by recompression of word sequences.

A document is a sequence of words. Each round names maximal runs of a symbol, then pairs of neighbouring symbols: a
round's hash deals all symbols to a left and a right half, and each (left, right) pair becomes one symbol. Names are
hashes of what they stand for, so they are global: equal words, runs and pairs get equal names in every document and
task, and equal substrings get equal symbols inside. With every symbol goes the range of words that its borders
depend on. A phrase is the name of the symbols, one behind the other, from one on whose ranges lie within GRAM words of
its start. A window of WINDOW words knows some phrases for certain: those whose ranges it holds. Of these it picks the
one with the smallest name. Two equal windows pick equal phrases, so a window whose phrase is unique in the corpus repeats
nowhere; a window that knows no phrase of LEAST words stays in doubt.

Stage 1 shares the picked phrases and returns those that occur twice. Stage 2 shares the windows in doubt or with a shared
phrase, by 96 bits of fingerprint, and ties equal ones to the first of them. Stage 3 compares the words: within a block of
rows there and then, across blocks by fetching the words of the first one; a difference stops the job instead of removing
a word. All stages decide within a block of rows first, so that a block sends a name once, whatever the number of its
copies, and answers go to documents, never to a key: no key's rows meet in one task in greater number than there are
blocks.

Defined results: a null text has no words; a null doc_id is passed on; repeated rows repeat their words, so they are
removed like other copies; texts shorter than a window lose nothing; an empty table gives no rows; very long texts
are one sequence like others; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, steady, stored, tidy

WINDOW = 35
ROUNDS = 2
#: Words that an eligible symbol's borders may depend on before it, and words from its start on.
BEFORE, GRAM = 6, 16
#: Words that a phrase has at least.
LEAST = 8
FAR = 1 << 30
CACHE = 200_000
#: Words that a block decides on together.
BLOCK_WORDS = 1_500_000
K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Odd multipliers of the two fingerprints.
POLY_A, POLY_B = 0x9DDFEA08EB382D69, 0xC2B2AE3D27D4EB4F
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * K2
    x = (x ^ (x >> np.uint64(27))) * K3
    return x ^ (x >> np.uint64(31))


class NameCache(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


NAME_OF = NameCache()


def word_names(texts: list[bytes | None], exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words and where each text begins. bytes.split() splits at [\\x20\\x09-\\x0D]+. With exact, two
    different words of one name raise, so that comparing names is comparing words."""
    parts, sizes, kinds = [], [], set()
    for text in texts:
        words = (text or b"").split()
        if exact:
            kinds.update(words)
        parts.append(np.fromiter(map(NAME_OF.__getitem__, words), np.uint64, len(words)))
        sizes.append(len(words))
    if exact and len({NAME_OF[word] for word in kinds}) < len(kinds):
        raise ValueError("two words share a name")
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def recompress(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after some rounds: names, first words, and the ranges [low, high) of words that their borders depend on.

    A range that would reach beyond the document is out of every window's reach (FAR): a window doesn't know that a
    document begins or ends where it does.
    """
    start = np.arange(len(names), dtype=np.int64)
    low, high = start.copy(), start + 1

    def neighbours(low: np.ndarray, high: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        before, after = np.full(len(low), -FAR), np.full(len(high), FAR)
        inside = doc[1:] == doc[:-1]
        before[1:] = np.where(inside, low[:-1], -FAR)
        after[:-1] = np.where(inside, high[1:], FAR)
        return before, after

    for turn in range(rounds):
        if not len(names):
            break
        before, after = neighbours(low, high, doc)
        heads = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])]))
        lengths = np.diff(np.append(heads, len(names)))
        run = names[heads]
        names = np.where(lengths > 1, mix(run * K1 + mix(lengths.astype(np.uint64))), run)
        low, high = np.minimum(low[heads], before[heads]), np.maximum(high[heads + lengths - 1], after[heads + lengths - 1])
        start, doc = start[heads], doc[heads]

        right = (mix(names + np.uint64((turn + 1) * int(K1) % (1 << 64))) >> np.uint64(63)).astype(bool)
        pair = np.zeros(len(names), dtype=bool)
        pair[:-1] = ~right[:-1] & right[1:] & (doc[1:] == doc[:-1])
        second = np.concatenate([[False], pair[:-1]])
        before, after = neighbours(low, high, doc)
        following = np.append(names[1:], np.uint64(0))
        names = np.where(pair, mix(names * K1 ^ mix(following + K2)), names)
        low = np.where(~pair & right, np.minimum(low, before), low)
        high = np.where(pair | ~right, np.maximum(high, after), high)
        keep = ~second
        names, start, low, high, doc = names[keep], start[keep], low[keep], high[keep], doc[keep]
    return names, start, low, high


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    filled = 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * np.uint64(pow(base, filled, 1 << 64))
        filled += more
    return out


def fingerprints(names: np.ndarray, width: int, base: int) -> np.ndarray:
    """Of each stretch of width words, by prefix sums of a polynomial modulo 2**64; the first word decides the place."""
    if len(names) < width:
        return np.empty(0, np.uint64)
    up = powers(base, len(names))
    down = powers(pow(base, -1, 1 << 64), len(names))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(names * up, dtype=np.uint64)])
    return mix((sums[width:] - sums[:-width]) * down[: len(names) - width + 1])


def slide(values: np.ndarray, width: int, function: np.ufunc) -> np.ndarray:
    """function over each stretch of width values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = function(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def phrases(names: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each symbol that begins one, the phrase's name and its words' number; 0 words where there is none."""
    chain, reach = np.zeros(len(names), np.uint64), start.copy()
    end = np.append(start[1:], total)
    own = np.flatnonzero((low >= start - BEFORE) & (high <= start + GRAM) & (start + GRAM <= total))
    chain[own], reach[own] = mix(names[own] + K2), end[own]
    step = 0
    while len(own):
        step += 1
        own = own[own + step < len(names)]
        own = own[(high[own + step] <= start[own] + GRAM) & (low[own + step] >= start[own] - BEFORE)]
        chain[own], reach[own] = mix(chain[own] * K1 ^ names[own + step]), end[own + step]
    return chain, reach - start


class Block:
    """Words of some rows laid end to end, the phrases that windows may pick, and the picks."""

    def __init__(self, texts: list[bytes | None], exact: bool = False) -> None:
        self.names, self.begins = word_names(texts, exact)
        n = len(self.names)
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(self.begins))
        self.windows = max(n - WINDOW + 1, 0)
        self.inside = self.doc[: self.windows] == self.doc[WINDOW - 1 :] if self.windows else np.empty(0, bool)
        self.grams = np.full(n, NONE)
        if self.windows:
            symbols, start, low, high = recompress(self.names, self.doc)
            chain, words = phrases(symbols, start, low, high, n)
            self.grams[start[words >= LEAST]] = chain[words >= LEAST] & ~np.uint64(1)

    def picked(self, values: np.ndarray) -> np.ndarray:
        """For each window the smallest of values over the symbols that it knows, which start in its words
        BEFORE ... WINDOW - GRAM."""
        width = WINDOW - GRAM - BEFORE + 1
        return slide(values, width, np.minimum)[BEFORE : BEFORE + self.windows]

    def picks(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the symbols that some window picks, and the documents that have a window without a pick."""
        if not self.windows:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        least = self.picked(self.grams)
        doubt = np.unique(self.doc[: self.windows][self.inside & (least == NONE)])
        width = WINDOW - GRAM - BEFORE + 1
        chosen = np.where(self.inside & (least != NONE), least, np.uint64(0))
        padded = np.concatenate([np.zeros(BEFORE + width - 1, np.uint64), chosen, np.zeros(WINDOW, np.uint64)])
        most = slide(padded, width, np.maximum)[: len(self.grams)]
        return np.flatnonzero((most == self.grams) & (self.grams != NONE)), doubt


ANSWER = "block bigint, found binary"
SENT = "part int, entries binary, block bigint"
PICK = np.dtype([("name", "<u8"), ("row", "<i8"), ("place", "<u4")])
SPAN = np.dtype([("name", "<u8"), ("more", "<u4"), ("place", "<u4"), ("row", "<i8")])
FOUND = np.dtype([("row", "<i8"), ("place", "<u4")])
#: A stretch of repeated windows: size of them from place on, and the row and place where the same words stand first
#: (row NOWHERE: they were compared within their block, or are the first themselves).
RUN = np.dtype([("row", "<i8"), ("place", "<u4"), ("size", "<u4"), ("first", "<i8"), ("at", "<u4")])
NOWHERE = -1
#: Added to an entry's place: the block has the entry more than once and has answered its own rows.
TWICE = np.uint32(1 << 31)


def grouped(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in the order of their names, rows and places, where each name begins, and how often it occurs."""
    key = [name for name in ("name", "more") if name in entries.dtype.names]
    order = np.lexsort([entries["place"] & ~TWICE, entries["row"], *(entries[name] for name in reversed(key))])
    entries = entries[order]
    fresh = np.ones(len(entries), dtype=bool)
    fresh[1:] = np.logical_or.reduce([entries[name][1:] != entries[name][:-1] for name in key])
    heads = np.flatnonzero(fresh)
    return order, heads, np.diff(np.append(heads, len(entries)))


def found_bytes(entries: np.ndarray) -> bytes:
    out = np.empty(len(entries), FOUND)
    out["row"], out["place"] = entries["row"], entries["place"]
    return out.tobytes()


def runs_of(rows: np.ndarray, places: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Windows (row, place), tied to the windows (first, at), as runs: both places go on by one within a run."""
    order = np.lexsort((places, rows))
    rows, places, first, at = rows[order], places[order].astype(np.int64), first[order], at[order].astype(np.int64)
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (first[1:] != first[:-1]) | (places[1:] != places[:-1] + 1) | ((first[1:] != NOWHERE) & (at[1:] != at[:-1] + 1))
    heads = np.flatnonzero(fresh)
    out = np.empty(len(heads), RUN)
    out["row"], out["place"], out["first"], out["at"] = rows[heads], places[heads], first[heads], at[heads]
    out["size"] = np.diff(np.append(heads, len(rows)))
    return out


def merged(runs: np.ndarray) -> np.ndarray:
    """Runs of the same rows and shift that touch or overlap become one."""
    shift = np.where(runs["first"] == NOWHERE, 0, runs["at"].astype(np.int64) - runs["place"])
    order = np.lexsort((runs["place"], shift, runs["first"], runs["row"]))
    runs, shift = runs[order], shift[order]
    group = np.ones(len(runs), bool)
    group[1:] = (runs["row"][1:] != runs["row"][:-1]) | (runs["first"][1:] != runs["first"][:-1]) | (shift[1:] != shift[:-1])
    number = np.cumsum(group)
    ends = runs["place"].astype(np.int64) + runs["size"]
    far = np.maximum.accumulate(ends + (number << 33)) - (number << 33)  # furthest end so far within the group
    fresh = group.copy()
    fresh[1:] |= runs["place"][1:] > far[:-1]
    heads = np.flatnonzero(fresh)
    out = runs[heads].copy()
    out["size"] = far[np.append(heads[1:], len(runs)) - 1] - out["place"] if len(heads) else 0
    return out


def sent_batch(parts: list[int], blobs: list[bytes], block: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary()), pa.array([block] * len(parts), pa.int64())], ["part", "entries", "block"])


def share(entries: np.ndarray, places: np.ndarray, block: int, parts: int, check=None) -> Iterator[pa.RecordBatch]:
    """Decides a block by itself, then sends: what occurs twice in it is answered (part -1 - ...) and sent once as
    known, the rest is sent with its place. places says by which name an entry finds its part. check, if given, is called
    with the numbers of entries and of the first entries of the same name, and windows are answered as runs."""
    if not len(entries):
        return
    order, heads, counts = grouped(entries)
    if check is not None:
        twice = np.repeat(counts > 1, counts)
        check(order[twice], order[np.repeat(heads, counts)][twice])
    entries, places = entries[order], places[order]
    own = entries[np.repeat(counts > 1, counts)]
    if len(own):
        nowhere = np.full(len(own), NOWHERE)
        yield sent_batch([-1 - block % parts], [found_bytes(own) if check is None else runs_of(own["row"], own["place"], nowhere, own["place"]).tobytes()], block)
    sent = entries[heads].copy()
    sent["place"][counts > 1] |= TWICE
    part = (places[heads] % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    sent, part = sent[order], part[order]
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    yield sent_batch(part[cuts].tolist(), [x.tobytes() for x in np.split(sent, cuts[1:])], block)


def repeated(sent: DataFrame, kind: np.dtype) -> DataFrame:
    """By row what of it occurs at least twice, from blocks' shares: places of phrases, or runs of windows. Answers go back
    by block, which holds no more of them than it has words, and come out as one row a document."""
    windows, answer = kind is SPAN, RUN if kind is SPAN else FOUND

    def decide(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, senders = [], []
        for batch in batches:
            if key[0].as_py() < 0:
                yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1)], ["block", "found"])
            else:
                blobs += batch.column(1).to_pylist()
                senders += batch.column(2).to_pylist()
        if not blobs:
            return
        entries = np.frombuffer(b"".join(blobs), kind)
        sender = np.repeat(np.array(senders, np.int64), [len(blob) // kind.itemsize for blob in blobs])
        order, heads, counts = grouped(entries)
        entries, sender = entries[order], sender[order]
        first = np.repeat(heads, counts)
        twice = entries["place"] & TWICE > 0
        known = np.logical_or.reduceat(twice, heads) | (counts > 1)
        # a window that repeats in its block is tied to the first one, too, so that its words are compared across blocks
        wanted = np.repeat(known, counts) & (~twice | (windows & (np.arange(len(entries)) != first)))
        places = entries["place"] & ~TWICE
        chosen = np.flatnonzero(wanted)
        chosen = chosen[np.argsort(sender[chosen], kind="stable")]
        for at in np.split(chosen, np.flatnonzero(np.diff(sender[chosen])) + 1) if len(chosen) else []:
            yield answers(int(sender[at[0]]), entries, places, first, at)

    def answers(block: int, entries: np.ndarray, places: np.ndarray, first: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        if windows:
            lead = first[at]
            itself = lead == at
            found = runs_of(entries["row"][at], places[at], np.where(itself, NOWHERE, entries["row"][lead]), places[lead]).tobytes()
        else:
            out = np.empty(len(at), FOUND)
            out["row"], out["place"] = entries["row"][at], places[at]
            found = out.tobytes()
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([found], pa.binary())], ["block", "found"])

    def gather(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.frombuffer(b"".join(blob for batch in batches for blob in batch.column(1).to_pylist()), answer)
        found = merged(found) if windows else found[np.lexsort((found["place"], found["row"]))]
        if len(found):
            cuts = np.flatnonzero(np.concatenate([[True], found["row"][1:] != found["row"][:-1]]))
            own = np.split(found if windows else found["place"], cuts[1:])
            yield pa.RecordBatch.from_arrays([pa.array(found["row"][cuts]), pa.array([x.tobytes() for x in own], pa.binary())], ["row", "places"])

    decided = sent.groupBy("part").applyInArrow(decide, ANSWER)
    return decided.groupBy("block").applyInArrow(gather, "row bigint, places binary")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """Rows (row, text, places) gathered until they hold about BLOCK_WORDS words."""
    rows, texts, places, size = [], [], [], 0
    for batch in batches:
        answers_of = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
        for row, text, own in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), answers_of, strict=True):
            rows.append(row)
            texts.append(text)
            places.append(own)
            size += len(text or b"")
            if size >= 6 * BLOCK_WORDS:
                yield rows, texts, places
                rows, texts, places, size = [], [], [], 0
    if rows:
        yield rows, texts, places
    tidy(NAME_OF)  # workers don't carry caches into other stages


#: The place of a document that has a window without a pick.
DOUBT = 0xFFFFFFFF


def places_of(own: bytes | None) -> np.ndarray:
    places = np.frombuffer(own or b"", "<u4").astype(np.int64)
    return places[places != DOUBT]


def share_picks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for rows, texts, _ in blocks(batches):
        block, ids = Block(texts), np.array(rows, dtype=np.int64)
        starts, doubt = block.picks()
        entries = np.empty(len(starts), PICK)
        entries["name"], entries["row"] = block.grams[starts], ids[block.doc[starts]]
        entries["place"] = starts - block.begins[block.doc[starts]]
        yield from share(entries, entries["name"], rows[0], parts)
        if len(doubt):
            marks = np.empty(len(doubt), PICK)
            marks["row"], marks["place"] = ids[doubt], DOUBT
            yield sent_batch([-1 - rows[0] % parts], [found_bytes(marks)], rows[0])


def same_words(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the windows at a hold the same words as those at b."""
    views = np.lib.stride_tricks.sliding_window_view(names, WINDOW)
    return all(np.array_equal(views[a[at : at + 20_000]], views[b[at : at + 20_000]]) for at in range(0, len(a), 20_000))


def share_windows(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for rows, texts, places in blocks(batches):
        block, ids = Block(texts, exact=True), np.array(rows, dtype=np.int64)
        if not block.windows:
            continue
        shared = np.zeros(len(block.names), dtype=np.uint64)
        for at, own in enumerate(places):
            shared[block.begins[at] + places_of(own)] = 1
        # the lowest bit of a phrase's name tells whether it is shared
        least = block.picked(np.where(block.grams == NONE, NONE, block.grams | (np.uint64(1) - shared)))
        starts = np.flatnonzero(block.inside & ((least == NONE) | (least & np.uint64(1) == 0)))
        entries = np.empty(len(starts), SPAN)
        entries["name"] = fingerprints(block.names, WINDOW, POLY_A)[starts]
        entries["more"] = fingerprints(block.names, WINDOW, POLY_B)[starts] >> np.uint64(32)
        entries["row"] = ids[block.doc[starts]]
        entries["place"] = starts - block.begins[block.doc[starts]]

        def check(one: np.ndarray, two: np.ndarray, names: np.ndarray = block.names, starts: np.ndarray = starts) -> None:
            if not same_words(names, starts[one], starts[two]):
                raise ValueError("two windows share a fingerprint")

        # equal windows have equal picks; by pick, neighbouring windows meet their copies in the same part
        yield from share(entries, np.where(least[starts] == NONE, entries["name"], mix(least[starts])), rows[0], parts, check)


def removed_words(n_words: int, runs: np.ndarray) -> np.ndarray:
    """Which words a repeated window covers."""
    change = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(change, runs["place"].astype(np.int64), 1)
    np.add.at(change, np.minimum(runs["place"].astype(np.int64) + runs["size"] + WINDOW - 1, n_words), -1)
    return np.cumsum(change)[:n_words] > 0


#: Groups in which the runs tied to one row are fetched, so that no number of them meets in one row of a table.
FETCHES = 256


def fetched(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """(row, slices): for each row the words of the stretches that its runs are tied to, in the order of the runs. Only
    rows that others are tied to send words, and only those."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, firsts, ats, sizes, numbers = [], [], [], [], []
            for row, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(own, RUN)
                for number in np.flatnonzero(own["first"] != NOWHERE).tolist():
                    run = own[number]
                    owners.append(row)
                    firsts.append(int(run["first"]))
                    ats.append(int(run["at"]))
                    sizes.append(int(run["size"]))
                    numbers.append(number)
            yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(firsts, pa.int64()), pa.array(ats, pa.int64()), pa.array(sizes, pa.int64()), pa.array(numbers, pa.int32())], ["owner", "first", "at", "size", "number"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, numbers, slices = [], [], []
            for text, asked in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = text.split()
                for own in asked:
                    owners.append(own["owner"])
                    numbers.append(own["number"])
                    slices.append(b" ".join(words[own["at"] : own["at"] + own["size"] + WINDOW - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(numbers, pa.int32()), pa.array(slices, pa.binary())], ["row", "number", "words"])

    asked = runs.mapInArrow(ask, "owner bigint, first bigint, at bigint, size bigint, number int")
    by_first = asked.groupBy(F.col("first").alias("row"), F.pmod(F.xxhash64("owner"), F.lit(FETCHES)).alias("group")).agg(F.collect_list(F.struct("owner", "at", "size", "number")).alias("asked"))
    slices = rows.join(by_first.drop("group"), "row").select("text", "asked").mapInArrow(cut, "row bigint, number int, words binary")
    return slices.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("number", "words"))), lambda x: x["words"]).alias("slices"))


def with_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), docs["text"].alias("text"), docs["doc_id"].cast("long").alias("doc_id"))


def repeated_windows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of docs (row, text, doc_id), and by row the runs of its windows that occur twice or more."""
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_rows(steady(docs))
    picks = repeated(rows.select("row", "text").mapInArrow(lambda b: share_picks(b, parts), SENT), PICK)
    # doc_id comes along so that this join and the last one read the same exchange of the texts
    doubted = rows.join(picks, "row", "left").select("row", "text", "places", "doc_id").where(F.col("places").isNotNull())
    return rows, stored(repeated(doubted.mapInArrow(lambda b: share_windows(b, parts), SENT), SPAN), "runs")


SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
FULL_SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"


def remove_repeats(docs: DataFrame, digests: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space (or their digest)."""
    rows, found = repeated_windows(docs)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, own, slices in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = (text or b"").split()
                n_words.append(len(words))
                if own:
                    runs = np.frombuffer(own, RUN)
                    tied = runs[runs["first"] != NOWHERE]
                    if len(tied) != len(slices or ()) or any(b" ".join(words[a : a + n + WINDOW - 1]) != there for a, n, there in zip(tied["place"].tolist(), tied["size"].tolist(), slices or (), strict=True)):
                        raise ValueError("two windows share a fingerprint")
                    gone = removed_words(len(words), runs)
                    words = [word for word, out in zip(words, gone.tolist(), strict=True) if not out]
                n_removed.append(n_words[-1] - len(words))
                joined = b" ".join(words)
                kept.append(hashlib.sha256(joined).hexdigest() if digests else joined.decode())
            names = [part.split()[0] for part in SCHEMA.split(", ")][:3] + ["kept_sha256" if digests else "kept_text"]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names)

    answered = found.join(fetched(rows, found), "row", "left")
    return rows.join(answered, "row", "left").select("doc_id", "text", "places", "slices").mapInArrow(finish, SCHEMA if digests else FULL_SCHEMA)


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"), digests=True)


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM s)),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM g WHERE n > 1)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
