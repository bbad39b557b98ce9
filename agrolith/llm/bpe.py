"""Byte-pair encoding as a streaming transducer with bounded lookahead, and its incremental decoder.

A merge list fixes how far to the right a token boundary can depend on the text: `sufficient_lookahead` bounds it in
bytes with one pass over the merges. Each document has one `Encoder`, which takes its text in chunks and emits ids as
soon as nothing that follows can change them: white space ends everything that the vocabulary's normaliser, splitter
and merges do, so the words before it are stable; a word without an end goes on through a `Transducer`, which holds a
block and the lookahead at most. What a finished word or piece came to is remembered in tables of bounded bytes, which
changes no result. Words that a few documents bring and the tables lack are merged together before these are encoded,
one merge of each a step. The encoder holds no ids and no text beyond an unfinished word's last block.

The decoder is a state machine, one for a document, that takes ids as they come and gives the text that they make
certain: `pieces` joins vocabulary entries by a space, as a vocabulary without a decoder does; `text` turns entries back
to bytes, ends words, and holds an unfinished UTF-8 sequence until its last byte comes.

Defined results: a null text counts as empty and has no ids; a null doc_id is passed on; rows repeat as they come in;
an empty table gives no rows; very long texts and words use the same bounded buffers (a word is held whole only as far
as it has no two neighbouring letters, where alone it may be cut); other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import itertools
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame, SparkSession

from .common import read, stored, tidy

BLOCK = 4096
#: The first code point from which letter and number classes differ between versions of Unicode.
LATEST = "\u0530"
#: Fixed by the vocabulary's pattern.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Bytes, by estimate, of each of the two generations of remembered words, and of remembered pieces.
WORD_BYTES, PIECE_BYTES = 20_000_000, 10_000_000
#: What an entry takes beside its own bytes.
ENTRY_BYTES = 140
#: Bytes of text that an encoder is given at a time, and the longest word or piece that is remembered.
CHUNK, LONGEST = 1 << 16, 64
NONE = 1 << 30
#: New words that are merged together, bytes of text in which they are looked for, and pieces of one length from which that
#: is cheaper than one by one.
NEW_WORDS, NEW_BYTES, WORTH = 20_000, 4_000_000, 8
#: No byte of UTF-8 below LATEST reaches this one.
LATEST_BYTE = 0xD4
#: Between these a letter may join with the one before it.
JAMO = ((0x1100, 0x11FF), (0xA960, 0xA97F), (0xD7B0, 0xD7FF))
SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
FULL_SCHEMA = "doc_id bigint, ids array<int>, decoded string"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes stand for themselves, the others follow 255."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in own else spare))
        spare += byte not in own
    return letters


#: The tokenizers library's own tables answer for letters that Python's don't have yet.
LIBRARY_NFC, LIBRARY_LOWER = tokenizers.normalizers.NFC(), tokenizers.normalizers.Lowercase()
LIBRARY_KINDS = [(name, tokenizers.pre_tokenizers.Split(tokenizers.Regex(rf"\p{{{name}}}"), "isolated")) for name in ("L", "N")]


@lru_cache(maxsize=1 << 16)
def kind(letter: str) -> str:
    """l, n, s or o: letter, number, white space, other."""
    category = unicodedata.category(letter)
    if category == "Cn":  # Python's tables may be older than the library's
        category = next((name for name, split in LIBRARY_KINDS if len(split.pre_tokenize_str(f"{letter}{letter}")) == 2), category)
    return "s" if letter in SPACES else {"L": "l", "N": "n"}.get(category[0], "o")


#: Unicode's White_Space.
SPACES = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def sufficient_lookahead(merges: list[tuple[int, int, int]], width: dict[int, int]) -> int:
    """Bytes right of a token that suffice to tell whether it stands. merges: (left, right, merged), first merge first.

    Whether a merge happens depends on its operands having been formed and not having been taken by an earlier merge.
    An operand taken on its right adds the taker's right operand and what that merge itself has to see; all of these
    come earlier in the list, so one pass in list order gives the bound for every merge.
    """
    formed: dict[int, int] = {}
    taken: dict[int, int] = {}
    most = 0
    for left, right, merged in merges:
        need = max(formed.get(right, 0), formed.get(left, 0), taken.get(right, 0), taken.get(left, 0))
        formed[merged] = max(formed.get(merged, 0), need)
        taken[left] = max(taken.get(left, 0), width[right] + need)
        taken[right] = max(taken.get(right, 0), need)
        most = max(most, width[right] + need)
    return most


class Memo(dict):
    """What was found for a key; the oldest half goes when the bytes of two generations are reached."""

    def __init__(self, limit: int) -> None:
        self.limit, self.size, self.old = limit, 0, {}

    def put(self, key: bytes, value: bytes) -> bytes:
        self[key] = value
        self.size += len(key) + len(value) + ENTRY_BYTES
        if self.size > self.limit:
            self.old, self.size = dict(self), 0
            self.clear()
        return value

    def forget(self) -> None:
        self.old, self.size = {}, 0
        self.clear()


class Vocabulary:
    """A word-end byte-pair vocabulary: NFC, lower case, split into contractions, letters, single digits and the rest."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.entries = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for entry, number in [*ids.items(), *self.special.items()]:
            self.entries[number] = entry
        self.entry_bytes = [entry.encode() for entry in self.entries]
        self.inner = [ids[letter] for letter in byte_letters()]
        self.final = [ids[letter + self.end] for letter in byte_letters()]
        self.width = {number: len(entry.removesuffix(self.end)) for entry, number in ids.items()}
        self.rank_of: dict[tuple[int, int], int] = {}
        rules = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            rule = (ids[left], ids[right], ids[left + right])
            self.rank_of[rule[:2]] = rank
            rules.append(rule)
        self.merged_of = [rule[2] for rule in rules]
        self.lookahead = sufficient_lookahead(rules, self.width)
        # the same as arrays: the rank of a pair stands where its key does
        keys = np.array([left * len(self.entries) + right for left, right in self.rank_of], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array([*self.rank_of.values()], np.int64)[order]
        self.inner_of, self.final_of, self.merged_at = (np.array(x, np.int64) for x in (self.inner, self.final, self.merged_of))
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.splitter, self.marked = regex.compile(pattern), regex.compile(f"{pattern}| ")
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        self.longest_special = max(map(len, self.special), default=0)
        self.words, self.pieces = Memo(WORD_BYTES), Memo(PIECE_BYTES)

    def forget(self) -> None:
        """At a partition's end, so that workers don't carry what they remember into other stages."""
        self.words.forget()
        self.pieces.forget()
        tidy()

    def normalise(self, text: str) -> str:
        if text and max(text) >= LATEST and any(unicodedata.category(letter) == "Cn" for letter in text):
            return LIBRARY_LOWER.normalize_str(LIBRARY_NFC.normalize_str(text))
        text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def merge(self, symbols: list[int]) -> list[int]:
        """All merges of a sequence, the earliest rule first, from left to right. Long ones keep the neighbours' ranks
        in a heap and the symbols in a linked list, so that a merge costs a logarithm of the length."""
        rank_of, merged_of = self.rank_of.get, self.merged_of
        last = len(symbols) - 1
        if last >= LONGEST:
            return self.merge_long(symbols)
        ranks = [rank_of(pair, NONE) for pair in zip(symbols, symbols[1:], strict=False)]
        while last and (best := min(ranks)) != NONE:
            at = ranks.index(best)
            symbols[at] = new = merged_of[best]
            del symbols[at + 1], ranks[at]
            last -= 1
            if at:
                ranks[at - 1] = rank_of((symbols[at - 1], new), NONE)
            if at < last:
                ranks[at] = rank_of((new, symbols[at + 1]), NONE)
        return symbols

    def merge_long(self, symbols: list[int]) -> list[int]:
        rank_of, merged_of, n = self.rank_of.get, self.merged_of, len(symbols)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(rank, at) for at, pair in enumerate(zip(symbols, symbols[1:], strict=False)) if (rank := rank_of(pair, NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            second = after[at]
            if symbols[at] < 0 or second < 0 or rank_of((symbols[at], symbols[second]), NONE) != rank:
                continue
            symbols[at], symbols[second] = merged_of[rank], -1
            after[at] = then = after[second]
            if then >= 0:
                before[then] = at
                if (new := rank_of((symbols[at], symbols[then]), NONE)) != NONE:
                    heapq.heappush(heap, (new, at))
            if (last := before[at]) >= 0 and (new := rank_of((symbols[last], symbols[at]), NONE)) != NONE:
                heapq.heappush(heap, (new, last))
        return [symbol for symbol in symbols if symbol >= 0]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * len(self.entries) + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """The packed ids of whole pieces of one length. All advance by a merge a step, so those not done yet have as many
        symbols."""
        letters = np.frombuffer(b"".join(pieces), np.uint8).reshape(len(pieces), -1)
        symbols = self.inner_of[letters]
        symbols[:, -1] = self.final_of[letters[:, -1]]
        out, left = [b""] * len(pieces), np.arange(len(pieces))

        def done(rows: np.ndarray, found: np.ndarray) -> None:
            blob, width = found.astype("<u4").tobytes(), 4 * found.shape[1]
            for number, row in enumerate(rows.tolist()):
                out[row] = blob[number * width : (number + 1) * width]

        ranks = self.ranks_of(symbols[:, :-1], symbols[:, 1:])
        while ranks.shape[1] and len(left):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(left)), at]
            if not (goes_on := best != NONE).all():
                done(left[~goes_on], symbols[~goes_on])
                left, symbols, ranks, at, best = left[goes_on], symbols[goes_on], ranks[goes_on], at[goes_on], best[goes_on]
            rows, width = np.arange(len(left)), ranks.shape[1]
            symbols[rows, at] = self.merged_at[best]
            stays = np.ones(symbols.shape, bool)
            stays[rows, at + 1] = False
            symbols, ranks = symbols[stays].reshape(len(left), width), ranks[stays[:, 1:]].reshape(len(left), width - 1)
            for own, pair in ((np.flatnonzero(at > 0), at - 1), (np.flatnonzero(at < width - 1), at)):
                ranks[own, pair[own]] = self.ranks_of(symbols[own, pair[own]], symbols[own, pair[own] + 1])
        done(left, symbols)
        return out

    def learn(self, words: list[bytes]) -> None:
        """Remembers what words come to, their new pieces merged together."""
        words = [word for word in words if len(word) <= LONGEST and max(word) < LATEST_BYTE and b"<|" not in word]
        if not words:
            return
        tokens = self.marked.findall(self.normalise(b" ".join(words).decode()))
        ids: dict[str, bytes] = {}
        new: dict[int, list[tuple[str, bytes]]] = {}
        for token in set(tokens) - {" "}:
            piece = token.encode()
            known = self.pieces.get(piece) or self.pieces.old.get(piece)
            if known is None:
                new.setdefault(len(piece), []).append((token, piece))
            else:
                ids[token] = known
        for size, own in new.items():
            pieces = [piece for _, piece in own]
            if len(own) < WORTH or size > LONGEST:
                ids.update((token, self.piece(piece)) for token, piece in own)
                continue
            for (token, piece), found in zip(own, self.merged(pieces), strict=True):
                ids[token] = self.pieces.put(piece, found)
        own, which = [], iter(words)
        for token in tokens:
            if token == " ":
                self.words.put(next(which), b"".join(own))
                own = []
            else:
                own.append(ids[token])
        self.words.put(next(which), b"".join(own))

    def blocks(self, texts: Iterator[bytes]) -> Iterator[list[bytes]]:
        """The texts in order, a few at a time, after their new words were learnt. A text of more than a chunk brings none."""
        block, new, size = [], set(), 0
        for text in texts:
            block.append(text)
            size += len(text)
            if len(text) <= CHUNK:
                known, old = self.words, self.words.old
                new.update(word for word in set(text.split()) if word not in known and word not in old)
            if len(new) >= NEW_WORDS or size >= NEW_BYTES:
                self.learn([*new])
                yield block
                block, new, size = [], set(), 0
        self.learn([*new])
        yield block

    def piece(self, piece: bytes) -> bytes:
        """The packed ids of one piece between splits, through the transducer."""
        known = self.pieces.get(piece) or self.pieces.old.get(piece)
        if known is None:
            transducer = Transducer(self)
            known = packed(transducer.feed(piece) + transducer.close())
        return self.pieces.put(piece, known) if len(piece) <= LONGEST and piece not in self.pieces else known

    def word(self, word: str) -> bytes:
        """The packed ids of a stretch of text: special entries are found in it as it stands, the rest is normalised."""
        out: list[bytes] = []
        for part in self.specials.split(word) if "<|" in word else (word,):
            if part in self.special:
                out.append(packed([self.special[part]]))
            else:
                out += [self.piece(piece.encode()) for piece in self.split(self.normalise(part))]
        return b"".join(out)

    def split(self, text: str) -> Iterator[str]:
        """What the vocabulary's pattern finds. Beyond LATEST the classes are those of unicodedata: the pattern engine
        at hand knows letters that the vocabulary's own engine does not."""
        if not text or max(text) < LATEST:
            yield from self.splitter.findall(text)
            return
        runs = itertools.groupby(text, key=kind)
        held = ""
        for which, run in runs:
            piece = "".join(run)
            if which == "o" and piece.endswith("'"):
                held = piece
                continue
            if held:
                suffix = next((x for x in CONTRACTIONS if which == "l" and piece.startswith(x)), "") if held[0] == "'" and len(held) == 1 else ""
                yield held + suffix
                piece, held = piece[len(suffix) :], ""
            if which == "n":
                yield from piece
            elif which != "s" and piece:
                yield piece
        if held:
            yield held


class Transducer:
    """Bytes of one piece in, stable ids out; close() ends the piece. It holds BLOCK bytes and the lookahead at most."""

    def __init__(self, vocabulary: Vocabulary, block: int = BLOCK) -> None:
        self.vocabulary, self.block, self.held = vocabulary, block, bytearray()

    def feed(self, data: bytes) -> list[int]:
        v, out = self.vocabulary, []
        for start in range(0, len(data), self.block):
            self.held += data[start : start + self.block]
            if len(self.held) < self.block + v.lookahead + 1:
                continue
            stable, done = len(self.held) - v.lookahead - 1, 0
            for number in v.merge([*map(v.inner.__getitem__, self.held)]):
                if done + v.width[number] > stable:
                    break
                done += v.width[number]
                out.append(number)
            del self.held[:done]
        return out

    def close(self) -> list[int]:
        v, held = self.vocabulary, self.held
        if not held:
            return []
        symbols = [*map(v.inner.__getitem__, held)]
        symbols[-1] = v.final[held[-1]]
        held.clear()
        return v.merge(symbols)


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    return array("I", ids).tobytes()


class Encoder:
    """A document's text in, in chunks that may end anywhere; packed ids out as soon as they are stable."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.held = vocabulary, b""
        self.open: Transducer | None = None  # the piece of letters in which a long word was cut
        self.searched = 0  # bytes of what is held in which there is no place to cut

    def feed(self, data: bytes) -> bytes:
        data = self.held + data
        words = data.split()  # at [\x20\x09-\x0D]+
        self.held = words.pop() if words and data[-1] not in b" \t\n\x0b\x0c\r" else b""
        if words or not self.held:
            self.searched = 0  # another word is held now
        out = []
        if self.open and words:
            out.append(self.finished(words.pop(0)))
        known, old, v = self.vocabulary.words, self.vocabulary.words.old, self.vocabulary
        found = [*map(known.get, words)]
        for at in [at for at, ids in enumerate(found) if ids is None] if None in found else ():
            word = words[at]
            ids = known.get(word)  # an earlier one may have brought it
            if ids is None:
                ids = old.get(word)
                if ids is None:
                    ids = v.word(word.decode())
                if len(word) <= LONGEST:
                    known.put(word, ids)
                    old = known.old
            found[at] = ids
        out += found
        if len(self.held) > BLOCK:
            out.append(self.advanced())
        return b"".join(out)

    def advanced(self) -> bytes:
        """What of the unfinished word's beginning is stable: up to the last place where it may be cut. What was searched
        in vain isn't searched again, but for what a cut behind it looks back on."""
        low = max(self.searched - 4 * (self.vocabulary.longest_special + 4), 0)
        while low and self.held[low] & 0xC0 == 0x80:  # the middle of a character
            low -= 1
        text = self.held[low:].decode(errors="ignore")
        cut = cut_of(text, self.vocabulary.longest_special)
        if not cut:
            self.searched = len(self.held)
            return b""
        left = low + len(text[:cut].encode())
        first, self.held, self.searched = self.held[:left].decode(), self.held[left:], 0
        return self.through(first, False)

    def through(self, text: str, last: bool) -> bytes:
        """A stretch of a long word; the piece of letters at its end stays open unless it is the last stretch."""
        v, out = self.vocabulary, []
        pieces: list[bytes | int] = []
        for part in v.specials.split(text) if "<|" in text else (text,):
            pieces += [v.special[part]] if part in v.special else [piece.encode() for piece in v.split(v.normalise(part))]
        if self.open and pieces:
            first = pieces.pop(0)  # letters, since the word was cut between letters
            out.append(packed(self.open.feed(first)))
            if pieces or last:
                out.append(packed(self.open.close()))
                self.open = None
        elif self.open and last:
            out.append(packed(self.open.close()))
            self.open = None
        goes_on = not last and not self.open and pieces and not isinstance(pieces[-1], int) and kind(pieces[-1].decode()[0]) == "l"
        tail = pieces.pop() if goes_on else None
        out += [packed([piece]) if isinstance(piece, int) else v.piece(piece) for piece in pieces]
        if tail is not None:
            self.open = Transducer(v)
            out.append(packed(self.open.feed(tail)))
        return b"".join(out)

    def finished(self, word: bytes) -> bytes:
        return self.through(word.decode(), True)

    def close(self) -> bytes:
        word, self.held = self.held, b""
        return self.finished(word) if self.open else self.vocabulary.word(word.decode()) if word else b""


def cut_of(text: str, special: int) -> int:
    """The last place between two letters that neither compose nor belong to a contraction or a special entry, or between two
    digits, each of which is a piece; or 0."""
    for at in range(len(text) - 1, 2, -1):
        digits = text[at - 1].isascii() and text[at].isascii() and text[at - 1 : at + 1].isdigit()
        if not digits and not all(unicodedata.category(letter)[0] == "L" for letter in text[at - 3 : at + 1]):  # three letters before: no contraction
            continue
        if any(low <= ord(text[at]) <= high for low, high in JAMO) or "<|" in text[max(0, at - special) : at + 1]:
            continue
        return at
    return 0


class Decoder:
    """Ids in, the text that they make certain out."""

    def __init__(self, vocabulary: Vocabulary, mode: str = "pieces") -> None:
        self.vocabulary, self.mode, self.started = vocabulary, mode, False
        if mode == "text":
            self.bytes_of = {letter: byte for byte, letter in enumerate(byte_letters())}
            self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, number: int) -> str:
        entry = self.vocabulary.entries[number]
        if self.mode == "pieces":
            out = f" {entry}" if self.started else entry
            self.started = True
            return out
        if entry in self.vocabulary.special:
            return self.utf8.decode(b"", True) + entry
        ends = entry.endswith(self.vocabulary.end)
        data = bytes(self.bytes_of[letter] for letter in entry.removesuffix(self.vocabulary.end))
        return self.utf8.decode(data) + (self.utf8.decode(b"", True) + " " if ends else "")

    def feed_block(self, ids: array) -> bytes:
        """The same for a block of ids, in UTF-8."""
        if self.mode == "text" or not ids:
            return "".join(map(self.feed, ids)).encode()
        found = b" ".join(map(self.vocabulary.entry_bytes.__getitem__, ids))
        out = b" " + found if self.started else found
        self.started = True
        return out

    def close(self) -> str:
        return self.utf8.decode(b"", True) if self.mode == "text" else ""


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encoded_stream(text: bytes, v: Vocabulary, chunk: int = CHUNK) -> Iterator[array]:
    """The ids of a text, as the encoder gives them out chunk by chunk."""
    encoder = Encoder(v)
    for start in range(0, len(text), chunk):
        yield array("I", encoder.feed(text[start : start + chunk]))
    yield array("I", encoder.close())


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None, digests: bool = False) -> DataFrame:
    """doc_id with ids and decoded text, or with their count and digests, which are kept up as the ids come."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            counts, first, second = [], [], []
            values = (value.as_py() or b"" for value in batch.column(1).cast(pa.binary()))
            for text in itertools.chain.from_iterable(v.blocks(values)):
                decoder, n, ids_seen, text_seen = Decoder(v), 0, hashlib.sha256(), hashlib.sha256()
                ids, decoded = array("I"), []
                for some in encoded_stream(text, v):
                    found = decoder.feed_block(some)
                    if digests:
                        n += len(some)
                        ids_seen.update(some)
                        text_seen.update(found)
                    else:
                        ids += some
                        decoded.append(found)
                counts.append(n)
                first.append(ids_seen.hexdigest() if digests else ids.tolist())
                second.append(text_seen.hexdigest() if digests else b"".join(decoded).decode())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())] if digests else [batch.column(0), pa.array(first, pa.list_(pa.int32())), pa.array(second, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in (SCHEMA if digests else FULL_SCHEMA).split(", ")])
        v.forget()

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(run, SCHEMA if digests else FULL_SCHEMA)


def encoded_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: a small table, which is stored so that batches of texts are small
    while it is made."""
    return stored(encode_documents(docs, path, digests=True), "encoded")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(read(spark, sf_dir, "documents"))
