"""Importance resampling against words, CRCs and draws made one by one."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from agrolith.llm import resampling

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, grams):
    """(words, features) of a text, as bytes."""
    words = WORD.findall((text or "").encode().lower())
    return words, [b" ".join(words[at : at + width]) for width in range(1, grams + 1) for at in range(len(words) - width + 1)]


def by_hand(rows, target, grams=1, buckets=10_000, least=20, percent=10, seed=2024):
    bucket = lambda feature: zlib.crc32(feature) % buckets
    own = [[bucket(x) for x in runs(text, grams)[1]] for _, text in rows]
    s, t = Counter(x for held in own for x in held), Counter(bucket(x) for text in target for x in runs(text, grams)[1])
    total, wanted = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (wanted + buckets))))
    out = []
    for (doc_id, text), held in zip(rows, own, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, held)) // len(held) if held else 0
        out.append([doc_id, len(held), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(runs(text, grams)[0])])
    fit = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for place, x in enumerate(fit[: percent * len(fit) // 100]):
        x[4] = place + 1
    return sorted(map(tuple, out), key=repr)


TARGET = ["the of and to in that", None, "", "ing tion ent the re", "CHANGED same SAME Ünï"]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(at, text) for at, text in enumerate(TARGET)], "item_id int, text string")


@pytest.mark.parametrize("options", [{}, {"grams": 3, "buckets": 501, "least": 2, "percent": 37, "seed": 5}])
def test_resampling(spark, stored_docs, plain, target, options):
    got = resampling.resampled(stored_docs, target, **options)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == by_hand(plain, TARGET, **options)
    assert any(row[4] for row in rows)


@pytest.mark.parametrize("grams", [1, 3])
@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_features_at_any_cut(monkeypatch, grams, chunk):
    """Buckets by text, whatever the stretches, for words beyond the joint steps and texts that touch each other."""
    monkeypatch.setattr(resampling, "CHUNK", chunk)
    rng = random.Random(grams)
    texts = ["".join(rng.choice("abZ09 .-é𝕏\n") for _ in range(rng.randrange(60))) for _ in range(40)]
    texts += ["x" * 64, "y" * 65, "z" * 1000 + " end", None, "", "joined", "words", "É" * 200]
    array = pa.array(texts, pa.string())
    for part in (array, array.slice(5, 38), array.slice(0, 0), array.slice(43, 2)):
        got = [Counter() for _ in part]
        for _, owners, found in resampling.features(part, grams, 1 << 31):
            for owner, bucket in zip(owners.tolist(), found.tolist(), strict=True):
                got[owner][bucket] += 1
        assert got == [Counter(zlib.crc32(x) % (1 << 31) for x in runs(text, grams)[1]) for text in part.to_pylist()]


def test_table():
    data = bytes(range(256)) * 2
    folded = np.frombuffer(data, np.uint8)
    starts, sizes = np.array([0, 3, 100, 7]), np.array([1, 64, 65, 0])
    states = resampling.advanced(np.full(4, 0xFFFFFFFF, np.uint32), folded, starts, sizes) ^ np.uint32(0xFFFFFFFF)
    assert states.tolist() == [zlib.crc32(data[a : a + n]) for a, n in zip(starts, sizes, strict=True)]


def test_nothing(spark, empty, stored_docs, plain, target):
    assert resampling.resampled(empty, target).count() == 0
    rows = sorted(map(tuple, resampling.resampled(stored_docs, target.limit(0)).collect()), key=repr)
    assert rows == by_hand(plain, [])


def test_drawn_documents(stored_docs, target):
    drawn = resampling.drawn_documents(stored_docs, target)
    assert drawn.columns == stored_docs.columns
    ranks = resampling.resampled(stored_docs, target).where("rank is not null")
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in ranks.collect() if r.doc_id is not None}


def test_draws_follow_the_target(spark):
    """Documents of the target's words are drawn far beyond their share."""
    rng = random.Random(1)
    near, far = [f"near{i}" for i in range(40)], [f"far{i}" for i in range(400)]
    rows = [(at, " ".join(rng.choice(near if at % 10 == 0 else far) for _ in range(50))) for at in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = spark.createDataFrame([(" ".join(near * 20),)], "text string")
    drawn = [r.doc_id for r in resampling.resampled(docs, wanted).where("rank is not null").collect()]
    assert len(drawn) == 100 and sum(x % 10 == 0 for x in drawn) > 60
