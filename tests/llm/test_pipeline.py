"""The pipeline against a plain version of each of its stages, and the queries that have SQL."""

import hashlib
import random
import struct

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from agrolith.llm import bpe, mixing, registry, toxicity
from agrolith.llm.common import read

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, agrolith_row int, slice double"


def plain_rows():
    """Texts with nulls, exact copies with ties, near copies, a repeated row, a repeated and a missing doc_id, a very long
    text, and columns of clashing names."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    texts = [" ".join(word() for _ in range(rng.randint(8, 90))) + "." for _ in range(70)]
    texts += [texts[3], texts[3].upper(), texts[4], None, None, "", "  \n ", "one", " ".join(word() for _ in range(20_000))]
    for at in range(10, 20):
        own = texts[at].split()
        own[len(own) // 2] = "changed"
        texts += [" ".join(own)] * 2
    texts += [f"you {word()} zork {word()} flumpish. " + t for t in texts[20:40]]
    rows = [(at, t, "en", f"s{at % 3}", len(t or ""), "r", at, 0.5) for at, t in enumerate(texts)]
    rows += [rows[5], (7, "another text of the same number " + word(), None, None, None, None, None, None), (None, "no number " + word(), None, None, None, None, None, None)]
    labels = [(at, int(at % 4 != 1), int("zork" in (t or ""))) for at, t in enumerate(texts) if at % 5 != 2] + [(None, 1, 0), (3, None, None)]
    return rows, labels


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rows, labels = plain_rows()
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def key(row):
    return tuple((v is None, v or 0) for v in row)


def kept_after(spark, made, number, docs):
    """What a stage keeps of docs, and the same by hand, as sorted rows."""
    name, stage = corpus_pipeline.STAGES[number]
    out = stage(spark, docs, made)
    assert out.columns == docs.columns, name
    return sorted(map(tuple, out.collect()), key=key)


def by_hand_toxicity(spark, made, rows):
    model = toxicity.fit_labelled(read(spark, made, "documents"), read(spark, made, "labels"))
    return [r for r in rows if model.score(r.text) < toxicity.THRESHOLD]


def by_hand_exact(rows):
    best = {}
    for r in rows:
        own = (r.text or "").encode().lower()
        if own not in best or (best[own].doc_id is not None, best[own].doc_id or 0) < (r.doc_id is not None, r.doc_id or 0):
            best[own] = r
    return list(best.values())


def by_hand_jaccard(rows):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets, parent = [shingles(r.text) for r in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    best = {}
    for at, r in enumerate(rows):
        own = (r.doc_id is None, r.doc_id or 0)
        if find(at) not in best or own < best[find(at)][0]:
            best[find(at)] = (own, r)
    return [r for _, r in best.values()]


def test_stages_by_hand(spark, made, tmp_path):
    docs = read(spark, made, "documents")
    steps = [lambda rows: by_hand_toxicity(spark, made, rows), by_hand_exact, by_hand_jaccard]
    for number, by_hand in enumerate(steps):
        before = docs.collect()
        expected = by_hand(before)
        assert 0 < len(expected) < len(before)
        got = kept_after(spark, made, number, docs)
        if number == 1:  # of rows with equal text and doc_id any one may stay
            assert [(r[0], (r[1] or "").lower()) for r in got] == [(r[0], (r[1] or "").lower()) for r in sorted(map(tuple, expected), key=key)]
        else:
            assert got == sorted(map(tuple, expected), key=key)
        spark.createDataFrame(got, SCHEMA).repartition(2).write.parquet(str(tmp_path / f"{number}"))
        docs = spark.read.parquet(str(tmp_path / f"{number}"))
    # mixing: rates in [0, 1] nearest to one under the reachable shares, by projected gradient; fractions by the hash
    table, domains = mixing.posteriors(docs, read(spark, made, "labels"))
    found = table.withColumn("part", F.pmod(F.xxhash64("doc_id", "row", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)).collect()
    p, n = np.array([r.p for r in found]), np.array([r.tokens for r in found], float)
    shares = np.array([mixing.TARGETS[d] for d in domains])
    asked = np.minimum(n.sum() * shares / shares.sum(), n @ p)
    asked /= asked.sum()
    free = np.linalg.svd(asked[None])[2][1:].T
    y, least = np.zeros(len(domains) - 1), np.inf
    for _ in range(200_000):
        rate = np.clip(1 + p @ (free @ y), 0, 1)
        slope = free.T @ (p.T @ (rate * n)) / n.sum()
        least = min(least, np.abs(slope).max())
        y -= 0.5 * slope
    assert least < 1e-7
    rate = np.clip(1 + p @ (free @ y), 0, 1)
    kept = corpus_pipeline.STAGES[3][1](spark, docs, made)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    whole = {r.row: d for r, d in zip(sorted(found, key=lambda r: r.row), docs.collect(), strict=True)}
    sure = [(whole[r.row], x + r.part >= 1) for r, x in zip(found, rate, strict=True) if abs(x + r.part - 1) > 1e-4]
    for d, stays in sure:
        assert ((d.doc_id is None, d.doc_id or 0, d.text or "") in ids) == stays
    assert len(ids) < docs.count() and len(sure) >= docs.count() - 3
    # encoding, by the library
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    expected = []
    for r in docs.collect():
        own = library.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(own), hashlib.sha256(struct.pack(f"<{len(own)}I", *own)).hexdigest(), hashlib.sha256(library.decode(own, skip_special_tokens=False).encode()).hexdigest()))
    got = corpus_pipeline.STAGES[4][1](spark, docs, made)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("number", range(5))
def test_stages_of_nothing(spark, made, tmp_path, number):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "none"))
    out = corpus_pipeline.STAGES[number][1](spark, spark.read.parquet(str(tmp_path / "none")), made)
    assert out.count() == 0


def test_stages_without_labels(spark, made, tmp_path):
    docs = read(spark, made, "documents")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for number in (0, 3):
        assert corpus_pipeline.STAGES[number][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_run(spark, made):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert corpus_pipeline.run(spark, made).count() > 0


@pytest.mark.parametrize("name", registry.ORACLES)
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = registry.QUERIES[name](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    expected = con.sql(registry.ORACLES[name]).df().sort_values("doc_id").reset_index(drop=True)
    got, expected = got[expected.columns.tolist()].convert_dtypes(), expected.convert_dtypes()  # numbers beside nulls alike
    assert got.equals(expected)
