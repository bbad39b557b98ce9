"""The dataset manifest against trees built by hand."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from agrolith.llm import manifest


def hashed(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return hashed([field(row.doc_id), field(row.source), field(row.lang), field(row.n_chars), field(text)])


def tree_of(leaves):
    """The root, and for each leaf its siblings (left, right) by level."""
    paths, own, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for path, at in zip(paths, own, strict=True):
            path.append(("".join(nodes[at // 8 * 8 : at]), "".join(nodes[at + 1 : at // 8 * 8 + 8])))
        own, nodes = [at // 8 for at in own], [hashed(nodes[run : run + 8]) for run in range(0, len(nodes), 8)]
    return nodes[0], paths


def by_hand(rows):
    languages = {}
    for row in rows:
        languages.setdefault(row.lang, []).append(row)
    names = sorted(languages, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        languages[name].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees[name] = tree_of([leaf_of(r, r.text) for r in languages[name]])
    root, tops = tree_of([trees[name][0] for name in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        for row, path in zip(languages[name], trees[name][1], strict=True):
            leaf = now = leaf_of(row, row.text)
            if zlib.crc32(str("" if row.doc_id is None else row.doc_id).encode()) % 3 == 0 and row.text is not None:
                now = leaf_of(row, row.text.encode().lower().decode())
            for left, right in path + top:
                now = hashed([left, now, right])
            proof = hashed([side for pair in path + top for side in pair])
            out.append((row.doc_id, leaf, trees[name][0], root, proof, now, now == root))
    return sorted(out, key=repr)


def run(spark, path):
    got = manifest.op11_manifest(spark, str(path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_manifest(spark, stored_docs):
    folder = stored_docs.inputFiles()[0].rsplit("/documents.parquet", 1)[0]
    assert run(spark, folder) == by_hand(stored_docs.collect())


@pytest.mark.parametrize("sizes", [[1], [9], [8, 64, 65, 1, 513, 7, 2, 3, 600, 4]])
@pytest.mark.parametrize("parts", [1, 7])
def test_sizes_of_trees(spark, tmp_path, monkeypatch, sizes, parts):
    """Lone leaves, runs of one, more languages than the fanout, trees of one and two strides, over one or several ranges."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows, number = [], 0
    for at, n in enumerate(sizes):
        for _ in range(n):
            rows.append((number, f"Text {number % 50}", f"l{at}" if at else None, None, number))
            number += 1
    rows += rows[-1:] * 3
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert run(spark, tmp_path) == by_hand(docs.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_nothing(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert run(spark, tmp_path) == []


@pytest.mark.parametrize("total", [1, 8, 9, 70, 520])
def test_stack_at_any_cut(total):
    """Pieces of a tree, cut anywhere, hold every node or the edges from which it follows; edges are few."""
    leaves = [hashed([str(at)]) for at in range(total)]
    root, _ = tree_of(leaves)
    rng = random.Random(total)
    for _ in range(20):
        cuts = sorted({0, total, *(rng.randrange(total + 1) for _ in range(3))})
        found = {}
        for low, high in zip(cuts, cuts[1:], strict=False):
            batch = pa.RecordBatch.from_pydict({"tree": ["t"] * (high - low), "total": [total] * (high - low), "at": list(range(low, high)), "digest": leaves[low:high]})
            rows = [tuple(row.values()) for out in manifest.stacked(iter([batch])) for row in out.to_pylist()]
            edges = [row for row in rows if row[5] == manifest.EDGE]
            assert len(edges) <= 2 * 7 * 4
            found |= {(row[2], row[3]): row[4] for row in rows}
        level, nodes = 0, leaves
        while len(nodes) > 1:
            nodes, level = [hashed(nodes[run : run + 8]) for run in range(0, len(nodes), 8)], level + 1
            for at, digest in enumerate(nodes):
                assert found.get((level, at), digest) == digest
        assert nodes == [root]


def test_a_missing_leaf_stops_the_proofs():
    members = pa.table({"at": [0, 2], "total": [3, 3], "digest": ["a", "b"]})
    with pytest.raises(ValueError, match="lacks nodes"):
        manifest.climbed(members, pa.table({"left": [[]], "right": [[]]}), 0)
