"""HyperMinHash near duplicates against all pairs of sets."""

from collections import Counter

import numpy as np
import pytest

from agrolith.llm import components, hyperminhash
from tests.llm.test_dedup import classes


def found(docs, *options):
    rows = hyperminhash.NearDuplicates(docs, *options).classes().collect()
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in rows)
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)


@pytest.mark.parametrize(("words", "percent"), [(5, 85), (3, 90), (1, 80)])
def test_near_duplicates(stored_docs, plain, words, percent):
    assert found(stored_docs, words, percent) == classes(plain, percent, words)


def test_in_rounds(stored_docs, plain, monkeypatch):
    monkeypatch.setattr(components, "MANY", 0)
    monkeypatch.setattr(components, "DEALT", 3)
    assert found(stored_docs, 3, 80) == classes(plain, 80, 3)


def chain(rng, groups, sizes, changes):
    """Groups of texts whose members differ from their base by so many words."""
    rows = []
    for group in range(groups):
        base = [f"g{group}w{i}" for i in range(int(rng.choice(sizes)))]
        for _ in range(6):
            own = list(base)
            for place in rng.choice(len(own), min(changes, len(own)), replace=False):
                own[place] = f"x{rng.integers(1 << 40)}"
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("sizes", [[6, 8, 12, 20], [40, 90, 200], [400, 900]])
def test_links_at_the_bound(spark, sizes):
    """Sets of all sizes, with few or many empty buckets, whose similarities lie around the bound; none may be lost."""
    rng = np.random.default_rng(sizes[0])
    rows = [row for changes in (1, 2, 3) for row in chain(rng, 25, sizes, changes)]
    rows = [(at, text) for at, (_, text) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found(docs, 1, 85) == classes(rows, 85, 1)


def test_nothing(empty):
    assert hyperminhash.NearDuplicates(empty).classes().count() == 0


def test_similarities_out_of_reach(empty):
    with pytest.raises(ValueError, match="too often"):
        hyperminhash.NearDuplicates(empty, 5, 50)


def random_sets(rng, both, one, two):
    names = np.unique(rng.integers(0, 1 << 63, 3 * (both + one + two), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    rng.shuffle(names)
    shared = names[:both]
    return np.sort(np.concatenate([shared, names[both : both + one]])), np.sort(np.concatenate([shared, names[both + one : both + one + two]]))


@pytest.mark.parametrize(("both", "one", "two"), [(850, 75, 75), (500, 500, 0), (0, 300, 3000), (17, 1, 2)])
def test_estimates(both, one, two):
    """Estimates agree with similarities on average."""
    rng = np.random.default_rng(both + one)
    values = []
    for _ in range(200):
        a, b = random_sets(rng, both, one, two)
        registers, _ = hyperminhash.sketches([a, b])
        equal = np.array([(registers[0] == registers[1]).mean()])
        values.append(hyperminhash.estimate(equal, np.array([len(a)]), np.array([len(b)]))[0])
    assert abs(np.mean(values) - both / (both + one + two)) < 0.015


def test_chance_of_agreeing():
    """Registers of sets without a common member agree as often as said, measured with a short mantissa."""
    rng = np.random.default_rng(5)
    equal = []
    for _ in range(300):
        a, b = random_sets(rng, 0, 2000, 1000)
        one, two = hyperminhash.sketches([a, b])[0]
        equal.append(((one >> 7) == (two >> 7)).mean())  # three bits of the mantissa are left
    wanted = hyperminhash.by_chance(np.array([2000]), np.array([1000]))[0] * (1 << 7)
    assert abs(np.mean(equal) - wanted) < 0.2 * wanted


def test_registers():
    minima = np.array([1 << 63, (1 << 63) + (1 << 62), 1 << 40, 0], np.uint64)
    assert hyperminhash.compressed(minima).tolist() == [0, 512, 23 << 10, 62 << 10]
    for width in range(hyperminhash.REGISTERS):  # every empty bucket finds a filled one, wherever that is
        seen = {int(hyperminhash.borrowed(step, np.array([width]))[0]) for step in range(2 * hyperminhash.REGISTERS)}
        assert seen == set(range(hyperminhash.REGISTERS))


def test_missed():
    assert hyperminhash.missed(85) < 1e-10 < hyperminhash.missed(50)
