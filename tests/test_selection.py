"""Exact quantiles against numpy, whatever the distribution, and the bounds on what a task holds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from agrolith.operators import selection

SHARES = {"a": 0.0, "b": 0.1, "c": 1 / 3, "d": 0.5, "e": 0.9, "f": 1.0}


def check(spark, groups):
    rows = [(key, float(v)) for key, values in groups.items() for v in values]
    df = spark.createDataFrame([*rows, (None, 5.0), ("null", None)], "k string, v double").repartition(4)
    got = {r.k: r for r in selection.quantiles(df, ["k"], "v", SHARES, {"up": lambda n: F.floor(n / 2)}).collect()}
    assert set(got) == {*groups, None, "null"} and got["null"].n == 0 and got["null"].d is None and got[None].d == 5.0
    for key, values in groups.items():
        own = np.sort(np.array(values, float))
        assert got[key].n == len(own) and got[key].up == own[len(own) // 2]
        for name, share in SHARES.items():
            assert got[key][name] == pytest.approx(np.quantile(own, share), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("small", [1, 10, 4096])
def test_quantiles(spark, monkeypatch, small):
    monkeypatch.setattr(selection, "SMALL", small)
    monkeypatch.setattr(selection, "BINS", 8)
    rng = np.random.default_rng(small)
    check(spark, {
        "even": rng.uniform(-5, 5, 400), "wide": np.exp(rng.normal(0, 60, 300)) * rng.choice([-1, 1], 300), "same": [7.25] * 50, "ties": rng.integers(0, 3, 200),
        "one": [3.0], "two": [1.0, 2.0], "tiny": [5e-324, 1e-300, 0.0, -5e-324, 1e300, -1e300], "near": 1 + np.arange(90) * 2.0**-52,
    })


@pytest.mark.parametrize("few", [0, 100_000])
def test_many_groups(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "BROADCAST_ROWS", few)
    monkeypatch.setattr(selection, "SMALL", 5)
    rng = np.random.default_rng(1)
    check(spark, {f"g{at}": rng.normal(at, 3, 1 + at % 17) for at in range(60)})


def test_no_bin_above_the_bound_is_gathered(spark, monkeypatch):
    """A group of all rows: what is sorted in one place has at most SMALL rows."""
    monkeypatch.setattr(selection, "SMALL", 16)
    seen = []
    inner = selection.within

    def spied(rows, open_, keys):
        out = inner(rows, open_, keys)
        seen.append([r["_n"] for r in open_.collect()])
        return out

    monkeypatch.setattr(selection, "within", spied)
    df = spark.range(20_000).select((F.col("id") * 0.37 % 991).alias("v"))
    got = selection.medians(df, [], "v").first()
    own = np.sort(np.arange(20_000) * 0.37 % 991)
    assert got["median"] == pytest.approx(np.median(own)) and got.n == 20_000
    assert len(seen) > 1 and max(seen[-1], default=0) <= 16


def test_summary(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", float("nan")), ("a", float("inf")), ("a", None), ("b", None)], "k string, v double")
    got = {r.k: r for r in selection.summary(df, ["k"], "v", "x_").collect()}
    assert got["a"].x_p50 == 2.0 and got["a"].x_mean == 2.0 and got["a"].x_n == 2 and got["b"].x_n == 0 and got["b"].x_p10 is None


def test_infinities_are_ranked(spark):
    df = spark.createDataFrame([(v,) for v in (float("-inf"), -1.0, 0.0, 2.0, float("inf"))], "v double")
    got = selection.quantiles(df, [], "v", {"least": 0.0, "mid": 0.5, "most": 1.0}).first()
    assert (got.least, got.mid, got.most) == (float("-inf"), 0.0, float("inf"))


def test_empty(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert selection.medians(df, ["k"], "v").count() == 0
    assert selection.medians(df, [], "v").collect() == [(None, 0)]
