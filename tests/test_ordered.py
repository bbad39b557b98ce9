"""Scans over ranges against plain windows, for keys that hold all rows, nulls, ties and empty frames."""

import random

import pytest
from pyspark.sql import functions as F

from agrolith.operators import aggregates, ordered

SCHEMA = "k string, o int, i int, v double, w int"


def frame(spark, n=300, keys=("a", "a", "a", "b", None)):
    rng = random.Random(n)
    rows = [(rng.choice(keys), rng.randrange(40), i, None if rng.random() < 0.2 else float(rng.randrange(100)), rng.randrange(3)) for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def by_key(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(row[0], []).append(row)
    return out


ORDER = ["o", "i"]


@pytest.mark.parametrize("n", [0, 1, 7, 300])
def test_numbers(spark, n):
    rows, df = frame(spark, n)
    got = {(r.i): (r.place, r.n) for r in ordered.numbered(df, ["k"], *ORDER, total="n").collect()}
    want = {r[2]: (at, len(own)) for own in by_key(rows).values() for at, r in enumerate(own)}
    assert got == want
    assert [r.n for r in ordered.placed(df, "n", *ORDER).orderBy("n").collect()] == list(range(1, n + 1))


@pytest.mark.parametrize("few", [0, 100_000])
def test_scans(spark, monkeypatch, few):
    monkeypatch.setattr(ordered, "BROADCAST_ROWS", few)
    rows, df = frame(spark)
    sums = ordered.running_sums(df, ["k"], ORDER, {"s": F.col("v"), "c": F.lit(1)})
    assert sums.columns == [*df.columns, "s", "c"]
    known = ordered.last_known(df, ["k"], ORDER, "v", "known")
    before = ordered.previous(df, ["k"], ORDER, {"pv": "v", "pw": "w"})
    got = {r.i: (r.s, r.c) for r in sums.collect()}
    got_known, got_before = {r.i: r.known for r in known.collect()}, {r.i: (r.pv, r.pw) for r in before.collect()}
    for own in by_key(rows).values():
        total, last, prior = None, None, (None, None)
        for at, (_, _, i, v, w) in enumerate(own):
            total = total if v is None else v + (total or 0)
            last = last if v is None else v
            assert got[i] == (total, at + 1) and got_known[i] == last and got_before[i] == prior
            prior = (v, w)


def test_clusters_equal_windows(spark):
    rows, df = frame(spark, 200)
    df = df.where("v IS NOT NULL").withColumn("v", F.col("v") + F.col("i") / 1000)
    for k in (1, 2, 5):
        one = ordered.split_at_gaps(df, ["k"], "v", k).select("i", "cluster").collect()
        two = aggregates.split_at_gaps(df, ["k"], "v", k).select("i", "cluster").collect()
        assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    keys = df.where("k IS NOT NULL")
    one, two = ordered.largest_stretch(keys, ["k"], "v", 1.5), aggregates.largest_cluster(keys, ["k"], "v", 1.5)
    assert one.columns == two.columns and sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert {r.k for r in ordered.largest_stretch(df, ["k"], "v", 1.5).collect()} == {"a", "b", None}


def test_a_key_lies_in_many_ranges(spark):
    df = spark.range(4000).select(F.lit("one").alias("k"), "id")
    held = ordered.dealt(df, F.col("k").asc(), F.col("id").asc()).groupBy(ordered.RANGE).count().collect()
    assert len(held) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in held) < 2000


def test_numbers_stay_when_cached_blocks_are_lost(spark):
    """Both passes read the stored ranges, so dropping what is held in memory between them changes nothing."""
    df = spark.range(2000).withColumn("x", F.hash("id") % 50).persist()
    placed = ordered.placed(df, "n", "x", "id")
    first = {r.id: r.n for r in placed.collect()}
    df.unpersist(blocking=True)
    spark.catalog.clearCache()
    assert {r.id: r.n for r in placed.collect()} == first
    assert "InMemoryRelation" not in placed._jdf.queryExecution().optimizedPlan().toString()


def test_empty(spark):
    _, df = frame(spark, 0)
    assert ordered.running_sums(df, [], ORDER, {"s": F.col("v")}).count() == 0
    assert ordered.previous(df, ["k"], ORDER, {"p": "v"}).count() == 0
    assert ordered.split_at_gaps(df, [], "v", 3).count() == 0 and ordered.largest_stretch(df, ["k"], "v", 1.0).count() == 0
