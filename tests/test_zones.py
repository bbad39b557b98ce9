"""Touched pixels against every pixel and edge."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from agrolith.operators import sketches, zones
from agrolith.plans import registry, scale

POINTS = "area string, rings array<array<struct<x: double, y: double>>>"


def frame(spark, areas):
    return spark.createDataFrame([(name, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for name, rings in areas.items()], POINTS)


def meets(a, b, x, y, s):
    """Whether a segment meets a closed square."""
    low, high = 0.0, 1.0
    for p, q, lo in ((a[0], b[0], x), (a[1], b[1], y)):
        if p == q:
            if not lo <= p <= lo + s:
                return False
            continue
        one, two = sorted(((lo - p) / (q - p), (lo + s - p) / (q - p)))
        low, high = max(low, one), min(high, two)
    return low <= high


def by_hand(rings, s, n, touched=True):
    out = set()
    sides = [(a, b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
    for i in range(-n, n):
        for j in range(-n, n):
            x, y = (i + 0.5) * s, (j + 0.5) * s
            odd = sum((a[1] > y) != (b[1] > y) and x < a[0] + (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) for a, b in sides) % 2
            if odd or touched and any(meets(a, b, i * s, j * s, s) for a, b in sides):
                out.add((i, j))
    return out


@pytest.mark.parametrize("block", [1, 64])
@pytest.mark.parametrize("touched", [True, False])
def test_touched_pixels(spark, monkeypatch, block, touched):
    monkeypatch.setattr(zones, "BLOCK", block)
    rng = random.Random(block)
    point = lambda: (rng.uniform(-9, 9), rng.uniform(-9, 9))
    areas = {f"a{n}": [[point() for _ in range(rng.randint(2, 7))] for _ in range(rng.randint(1, 3))] for n in range(12)}
    areas |= {"thin": [[(0.1, 0.1), (8.3, 0.2), (8.3, 0.3)]], "flat": [[(1.1, 2.2), (7.3, 2.2), (7.3, 4.9), (1.1, 4.9)]], "hole": [[(-8.1, -8.2), (8.3, -8.4), (8.5, 8.6), (-8.7, 8.8)], [(-3.1, -3.2), (3.3, -3.4), (3.5, 3.6), (-3.7, 3.8)]]}
    n, s = 16, 0.7
    pixels = spark.createDataFrame([(i, j) for i in range(-n, n) for j in range(-n, n)], "i long, j long")
    got = {}
    rows = zones.touching(pixels, frame(spark, areas), s, touched=touched).collect()
    for row in rows:
        got.setdefault(row.area, set()).add((row.i, row.j))
    assert len(rows) == sum(map(len, got.values()))  # each pixel once
    assert got == {name: want for name, rings in areas.items() if (want := by_hand(rings, s, n, touched))}


def test_spans_are_few(spark):
    """A wide area is as many spans as rows, whatever the number of its pixels."""
    areas = frame(spark, {"wide": [[(0.1, 0.1), (99_999.9, 0.2), (99_999.8, 9.7), (0.2, 9.9)]]})
    assert zones.spans(areas, 1.0).count() == 10


def test_odd_rows(spark):
    areas = spark.createDataFrame([("none", None), ("empty", []), ("point", [[{"x": 1.0, "y": 1.0}]]), ("null", [[None, {"x": 0.2, "y": None}, {"x": 0.5, "y": 0.5}, {"x": 0.6, "y": 0.7}]])], POINTS)
    pixels = spark.createDataFrame([(0, 0, 1.0), (0, 0, 3.0), (0, 0, None), (None, 0, 5.0), (5, 5, 1.0)], "i long, j long, v double")
    assert [tuple(r) for r in zones.zonal(pixels, areas, 1.0, "v").collect()] == [("null", 2, 2.0)]
    assert zones.zonal(pixels.limit(0), areas, 1.0, "v").count() == 0


def test_sketches_add_up(spark):
    rows = spark.range(30_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 9001).alias("who"))
    daily = sketches.added(sketches.kept(rows.where("id % 2 = 0"), ["day"], "who"), sketches.kept(rows.where("id % 2 = 1"), ["day"], "who"), ["day"])
    ranges = spark.createDataFrame([(0, 0), (0, 3), (2, 6), (9, 10)], "low long, high long")
    got = {(r.low, r.high): r for r in sketches.over_ranges(daily, "day", ranges).collect()}
    assert set(got) == {(0, 0), (0, 3), (2, 6)}
    for (low, high), row in got.items():
        own = rows.where(F.col("day").between(low, high))
        exact = own.select("who").distinct().count()
        assert row.rows == own.count() and abs(row.distinct - exact) <= max(row.error, 0) + 1e-9
    assert got[0, 0].error > 0 or got[0, 0].distinct <= 4096


def test_exact_counts_add_up(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("day"), F.when(F.col("id") % 11 > 0, F.col("id") % 20_011).alias("who"))
    daily = sketches.added_members(sketches.members(rows.where("id % 2 = 0"), ["day"], "who"), sketches.members(rows.where("id % 2 = 1"), ["day"], "who"), ["day"], "who")
    ranges = spark.createDataFrame([(0, 0), (0, 3), (2, 6), (9, 10)], "low long, high long")
    got = {(r.low, r.high): (r.rows, r.distinct) for r in sketches.counted_over_ranges(daily, "day", ranges, "who").collect()}
    assert set(got) == {(0, 0), (0, 3), (2, 6)}
    for (low, high), found in got.items():
        own = rows.where(F.col("day").between(low, high))
        assert found == (own.count(), own.agg(F.count_distinct("who")).first()[0])


def test_many_users_by_ranges(spark, tmp_path):
    """Beyond what a sketch lists, the query counts as its SQL does."""
    events = spark.range(40_000).select(F.col("id").alias("event_id"), F.timestamp_seconds(1704067200 + F.col("id") * 60).cast("timestamp_ntz").alias("ts"), (F.col("id") * 7919 % 9973).alias("user_id"), F.lit("view").alias("event_type"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.sql(registry.ORACLES["distinct_by_ranges"]).fetchall()
    got = scale.distinct_by_ranges(spark, str(tmp_path)).select("low", "high", "event_type", "rows", "users").collect()
    assert sorted(map(tuple, got)) == sorted(want)
