"""Exact nearest neighbours by key, for keys with any share of the rows, without all pairs of a key.

First every state gets a bound on how far its k-th neighbour may be: the distances to some rows that stand near it on a
curve through the features (bits of all features in turn), within blocks of consecutive rows. Then distances to a few
pivots, corners of the key's box, are the coordinates of a grid: by the triangle inequality neighbours within a bound
lie within the same bound in each coordinate. A state looks into the cells of a grid whose cells are twice to four times
as wide as its own bound, 2 a pivot at most, since a state is written once a cell that it looks into; history is put
into the grids that states use. What lies within the bound is ranked, and stored, so that shuffles of cells can be let go
before states are told their neighbours.

Equal points are one: of history's equal points only the first k + 1 years can be among any state's k, and equal states
are searched once.

Defined results: rows with a feature that is null, NaN or infinite take no part; null keys meet nothing; a state's own year
is left out; ties go to the earlier year; a key with fewer rows gives fewer neighbours; history has one row a key and
year; repeated states are one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import stored
from .ordered import matched, numbered

#: Consecutive rows of the curve within which bounds are sought, pivots, and grids, each of half the width of the one before.
BLOCK, PIVOTS, LEVELS = 512, 3, 24
#: Bounds that a cell is wide, at least.
WIDE = 2


def distance(a: list[Column], b: list[Column]) -> Column:
    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(a, b, strict=True)), F.lit(0.0)))


def curve(features: list[str], low: list[str], span: str) -> Column:
    """A number that is near for near points: the bits of the features' places in the box, in turn."""
    bits = 60 // len(features)
    places = [F.least(F.floor((F.col(f) - F.col(a)) / F.col(span) * 2**bits), F.lit(2**bits - 1)).cast("long") for f, a in zip(features, low, strict=True)]
    ones = [F.shiftleft(F.shiftright(p, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(features) + at) for at, p in enumerate(places) for bit in range(bits)]
    return reduce(lambda x, y: x.bitwiseOR(y), ones)


def boxed(rows: DataFrame, on: list[str], f: list[str]) -> DataFrame:
    """keys, the least and greatest of each feature and the box's longest side."""
    box = rows.groupBy(*on).agg(*(F.min(c).alias(f"_lo{c}") for c in f), *(F.max(c).alias(f"_hi{c}") for c in f))
    sides = [F.col(f"_hi{c}") - F.col(f"_lo{c}") for c in f]
    longest = F.greatest(*sides) if len(f) > 1 else sides[0]
    return box.withColumn("_span", F.when(longest > 0, longest).otherwise(1.0))


def bounded(points: DataFrame, queries: DataFrame, on: list[str], f: list[str], k: int) -> DataFrame:
    """queries with _reach: the distance within which k points lie for certain; null where none is known."""
    both = points.select(*on, *f, "_box", F.lit(None).cast("long").alias("_q")).unionByName(queries.select(*on, *f, "_box", "_q"))
    coded = both.withColumns({f"_lo{c}": F.col(f"_box._lo{c}") for c in f}).withColumn("_span", F.col("_box._span"))
    coded = coded.withColumn("_z", curve(f, [f"_lo{c}" for c in f], "_span")).select(*on, *f, "_q", "_z").withColumn("_id", F.monotonically_increasing_id())
    placed = numbered(coded, on, "_z", "_id", name="_pos").withColumn("_block", F.floor(F.col("_pos") / BLOCK))
    around = W.partitionBy(*on, "_block").orderBy("_pos").rowsBetween(-2 * k, 2 * k)
    held = placed.withColumn("_near", F.collect_list(F.when(F.col("_q").isNull(), F.struct(*f))).over(around)).where("_q IS NOT NULL")
    found = F.array_sort(F.transform("_near", lambda p: distance([F.col(c) for c in f], [p[c] for c in f])))
    return queries.join(held.select("_q", F.get(found, F.lit(k - 1)).alias("_reach")), "_q")


def pivot_distances(f: list[str]) -> list[Column]:
    """Distances to the box's least corner and to corners next to it."""
    out = []
    for at in range(min(PIVOTS, len(f))):
        corner = [F.col(f"_box._hi{c}") if at and c == f[at - 1] else F.col(f"_box._lo{c}") for c in f]
        out.append(distance([F.col(c) for c in f], corner))
    return out


def width(span: Column) -> Column:
    return F.when(F.col("_level") < 0, F.lit(float("inf"))).otherwise(span * F.pow(F.lit(2.0), -F.col("_level")))


def cell(d: Column) -> Column:
    return F.floor(F.when(F.col("_level") < 0, F.lit(0.0)).otherwise(d / F.col("_w"))).cast("long")


def looked_into(queries: DataFrame, f: list[str]) -> DataFrame:
    """queries with the level of their grid, once a cell (_c0, _c1...) that they look into."""
    span, reach = F.col("_box._span"), F.col("_reach") * (1 + 1e-9) + 1e-12 * F.col("_box._span")
    finest = F.least(F.floor(F.log2(span / reach / WIDE)), F.lit(LEVELS))
    level = F.when(reach.isNull(), -1).otherwise(F.greatest(finest, F.lit(0))).cast("int")
    asked = queries.withColumn("_level", level).withColumn("_w", width(span))
    for at, d in enumerate(pivot_distances(f)):
        wide = F.coalesce(reach, F.lit(0.0))
        asked = asked.withColumn(f"_c{at}", F.explode(F.sequence(cell(d - wide), cell(d + wide))))
    return asked


def candidates(points: DataFrame, queries: DataFrame, on: list[str], f: list[str]) -> DataFrame:
    """Pairs (_q, _year, _distance) that share a cell, before their distance is looked at."""
    asked = looked_into(queries, f)
    pivots = pivot_distances(f)
    cells = [f"_c{at}" for at in range(len(pivots))]
    levels = stored(asked.select(*on, "_level").distinct(), "levels")
    put = points.join(levels, on).withColumn("_w", width(F.col("_box._span")))
    put = put.withColumns({name: cell(d) for name, d in zip(cells, pivots, strict=True)})
    there = put.select(*on, "_level", *cells, "_year", *(F.col(c).alias(f"{c}_") for c in f))
    met = asked.select("_q", *on, "_level", *cells, "_reach", *f).join(there, [*on, "_level", *cells])
    return met.select("_q", "_year", "_reach", distance([F.col(c) for c in f], [F.col(f"{c}_") for c in f]).alias("_distance"))


def nearest_years(history: DataFrame, states: DataFrame, on: list[str], features: list[str], k: int, year: str = "year") -> DataFrame:
    """on, year, analogue, distance, place: for each state the k nearest years of its keys other than its own."""
    f = [f"_f{at}" for at in range(len(features))]
    named = [F.col(c).cast("double").alias(n) for c, n in zip(features, f, strict=True)]
    whole = reduce(lambda x, y: x & y, (F.abs(c) < float("inf") for c in f))
    kept = lambda rows: rows.where(whole).dropna(subset=on)
    same = W.partitionBy(*on, *f).orderBy("_year")
    points = kept(history.select(*on, F.col(year).alias("_year"), *named)).withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).drop("_n")
    points = stored(points, "points")
    asked = kept(states.select(*on, F.col(year).alias("_own"), *named)).distinct()
    queries = stored(asked.select(*on, *f).distinct().withColumn("_q", F.monotonically_increasing_id()), "states")
    box = boxed(points.select(*on, *f).unionByName(queries.select(*on, *f)), on, f)
    box = stored(box.select(*on, F.struct(*(c for c in box.columns if c not in on)).alias("_box")), "boxes")
    points, queries = matched(points, box, on), matched(queries, box, on)
    queries = stored(bounded(points, queries, on, f, k + 1), "bounds")
    pairs = candidates(points, queries, on, f).where("_reach IS NULL OR _distance <= _reach")
    best = F.row_number().over(W.partitionBy("_q").orderBy("_distance", "_year"))
    found = stored(pairs.withColumn("_n", best).where(F.col("_n") <= k + 1).drop("_n", "_reach"), "nearest")
    told = asked.join(queries.select(*on, *f, "_q"), [*on, *f]).join(found, "_q").where(F.col("_own") != F.col("_year"))
    place = F.row_number().over(W.partitionBy(*on, "_own", *f).orderBy("_distance", "_year"))
    return told.withColumn("place", place).where(F.col("place") <= k).select(*on, F.col("_own").alias(year), F.col("_year").alias("analogue"), F.col("_distance").alias("distance"), "place")
