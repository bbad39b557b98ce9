"""Which pixels of a grid an area touches: pixels are squares, areas have any number of rings.

An area is a list of rings of (x, y) points, closed by themselves; a point is inside where a line to the right crosses an
odd number of edges, so rings within rings are holes and rings apart are further parts. A pixel (i, j) of size s is the
square from (i s, j s) to ((i + 1) s, (j + 1) s). It is touched if an edge passes through it or its centre is inside.

Each edge is cut at the rows of pixels that it passes, which gives the columns it touches there; each row's middle line,
cut by the edges, gives the stretches inside. Both are spans of a row; overlapping ones are merged, so a pixel meets an
area once, by an equi-join on rows and blocks of columns. No pixel is tested against a ring, and what travels is as long as
the areas' outlines and the blocks that they fill, not their pixels.

An edge that ends on a pixel's border touches the pixels on both sides of it within its row and, upwards, the row that
begins there. Rings of fewer than two points and null points have no edges; empty areas touch nothing; pixels without a place
are in no area; equal pixels are counted each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Columns of pixels in a block, by which pixels and spans meet.
BLOCK = 64


def edges(areas: DataFrame, rings: str = "rings") -> DataFrame:
    """area, ax, ay, bx, by: the edges of all rings."""
    ring = areas.select("area", F.explode(rings).alias("_ring"))
    points = ring.withColumn("_ring", F.filter("_ring", lambda p: p["x"].isNotNull() & p["y"].isNotNull())).where(F.size("_ring") > 1)
    after = F.concat(F.slice("_ring", F.lit(2), F.size("_ring")), F.slice("_ring", 1, 1))
    each = points.select("area", F.explode(F.arrays_zip(F.col("_ring").alias("a"), after.alias("b"))).alias("_e"))
    return each.select("area", *(F.col(f"_e.{p}.{c}").cast("double").alias(f"{p}{c}") for p in "ab" for c in "xy"))


def outline_spans(sides: DataFrame, size: float) -> DataFrame:
    """area, j, low, high: the columns that an edge touches in a row."""
    row = lambda y: F.floor(y / size).cast("long")
    bottom, top = F.least("ay", "by"), F.greatest("ay", "by")
    rows = sides.withColumn("j", F.explode(F.sequence(row(bottom), row(top))))
    low, high = F.greatest(bottom, F.col("j") * size), F.least(top, (F.col("j") + 1) * size)
    flat = F.col("ay") == F.col("by")
    at = lambda y: F.col("ax") + (F.col("bx") - F.col("ax")) * (y - F.col("ay")) / F.nullif(F.col("by") - F.col("ay"), F.lit(0.0))
    first, last = F.when(flat, F.col("ax")).otherwise(at(low)), F.when(flat, F.col("bx")).otherwise(at(high))
    return rows.select("area", "j", row(F.least(first, last)).alias("low"), row(F.greatest(first, last)).alias("high"))


def inner_spans(sides: DataFrame, size: float) -> DataFrame:
    """area, j, low, high: the columns whose centres are inside, between every other crossing of a row's middle."""
    first = F.ceil(F.least("ay", "by") / size - 0.5).cast("long")
    last = F.ceil(F.greatest("ay", "by") / size - 0.5).cast("long") - 1  # a middle at an edge's upper end isn't crossed
    crossed = sides.withColumn("_f", first).withColumn("_l", last).where("_l >= _f").withColumn("j", F.explode(F.sequence("_f", "_l")))
    x = F.col("ax") + (F.col("bx") - F.col("ax")) * ((F.col("j") + 0.5) * size - F.col("ay")) / (F.col("by") - F.col("ay"))
    by = W.partitionBy("area", "j").orderBy("_x")
    ranked = crossed.select("area", "j", x.alias("_x")).withColumn("_n", F.row_number().over(by)).withColumn("_to", F.lead("_x").over(by))
    centre = lambda v: F.ceil(v / size - 0.5).cast("long")
    spans = ranked.where("_n % 2 = 1 AND _to IS NOT NULL").select("area", "j", centre(F.col("_x")).alias("low"), (centre(F.col("_to")) - 1).alias("high"))
    return spans.where("low <= high")


def spans(areas: DataFrame, size: float, rings: str = "rings", touched: bool = True) -> DataFrame:
    """area, j, low, high: disjoint stretches of the pixels that an area touches, or, not touched, whose centres it has."""
    sides = edges(areas, rings)
    inner = inner_spans(sides, size)
    if not touched:
        return inner
    both = inner.unionByName(outline_spans(sides, size))
    by = W.partitionBy("area", "j").orderBy("low", "high")
    reach = F.max("high").over(by.rowsBetween(W.unboundedPreceding, -1))
    apart = both.withColumn("_new", F.when(F.col("low") > reach + 1, 1).otherwise(0))
    numbered = apart.withColumn("_span", F.sum("_new").over(by.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy("area", "j", "_span").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_span")


def touching(pixels: DataFrame, areas: DataFrame, size: float, rings: str = "rings", touched: bool = True) -> DataFrame:
    """pixels (i, j, ...) with each area that they touch."""
    block = lambda c: F.floor(c / BLOCK).cast("long")
    offered = spans(areas, size, rings, touched).withColumn("_b", F.explode(F.sequence(block(F.col("low")), block(F.col("high")))))
    met = pixels.withColumn("_b", block(F.col("i"))).join(offered, ["j", "_b"])
    return met.where(F.col("i").between(F.col("low"), F.col("high"))).select(*(F.col(c) for c in pixels.columns), "area")


def zonal(pixels: DataFrame, areas: DataFrame, size: float, value: str | Column, rings: str = "rings", touched: bool = True) -> DataFrame:
    """area, pixels, mean: over the pixels with a value that each area touches; areas without any are left out."""
    held = touching(pixels.withColumn("_value", F.col(value) if isinstance(value, str) else value), areas, size, rings, touched)
    return held.where("_value IS NOT NULL").groupBy("area").agg(F.count(F.lit(1)).alias("pixels"), F.avg("_value").alias("mean"))
