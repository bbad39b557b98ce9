"""Words with places to tables, and points to areas: what is left of page layouts and rasters once they are rows.

Word rows: page, x, y, text. A band is a stretch of y (or x on a turned page) without a jump above a limit; a cell is a
column's text within a band. Pixels: x, y and a value; areas: rings of (x, y) points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .aggregates import groups_since


def upright(words: DataFrame, turned: str, mirrored: bool = False) -> DataFrame:
    """Words of turned pages with x and y exchanged; mirrored: such pages give glyphs in reverse order, so their texts are
    turned round and x runs backwards."""
    x = F.when(F.col(turned), -F.col("y") if mirrored else F.col("y")).otherwise(F.col("x"))
    text = F.when(F.col(turned), F.reverse("text")).otherwise(F.col("text")) if mirrored else F.col("text")
    return words.select(*(c for c in words.columns if c not in ("x", "y", "text")), x.alias("x"), F.when(F.col(turned), F.col("x")).otherwise(F.col("y")).alias("y"), text.alias("text"))


def banded(words: DataFrame, jump: float, keys: tuple[str, ...] = ("page",)) -> DataFrame:
    """band: numbers a page's lines from 0, a new one beginning where y jumps by more than a limit."""
    by = W.partitionBy(*keys).orderBy("y", "x")
    marked = words.withColumn("_gap", F.col("y") - F.lag("y").over(by))
    return groups_since(marked, list(keys), ["y", "x"], F.col("_gap") > jump, "band").drop("_gap")


def lines(words: DataFrame, jump: float, keys: tuple[str, ...] = ("page",)) -> DataFrame:
    """keys, band, line: each band's words joined by blanks from left to right. A band is a printed line, which bounds it."""
    parts = banded(words, jump, keys).groupBy(*keys, "band").agg(F.array_sort(F.collect_list(F.struct("x", "text"))).alias("_w"))
    return parts.select(*keys, "band", F.concat_ws(" ", F.transform("_w", lambda w: w["text"])).alias("line"))


def cells(words: DataFrame, columns: list[tuple[str, float]], jump: float, tolerance: float, keys: tuple[str, ...] = ("page",)) -> DataFrame:
    """keys, band, column, text: words go to the column whose place is nearest within a tolerance (the left one of two);
    the rest is dropped. Columns are a page's header, given as (name, x)."""
    offers = F.array(*(F.struct(F.abs(F.col("x") - at).alias("d"), F.lit(at).alias("x"), F.lit(name).alias("name")) for name, at in columns))
    best = F.array_min(F.filter(offers, lambda o: o["d"] <= tolerance))
    placed = banded(words, jump, keys).withColumn("column", best["name"]).where(F.col("column").isNotNull())
    parts = placed.groupBy(*keys, "band", "column").agg(F.array_sort(F.collect_list(F.struct("x", "text"))).alias("_w"))
    return parts.select(*keys, "band", "column", F.concat_ws(" ", F.transform("_w", lambda w: w["text"])).alias("text"))


def reading_order(blocks: DataFrame, column_width: float, code: str) -> DataFrame:
    """Text blocks by page, printed column and y, and the code that leads each: place, region. A block whose text matches
    the code form opens a region, which holds until the next one; blocks before the first have none."""
    ordered = W.partitionBy("page").orderBy(F.floor(F.col("x") / column_width), "y", "x")
    opened = F.regexp_extract("text", code, 0)
    marked = blocks.withColumn("place", F.row_number().over(ordered)).withColumn("_code", F.when(opened != "", opened))
    return marked.withColumn("region", F.last("_code", ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, 0))).drop("_code")


def inside(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point is in a ring of (x, y) points, by the parity of edges crossed to its right. A point on an edge
    counts for one of the two areas that share it."""
    shifted = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    edges = F.arrays_zip(ring.alias("a"), shifted.alias("b"))

    def crossed(edge: Column) -> Column:
        a, b = edge["a"], edge["b"]
        spans = (a["y"] > y) != (b["y"] > y)
        at = (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
        return spans & F.coalesce(x < at, F.lit(False))

    return F.size(F.filter(edges, crossed)) % 2 == 1


def within_areas(points: DataFrame, areas: DataFrame, cell: float) -> DataFrame:
    """points x areas (area, ring) for points inside. Both meet in square cells: an area offers itself in the cells of its
    bounding box, so no point meets an area that is far away; the ring decides."""
    box = [F.floor(f(F.col(f"ring.{name}")) / cell).cast("long") for name in ("x", "y") for f in (F.array_min, F.array_max)]
    xs, ys = F.sequence(box[0], box[1]), F.sequence(box[2], box[3])
    offered = areas.select("area", "ring", F.explode(xs).alias("_cx"), ys.alias("_ys")).select("area", "ring", "_cx", F.explode("_ys").alias("_cy"))
    celled = points.withColumn("_cx", F.floor(F.col("x") / cell).cast("long")).withColumn("_cy", F.floor(F.col("y") / cell).cast("long"))
    met = celled.join(offered, ["_cx", "_cy"])
    return met.where(inside(F.col("x"), F.col("y"), F.col("ring"))).select(*points.columns, "area")


def zonal(pixels: DataFrame, areas: DataFrame, cell: float, value: str) -> DataFrame:
    """area, pixels, mean: the mean of the pixels within each area; areas without any are left out."""
    return within_areas(pixels, areas, cell).groupBy("area").agg(F.count(F.lit(1)).alias("pixels"), F.avg(value).alias("mean"))
