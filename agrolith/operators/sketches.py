"""Distinct counts that add up: a sketch a day is kept, and any range of days is a union of sketches, not a new scan. Where
counts must be exact, a day's distinct values are kept themselves (`members`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import small

#: Logarithm of a sketch's registers. Up to an eighth of them distinct values are listed and counted as they are; beyond,
#: the standard error is 1.04 / sqrt(registers), 0.6 %.
LG = 15


def kept(df: DataFrame, keys: list[str], value: Column | str, lg: int = LG) -> DataFrame:
    """keys, rows and the sketch of the key's distinct values: 2 ** lg bytes at most."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(value, lg).alias("sketch"))


def added(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Kept sketches with those of rows that came later, also for keys that both have."""
    both = old.unionByName(new)
    return both.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch", True).alias("sketch"))


def over_ranges(sketches: DataFrame, order: str, ranges: DataFrame, *keys: str, lg: int = LG) -> DataFrame:
    """The ranges (low, high, both included) and, by keys, rows, distinct values and how far those may be off (three
    standard errors). A range without rows has none."""
    held = sketches.join(small(ranges), (F.col(order) >= F.col("low")) & (F.col(order) <= F.col("high")))
    union = held.groupBy("low", "high", *keys).agg(F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias("distinct"))
    listed = F.col("distinct") <= (1 << lg) / 8
    return union.withColumn("error", F.when(listed, 0.0).otherwise(3 * 1.04 / (1 << lg) ** 0.5 * F.col("distinct")))


def members(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value and rows: a key's distinct values, each with the number of its rows."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("rows"))


def added_members(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Kept values with those of rows that came later, also for keys that both have."""
    return old.unionByName(new).groupBy(*keys, value).agg(F.sum("rows").alias("rows"))


def counted_over_ranges(kept: DataFrame, order: str, ranges: DataFrame, value: str, *keys: str) -> DataFrame:
    """The ranges (low, high, both included) and, by keys, rows and the exact number of distinct values; nulls are rows, but
    no value. A range without rows has none."""
    held = kept.join(small(ranges), (F.col(order) >= F.col("low")) & (F.col(order) <= F.col("high")))
    once = held.groupBy("low", "high", *keys, value).agg(F.sum("rows").alias("rows"))
    return once.groupBy("low", "high", *keys).agg(F.sum("rows").alias("rows"), F.count(value).alias("distinct"))
