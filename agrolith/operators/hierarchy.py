"""Rollup tables: several levels in one table, finer keys NULL on coarser rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_table(df: DataFrame, keys: list[str], *aggregates: Column, depths: list[int] | None = None) -> DataFrame:
    """All levels of keys, or with depths those of so many leading keys, so that a reader of one level has no other
    expanded. `level_id` is the grouping id, so a NULL key differs from a level's NULL."""
    sets = [keys[:depth] for depth in (range(len(keys) + 1) if depths is None else depths)]
    return df.groupingSets(sets, *keys).agg(F.grouping_id().cast("long").alias("level_id"), *aggregates)


def cube_table(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    return df.cube(*keys).agg(F.grouping_id().cast("long").alias("level_id"), *aggregates)


def prune(children: DataFrame, parents: DataFrame, on: list[str]) -> DataFrame:
    """Child selections whose key is still under a parent."""
    return children.join(parents.select(*on).distinct(), on, "left_semi")
