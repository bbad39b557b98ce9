"""Joins, lookups and set operations on keys that may be dirty.

A dimension is broadcast only if its measured size in rows is below BROADCAST_ROWS; beyond that the planner picks a
shuffled join, which adaptive execution splits where keys are skewed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import BROADCAST_ROWS
from .ordered import placed  # noqa: F401  part of this module's surface


def small(df: DataFrame) -> DataFrame:
    """Hints a broadcast of a frame that has at most BROADCAST_ROWS rows, which a bounded count tells."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def keep_best(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in an order."""
    numbered = df.withColumn("_place", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return numbered.where("_place = 1").drop("_place")


def left_last_wins(left: DataFrame, right: DataFrame, left_key: str, right_key: str, order: list[str], nested: str = "data", default: Column | None = None) -> DataFrame:
    """Every left row with the last right row of its key under `nested`; null keys never match; misses get default."""
    for frame, key in ((left, left_key), (right, right_key)):
        if key not in frame.columns:
            raise ValueError(f"no column {key!r}")
    chosen = right.where(F.col(right_key).isNotNull()).groupBy(F.col(right_key).alias("_key")).agg(F.max(F.struct(*order, F.struct(*right.columns).alias("_all"))).alias("_top"))
    joined = left.join(chosen, left[left_key] == chosen["_key"], "left")
    value = F.col("_top._all") if default is None else F.coalesce(F.col("_top._all"), default)
    return joined.select(*(left[c] for c in left.columns), value.alias(nested))


def listed(values: Iterable[str] | str | None) -> list[str]:
    return [values] if isinstance(values, str) else [v for v in (values or []) if v is not None and str(v).strip()]


def selected(features: DataFrame, selections: dict[str, Iterable[str] | str | None]) -> DataFrame:
    """Semi join on one or several selection sets; an empty selection selects all."""
    for name, values in selections.items():
        if wanted := listed(values):
            features = features.where(F.col(name).isin(*wanted))
    return features


def boundaries(features: dict[int, DataFrame], names: list[str], selections: list[Iterable[str] | str | None], most: int | None = None) -> tuple[int, DataFrame]:
    """The level to show and its features. features: level -> frame with names[: level + 1]. The level is the first one
    without a selection, at most `most` and the deepest level there is. Features are filtered by their ancestors'
    selections alone; those selected at the level itself are marked in `selected`, not filtered."""
    chosen = [listed(s) for s in selections]
    level = next((at for at, values in enumerate(chosen) if not values), len(chosen))
    level = min(level, max(features), most if most is not None else level)
    shown = selected(features[level], dict(zip(names[:level], chosen[:level], strict=False)))
    own = chosen[level] if level < len(chosen) else []
    return level, shown.withColumn("selected", F.col(names[level]).isin(*own) if own else F.lit(False))


def included(df: DataFrame, flag: str, key: str, excluded: Iterable) -> DataFrame:
    """Rows with the flag whose key is not excluded; a null key stays."""
    return df.where(F.col(flag) & ~F.coalesce(F.col(key).isin(*excluded), F.lit(False))).drop(flag)


def accepted(df: DataFrame, equal: dict | None = None, unlike: dict | None = None, among: dict | None = None, filled: Iterable[str] = (), not_prefixed: dict[str, str] | None = None, years: Iterable[str] = ()) -> DataFrame:
    """Rows that meet all rules of a dataset's builder: equal to a value or not, one of a set, not blank, without a prefix, a
    year of four digits. A null meets no rule. Every rule is a plain predicate, which a scan takes as a filter."""
    rules = [F.col(c) == v for c, v in (equal or {}).items()] + [F.col(c) != v for c, v in (unlike or {}).items()]
    rules += [F.col(c).isin(*values) if values else F.lit(False) for c, values in (among or {}).items()]
    rules += [F.trim(F.col(c).cast("string")) != "" for c in filled]
    rules += [~F.col(c).startswith(prefix) for c, prefix in (not_prefixed or {}).items()]
    rules += [F.col(c).cast("string").rlike(r"^\d{4}$") for c in years]
    for rule in rules:
        df = df.where(rule)
    return df


def looked_up(left: DataFrame, known: DataFrame, name: str, key: str, normal) -> tuple[DataFrame, DataFrame]:
    """Inner lookup on a normalised name, and the names that have no match, with their row counts."""
    table = known.select(normal(F.col(key)).alias("_n"), *(c for c in known.columns if c not in left.columns)).dropDuplicates(["_n"])
    named = left.withColumn("_n", normal(F.col(name)))
    missed = named.join(table.select("_n"), "_n", "left_anti").groupBy(name).agg(F.count(F.lit(1)).alias("rows"))
    return named.join(table, "_n").drop("_n"), missed


def unknown_related(records: DataFrame, key: str, related: str) -> DataFrame:
    """(key, related) for related keys that are no record's key."""
    pairs = records.select(F.col(key).alias("_from"), F.explode(related).alias("related")).distinct()
    return pairs.join(records.select(F.col(key).alias("related")).distinct(), "related", "left_anti").select(F.col("_from").alias(key), "related")


def many_to_one(left: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join that raises at run time where the dimension has a key twice or a left key has no match."""
    unique = dimension.groupBy(key).agg(F.count(F.lit(1)).alias("_times"), *(F.first(c).alias(c) for c in dimension.columns if c != key))
    joined = left.join(unique, key, "left")
    bad = F.when(F.col("_times").isNull(), F.raise_error(F.concat(F.lit("no match for key "), F.coalesce(F.col(key).cast("string"), F.lit("null")))))
    bad = bad.when(F.col("_times") > 1, F.raise_error(F.concat(F.lit("key twice: "), F.col(key).cast("string"))))
    return joined.withColumn("_check", bad).where(F.col("_check").isNull()).drop("_check", "_times")


def unmatched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), on, "left_anti")


def resolve_names(names: DataFrame, known: DataFrame, aliases: dict[str, str], name: str = "name", key: str = "key", least: int = 3) -> DataFrame:
    """name -> key: exact, else by alias, else the only known name that begins with `name `; otherwise null.

    The prefix stage is an equi-join: every known name offers its beginnings at word ends.
    """
    table = known.select(F.col(key).alias("_k")).distinct()
    alias = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair)) if aliases else None
    wanted = names.withColumn("_alias", alias[F.col(name)] if alias is not None else F.lit(None).cast("string"))
    words = F.split("_k", " ")
    beginnings = table.select("_k", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda n: F.concat_ws(" ", F.slice(words, F.lit(1), n)))).alias("_p")).where("_p <> _k")
    unique = beginnings.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.first("_k").alias("_by_prefix")).where("_n = 1").drop("_n")
    joined = wanted.join(table.select(F.col("_k").alias("_exact")), wanted[name] == F.col("_exact"), "left")
    joined = joined.join(table.select(F.col("_k").alias("_by_alias")), F.col("_alias") == F.col("_by_alias"), "left")
    joined = joined.join(unique, (F.col(name) == F.col("_p")) & (F.length(name) >= least), "left")
    return joined.select(*names.columns, F.coalesce("_exact", "_by_alias", "_by_prefix").alias(key))


#: So many centres at most are held as one array beside every point.
FEW = 64


def nearest(points: DataFrame, centres: DataFrame, value: str, centre: str, tolerance: float) -> DataFrame:
    """Each point with its nearest centre within a tolerance (the smaller of two equally near ones); repeated points
    each stay.

    Up to FEW distinct centres, which a bounded look tells, stand beside every point as an array: nothing is shuffled.
    More meet the points in cells as wide as the tolerance: a centre offers itself in three cells.
    """
    known = [row[0] for row in centres.select(F.col(centre).cast("double")).where(F.col(centre).isNotNull()).distinct().limit(FEW + 1).collect()]
    offer = lambda c: F.when(F.abs(F.col(value) - c) <= tolerance, F.struct(F.abs(F.col(value) - c).alias("d"), c.alias("c")))
    if len(known) <= FEW:
        offers = F.transform(F.array(*map(F.lit, known)).cast("array<double>"), offer)
        return points.withColumn(centre, F.array_min(F.filter(offers, lambda x: x.isNotNull()))["c"])
    cell = F.floor(F.col(value) / tolerance)
    offered = centres.select(F.col(centre).cast("double").alias("_c"), F.explode(F.sequence(F.floor(F.col(centre) / tolerance) - 1, F.floor(F.col(centre) / tolerance) + 1)).alias("_cell"))
    numbered = points.select(F.struct("*").alias("_point"), cell.alias("_cell"), F.monotonically_increasing_id().alias("_number"))
    met = numbered.join(offered, "_cell", "left").withColumn(value, F.col(f"_point.{value}"))
    best = met.groupBy("_number").agg(F.first("_point").alias("_point"), F.min(offer(F.col("_c"))).alias("_best"))
    return best.select("_point.*", F.col("_best.c").alias(centre))


def bin_join(df: DataFrame, bins: DataFrame, value: str) -> DataFrame:
    """Rows with the class whose [low, high) holds the value; null bounds are open. bins: low, high, class."""
    condition = (F.col("low").isNull() | (df[value] >= F.col("low"))) & (F.col("high").isNull() | (df[value] < F.col("high")))
    return df.join(small(bins), condition, "left").drop("low", "high")


def reconcile(a: DataFrame, b: DataFrame, on: list[str], value: str, absolute: float, relative: float) -> DataFrame:
    """Full outer comparison: on, value_a, value_b, state (agree, differ, only_a, only_b)."""
    left = a.select(*on, F.col(value).alias("value_a"), F.lit(1).alias("_a"))
    right = b.select(*on, F.col(value).alias("value_b"), F.lit(1).alias("_b"))
    joined = left.join(right, on, "full")
    close = F.abs(F.col("value_a") - F.col("value_b")) < F.greatest(F.lit(absolute), relative * F.abs("value_a"))
    state = F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").when(close, "agree").otherwise("differ")
    return joined.select(*on, "value_a", "value_b", state.alias("state"))


def cascade(parents: DataFrame, children: DataFrame, on: list[str]) -> DataFrame:
    """Children of the parents."""
    return children.join(parents.select(*on).distinct(), on, "left_semi")


def concat_rows(*frames: DataFrame) -> DataFrame:
    """All rows; columns that a frame lacks are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def replace_slice(old: DataFrame, new: DataFrame, condition: Column) -> DataFrame:
    """old without the rows of a slice (nulls stay), and new."""
    return old.where(~F.coalesce(condition, F.lit(False))).unionByName(new)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(new.select(*keys).distinct(), keys, "left_anti").select(*old.columns).unionByName(new)


def alias_keys(records: DataFrame, key: str, aliases: str) -> DataFrame:
    """alias -> key from an array column; an alias of two keys raises."""
    pairs = records.select(F.col(key), F.explode(aliases).alias("alias")).distinct()
    grouped = pairs.groupBy("alias").agg(F.min(key).alias(key), F.count(F.lit(1)).alias("_n"))
    return grouped.select("alias", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("alias of two keys: "), F.col("alias")))).otherwise(F.col(key)).alias(key))
