"""Order without one task a key: rows are dealt to ranges of a global order and stored, so a key with a third of all rows
lies in many ranges. What an earlier range passes on is one row a range and key.

A range's rows keep their place in it as a column, so no later step depends on how files are read. Rows that are equal in
the whole order would share a range; a last column that tells rows apart keeps ranges even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import BROADCAST_ROWS, stored

RANGE, PLACE = "_range", "_place"


def dealt(df: DataFrame, *order: Column | str) -> DataFrame:
    """The rows as a table in the shared folder, with the number of their range and, from 0, of their place in it."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_number", F.monotonically_increasing_id())
    low = (1 << 33) - 1  # the rows of a partition; the partition's number is above
    return stored(ranged.withColumn(RANGE, F.shiftright("_number", 33)).withColumn(PLACE, F.col("_number").bitwiseAND(F.lit(low))).drop("_number"), "ranges")


def with_carried(ranged: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """Each row with what its range and key carry. Up to BROADCAST_ROWS ranges and keys stand beside every task; more of
    them meet the rows by a join, after which the rows are put in their places again."""
    on = [RANGE, *keys]
    named = carried.select(F.col(RANGE).alias("_r"), *(F.col(k).alias(f"_k{at}") for at, k in enumerate(keys)), *(c for c in carried.columns if c not in on))
    same = F.col(RANGE) == F.col("_r")
    for at, key in enumerate(keys):
        same &= ranged[key].eqNullSafe(F.col(f"_k{at}"))
    spent = ["_r", *(f"_k{at}" for at in range(len(keys)))]
    if carried.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return ranged.join(F.broadcast(named), same).drop(*spent)
    return ranged.join(named, same).drop(*spent).repartition(RANGE).sortWithinPartitions(RANGE, PLACE)


def numbered(df: DataFrame, keys: list[str], *order: Column | str, name: str = "place", total: str | None = None) -> DataFrame:
    """Row numbers from 0 by key in an order, and the key's number of rows. keys may be empty. Rows come by range and
    place, so a task reads stretches of consecutive numbers."""
    ranged = dealt(df, *(F.col(k).asc_nulls_first() for k in keys), *order)
    counts = ranged.groupBy(RANGE, *keys).agg(F.count(F.lit(1)).alias("_n"), F.min(PLACE).alias("_first"))
    own = W.partitionBy(*keys)
    before = F.coalesce(F.sum("_n").over(own.orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    carried = stored(counts.withColumn("_before", before).withColumn("_total", F.sum("_n").over(own)).drop("_n"), "carried")
    out = with_carried(ranged, carried, keys).withColumn(name, F.col(PLACE) - F.col("_first") + F.col("_before"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop(RANGE, PLACE, "_first", "_before", "_total")


def prefixed(df: DataFrame, keys: list[str], order: list[Column | str], inside, across, last) -> DataFrame:
    """A prefix scan: rows see what their own range gives up to them and what earlier ranges of their key carry.

    last(keys of a range) aggregates a range's rows of a key to what it hands on; across(window) combines what the
    earlier ranges hand on; inside(window) is the range's own part. Names begin with `_`.
    """
    ranged = dealt(df, *(F.col(k).asc_nulls_first() for k in keys), *order)
    handed = ranged.groupBy(RANGE, *keys).agg(*last)
    earlier = W.partitionBy(*keys).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    carried = stored(handed.select(RANGE, *keys, *across(earlier)), "carried")
    own = W.partitionBy(RANGE, *keys).orderBy(PLACE)
    return with_carried(ranged.select("*", *inside(own)), carried, keys)


def running_sums(df: DataFrame, keys: list[str], order: list[Column | str], sums: dict[str, Column]) -> DataFrame:
    """Running sums by key in an order, under their names; nulls add nothing, and a sum is null until a value comes."""
    values = {f"_v{at}": value for at, value in enumerate(sums.values())}
    sofar = lambda own: [F.sum(v).over(own.rowsBetween(W.unboundedPreceding, 0)).alias(f"_own{v}") for v in values]
    handed = [F.sum(v).alias(f"_sum{v}") for v in values]
    out = prefixed(df.withColumns(values), keys, order, sofar, lambda w: [F.sum(f"_sum{v}").over(w).alias(f"_sum{v}") for v in values], handed)
    both = lambda v: F.when(F.col(f"_own{v}").isNull(), F.col(f"_sum{v}")).otherwise(F.col(f"_own{v}") + F.coalesce(F.col(f"_sum{v}"), F.lit(0)))
    return out.withColumns({name: both(v) for name, v in zip(sums, values, strict=True)}).select(*df.columns, *(n for n in sums if n not in df.columns))


def with_previous(df: DataFrame, keys: list[str], order: list[Column | str], values: dict[str, str]) -> DataFrame:
    """As previous(), with the rows' ranges and places."""
    own = lambda w: [*(F.lag(c).over(w).alias(f"_lag{n}") for n, c in values.items()), (F.row_number().over(w) == 1).alias("_head")]
    handed = [F.max_by(F.struct(*dict.fromkeys(values.values())), PLACE).alias("_last")]
    out = prefixed(df, keys, order, own, lambda w: [F.last("_last").over(w).alias("_last")], handed)
    return out.select(*df.columns, RANGE, PLACE, *(F.when(F.col("_head"), F.col(f"_last.{c}")).otherwise(F.col(f"_lag{n}")).alias(n) for n, c in values.items()))


def previous(df: DataFrame, keys: list[str], order: list[Column | str], values: dict[str, str]) -> DataFrame:
    """The value of the row before, by key in an order: name -> column. Null for a key's first row."""
    return with_previous(df, keys, order, values).drop(RANGE, PLACE)


def last_known(df: DataFrame, keys: list[str], order: list[Column | str], value: str, name: str) -> DataFrame:
    """The newest value that isn't null, up to and with the row itself."""
    own = lambda w: [F.last(value, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("_own")]
    handed = [F.max_by(value, F.when(F.col(value).isNotNull(), F.col(PLACE))).alias("_known")]
    out = prefixed(df, keys, order, own, lambda w: [F.last("_known", ignorenulls=True).over(w).alias("_known")], handed)
    return out.select(*df.columns, F.coalesce("_own", "_known").alias(name))


def stretches(df: DataFrame, keys: list[str], order: list[Column | str], head: Column, name: str = "group") -> DataFrame:
    """Numbers the stretches that begin at rows where head holds."""
    return running_sums(df, keys, order, {name: F.when(head, 1).otherwise(0)})


def split_at_gaps(df: DataFrame, keys: list[str], value: str, k: int, name: str = "cluster") -> DataFrame:
    """k clusters of a sorted value, cut at its k - 1 largest gaps (of equal gaps the lower one). A range offers its k - 1
    largest gaps, so a key decides among as many a range."""
    order = [F.col(value).asc_nulls_first()]
    gaps = with_previous(df, keys, order, {"_before": value}).withColumn("_gap", F.col(value) - F.col("_before"))
    held = stored(gaps.withColumn("_at", F.struct(RANGE, PLACE)).select(*df.columns, "_gap", "_at", RANGE), "gaps")
    widest = lambda *by: F.row_number().over(W.partitionBy(*keys, *by).orderBy(F.col("_gap").desc(), F.col("_at").asc()))
    offers = held.where("_gap IS NOT NULL").withColumn("_rank", widest(RANGE)).where(F.col("_rank") < k)
    cuts = offers.withColumn("_rank", widest()).where(F.col("_rank") < k).groupBy(*keys).agg(F.collect_list("_at").alias("_cuts"))
    out = matched(held, cuts, keys)
    return out.select(*df.columns, F.coalesce(F.size(F.filter("_cuts", lambda cut: cut <= F.col("_at"))), F.lit(0)).alias(name))


def largest_stretch(df: DataFrame, keys: list[str], value: str, jump: float) -> DataFrame:
    """Rows of each key's largest stretch of a sorted value without a jump above the limit (of equal ones the first)."""
    order = [F.col(value).asc_nulls_first()]
    marked = previous(df, keys, order, {"_before": value})
    held = stored(stretches(marked, keys, order, F.col(value) - F.col("_before") > jump, "_cluster"), "stretches")
    sizes = held.groupBy(*keys, "_cluster").agg(F.count(F.lit(1)).alias("_n"))
    best = sizes.groupBy(*keys).agg(F.max(F.struct("_n", (-F.col("_cluster")).alias("_c"))).alias("_top")).select(*keys, (-F.col("_top._c")).alias("_best"))
    return matched(held, best, keys).where(F.col("_cluster") == F.col("_best")).select(*df.columns)


def matched(rows: DataFrame, by_key: DataFrame, keys: list[str]) -> DataFrame:
    """A left join with one row a key; null keys meet."""
    if not keys:
        return rows.join(F.broadcast(by_key), F.lit(True), "left")  # one row
    named = by_key.select(*(F.col(k).alias(f"_k{at}") for at, k in enumerate(keys)), *(c for c in by_key.columns if c not in keys))
    same = F.lit(True)
    for at, key in enumerate(keys):
        same &= rows[key].eqNullSafe(F.col(f"_k{at}"))
    return rows.join(named, same, "left").drop(*(f"_k{at}" for at in range(len(keys))))


def placed(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """Row numbers from 1 in a global order."""
    return numbered(df, [], *order, name=name).withColumn(name, F.col(name) + 1)
