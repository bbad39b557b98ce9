"""Grouped and ordered operators. Everything aggregates partially before it shuffles; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum of v * w over sum of w, over rows that have both; null where the weights sum to 0."""
    both = value.isNotNull() & weight.isNotNull()
    return F.try_divide(F.sum(F.when(both, value * weight)), F.sum(F.when(both, weight)))


def positive_sums(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name)).where(F.col(name) > 0)


def quantile_summary(value: Column, prefix: str = "") -> list[Column]:
    """p10, p50, p90, mean and n over finite values."""
    finite = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    shares = F.percentile(finite, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))  # one aggregate, read three times
    quantiles = [F.get(shares, F.lit(at)).alias(f"{prefix}{n}") for at, n in enumerate(("p10", "p50", "p90"))]
    return [*quantiles, F.avg(finite).alias(f"{prefix}mean"), F.count(finite).alias(f"{prefix}n")]


def exceedance(value: Column, threshold: float) -> Column:
    return F.avg(F.when(value > threshold, 1.0).otherwise(0.0))


def coverage(present: Column) -> Column:
    """Share of rows in percent."""
    return 100.0 * F.avg(F.when(present, 1.0).otherwise(0.0))


def latest(value: str, order: str, *ties: str) -> Column:
    """The value of the latest row; ties by further columns."""
    return F.max_by(value, F.struct(order, *ties))


def longest(text: str, tie: str) -> Column:
    """The longest text; of equally long ones that of the largest tie column."""
    return F.max_by(text, F.struct(F.length(text), F.col(tie)))


def modes(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, mode, mode_count, total: the most frequent value, the smallest of equally frequent ones."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ordered = F.min(F.struct((-F.col("_n")).alias("_n"), F.col(value).alias("_v")))
    return counts.groupBy(*keys).agg(ordered.alias("_top"), F.sum("_n").alias("total")).select(*keys, F.col("_top._v").alias("mode"), (-F.col("_top._n")).alias("mode_count"), "total")


def mode_gate(df: DataFrame, keys: list[str], value: str, least: int) -> DataFrame:
    """Rows whose value is their key's mode, for keys where at least so many rows have it."""
    best = modes(df, keys, value).where(F.col("mode_count") >= least)
    return df.join(best.select(*keys, "mode"), keys).where(F.col(value) == F.col("mode")).drop("mode")


def additivity(parts: DataFrame, totals: DataFrame, keys: list[str], value: str, total: str) -> DataFrame:
    """Sum of parts in percent of the printed total, one decimal; null where that is 0 or missing."""
    sums = parts.groupBy(*keys).agg(F.sum(value).alias("parts_sum"))
    return sums.join(totals.select(*keys, total), keys, "left").select(*keys, "parts_sum", total, F.round(100 * F.try_divide(F.col("parts_sum"), F.col(total)), 1).alias("additivity_pct"))


def sum_present(*parts: Column) -> Column:
    """Sum of the parts that are there; null if none is."""
    total = sum((F.coalesce(part, F.lit(0.0)) for part in parts), F.lit(0.0))
    return F.when(F.coalesce(*parts).isNotNull(), total)


def shares(df: DataFrame, keys: list[str], weight: str, fallback: str, name: str = "share") -> DataFrame:
    """weight / its sum by key; where the weights sum to 0, the fallback's share."""
    by = W.partitionBy(*keys)
    weights, areas = F.sum(weight).over(by), F.sum(fallback).over(by)
    return df.withColumn(name, F.when(weights > 0, F.col(weight) / weights).otherwise(F.try_divide(F.col(fallback), areas)))


def wide(df: DataFrame, keys: list[str], name: str, value: str, names: list) -> DataFrame:
    """Long to wide with a given list of names, so no extra pass looks for them."""
    return df.groupBy(*keys).pivot(name, names).agg(F.first(value, ignorenulls=True))


def long(df: DataFrame, keys: list[str], values: list[str], name: str, value: str) -> DataFrame:
    """Wide to long; null values stay."""
    return df.unpivot(keys, values, name, value)


def rows_from_columns(df: DataFrame, *arrays: str) -> DataFrame:
    """A row of arrays to rows of their elements; rows without any value are dropped."""
    zipped = df.select(F.explode(F.arrays_zip(*arrays)).alias("_r")).select("_r.*")
    return zipped.dropna(how="all")


# ordered


def running(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    return df.withColumn(name, F.sum(value).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def groups_since(df: DataFrame, keys: list[str], order: list[str], head: Column, name: str = "group") -> DataFrame:
    """Numbers the stretches that begin at rows where head holds."""
    return df.withColumn(name, F.sum(F.when(head, 1).otherwise(0)).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def merged_wrapped(df: DataFrame, keys: list[str], order: str | list[str], name: str, value: str) -> DataFrame:
    """Names without a value are put before the name of the next row that has one, however many there are; names at a
    key's end without any such row are dropped."""
    orders = [order] if isinstance(order, str) else order
    by = W.partitionBy(*keys).orderBy(*orders)
    before = F.sum(F.when(F.col(value).isNotNull(), 1).otherwise(0)).over(by.rowsBetween(W.unboundedPreceding, -1))
    parts = df.withColumn("_group", F.coalesce(before, F.lit(0)))
    names = F.transform(F.array_sort(F.collect_list(F.when(F.col(name).isNotNull(), F.struct(*orders, F.col(name).alias("_n"))))), lambda x: x["_n"])
    merged = parts.groupBy(*keys, "_group").agg(*(F.max(o).alias(o) for o in orders), F.concat_ws(" ", names).alias(name), F.max(value).alias(value))
    return merged.where(F.col(value).isNotNull()).drop("_group")


def with_average(df: DataFrame, label: str, text: str, *values: str) -> DataFrame:
    """The rows, and one more labelled text with the mean of the values; other columns are null there."""
    average = df.agg(*(F.avg(v).alias(v) for v in values)).withColumn(label, F.lit(text))
    return df.unionByName(average, allowMissingColumns=True)


def repeats_before(df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "repeated") -> DataFrame:
    previous = F.lag(value).over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, F.coalesce(previous == F.col(value), F.lit(False)))


def split_at_gaps(df: DataFrame, keys: list[str], value: str, k: int, name: str = "cluster") -> DataFrame:
    """k clusters of a sorted value, cut at its k - 1 largest gaps (of equal gaps the lower one)."""
    by = W.partitionBy(*keys)
    gaps = df.withColumn("_gap", F.col(value) - F.lag(value).over(by.orderBy(value)))
    ranked = gaps.withColumn("_rank", F.row_number().over(by.orderBy(F.col("_gap").desc_nulls_last(), value)))
    cut = F.when(F.col("_gap").isNotNull() & (F.col("_rank") <= k - 1), 1).otherwise(0)
    return ranked.withColumn(name, F.sum(cut).over(by.orderBy(value).rowsBetween(W.unboundedPreceding, 0))).drop("_gap", "_rank")


def largest_cluster(df: DataFrame, keys: list[str], value: str, jump: float) -> DataFrame:
    """Rows of each key's largest stretch without a jump above the limit (of equal ones the first)."""
    by = W.partitionBy(*keys).orderBy(value)
    marked = df.withColumn("_gap", F.col(value) - F.lag(value).over(by))
    clusters = groups_since(marked, keys, [value], F.col("_gap") > jump, "_cluster")
    sizes = clusters.groupBy(*keys, "_cluster").agg(F.count(F.lit(1)).alias("_n"))
    best = sizes.groupBy(*keys).agg(F.max(F.struct("_n", (-F.col("_cluster")).alias("_c"))).alias("_top")).select(*keys, (-F.col("_top._c")).alias("_cluster"))
    return clusters.join(best, [*keys, "_cluster"], "left_semi").select(*df.columns)


def upper_median(value: str) -> Column:
    """The element n // 2 of the sorted values: the discrete median from above. Its buffer counts distinct values and is
    combined before the shuffle."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}` DESC)")


def median_band(df: DataFrame, keys: list[str], value: str, confirmed: Column, band: float = 0.5) -> DataFrame:
    """Rows within a band around the upper median of their key's confirmed rows; keys without one keep all."""
    medians = df.where(confirmed & F.col(value).isNotNull()).groupBy(*keys).agg(upper_median(value).alias("_median"))
    joined = df.join(medians, keys, "left")
    good = F.col("_median").isNull() | (F.abs(F.col(value) - F.col("_median")) <= band * F.abs("_median"))
    return joined.where(good).select(*df.columns)


def detrended(df: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """trend, anomaly, pct_anom and trend_slope of a straight line by key."""
    fit = df.groupBy(*keys).agg(F.regr_slope(value, year).alias("trend_slope"), F.regr_intercept(value, year).alias("_base"))
    joined = df.join(fit, keys)
    trend = F.col("_base") + F.col("trend_slope") * F.col(year)
    return joined.withColumn("trend", trend).withColumn("anomaly", F.col(value) - F.col("trend")).withColumn("pct_anom", F.try_divide(F.col("anomaly"), F.col("trend")) * 100).drop("_base")


def top_k(df: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    return df.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= k)
