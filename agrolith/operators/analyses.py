"""Analyses over the aggregates: gaps to a benchmark, between groups and over time, cumulative impact, ensembles.

The analyses are known by their titles and captions; the formulas are this library's own choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .aggregates import with_average


def phase_means(df: DataFrame, z: str, value: str) -> DataFrame:
    """phase, n, mean: the mean of a value by the strength class of a driver's standard score."""
    from .seasonal import strength

    return df.where(F.col(z).isNotNull() & F.col(value).isNotNull()).groupBy(strength(F.col(z)).alias("phase")).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))


def predictor_star(targets: DataFrame, drivers: DataFrame, indices: list[str], keys: tuple[str, str] = ("season", "year")) -> DataFrame:
    """Targets (season, year, ...) with one column for each driver index in the predictor season of the same year, or of
    the year before where the predictor season comes later in the calendar than the target. drivers: index, season, year,
    value. Drivers are pivoted once, so it is one equi join."""
    from agrolith.functions.columns import SEASONS, predictor_season

    season, year = keys
    wide = drivers.groupBy(F.col("season").alias("_s"), F.col("year").alias("_y")).pivot("index", indices).agg(F.first("value", ignorenulls=True))
    place = lambda s: F.array_position(F.array(*map(F.lit, SEASONS)), s)
    asked = targets.withColumn("predictor", predictor_season(F.col(season)))
    asked = asked.withColumn("_y", F.col(year) - F.when(place(F.col("predictor")) > place(F.col(season)), 1).otherwise(0))
    return asked.join(wide, (F.col("predictor") == wide["_s"]) & (asked["_y"] == wide["_y"]), "left").select(*targets.columns, "predictor", *(wide[i] for i in indices))


def benchmark_gap(df: DataFrame, place: str, keys: list[str], value: str, benchmark: str) -> DataFrame:
    """Each place's value less that of the benchmark place under the same keys; places without a benchmark have null."""
    base = df.where(F.col(place) == benchmark).groupBy(*keys).agg(F.first(value).alias("benchmark"))
    return df.where(F.col(place) != benchmark).join(base, keys, "left").withColumn("gap", F.col(value) - F.col("benchmark"))


def class_shares(df: DataFrame, keys: list[str], row: Column, column: Column, opportunity: tuple[str, str], gap: tuple[str, str]) -> DataFrame:
    """n and, in percent, the shares of two cells of a two-way class: the one that is an opportunity (ready and exposed)
    and the one that is a gap (not ready and exposed)."""
    share = lambda cell: 100.0 * F.avg(F.when((row == cell[0]) & (column == cell[1]), 1.0).otherwise(0.0))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), share(opportunity).alias("opportunity_pct"), share(gap).alias("gap_pct"))


def two_measure_gap(df: DataFrame, first: str, second: str) -> DataFrame:
    """low, high, gap (first less second) and which of both leads: what a dumbbell shows."""
    gap = F.col(first) - F.col(second)
    leads = F.when(gap > 0, first).when(gap < 0, second).otherwise("none")
    return df.withColumns({"low": F.least(first, second), "high": F.greatest(first, second), "gap": gap, "leads": leads})


def group_gap(df: DataFrame, keys: list[str], year: str, group: str, value: str, groups: tuple[str, str], label: str, text: str = "average") -> DataFrame:
    """Of each key's latest year with both groups: their values and the gap in points, and a row with the means."""
    wide = df.groupBy(*keys, year).pivot(group, list(groups)).agg(F.first(value, ignorenulls=True)).where(F.col(groups[0]).isNotNull() & F.col(groups[1]).isNotNull())
    last = wide.groupBy(*keys).agg(F.max(F.struct(year, *groups)).alias("_t")).select(*keys, f"_t.{year}", *(f"_t.{g}" for g in groups))
    return with_average(last.withColumn("gap", F.col(groups[0]) - F.col(groups[1])), label, text, *groups, "gap")


def horizon_change(df: DataFrame, keys: list[str], time: str, value: str, baseline, horizon) -> DataFrame:
    """baseline, horizon, change in percent and its trend (up or down beyond 1 %, else stable)."""
    wide = df.groupBy(*keys).pivot(time, [baseline, horizon]).agg(F.first(value, ignorenulls=True))
    wide = wide.toDF(*keys, "baseline", "horizon")
    change = F.try_divide(F.col("horizon") - F.col("baseline"), F.col("baseline")) * 100
    trend = F.when(change > 1, "up").when(change < -1, "down").when(change.isNotNull(), "stable")
    return wide.withColumn("change_pct", change).withColumn("trend", trend)


def impacted(df: DataFrame, keys: list[str], order: str, loss: str, count: str, thresholds: tuple[float, ...]) -> DataFrame:
    """keys, order, threshold, impacted: the running count of what lost at least a threshold up to each event."""
    at = F.explode(F.array(*map(F.lit, thresholds))).alias("threshold")
    each = df.groupBy(*keys, order, loss).agg(F.sum(count).alias("_n")).select("*", at)
    hit = each.groupBy(*keys, order, "threshold").agg(F.sum(F.when(F.col(loss) >= F.col("threshold"), F.col("_n")).otherwise(0)).alias("_hit"))
    running = F.sum("_hit").over(W.partitionBy(*keys, "threshold").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return hit.select(*keys, order, "threshold", running.alias("impacted"))


def ensemble(df: DataFrame, keys: list[str], model: str) -> DataFrame:
    """keys, models, events, ensemble_mean: events by model, and their mean over all models that the key has."""
    each = df.groupBy(*keys, model).agg(F.count(F.lit(1)).alias("_n"))
    return each.groupBy(*keys).agg(F.count(F.lit(1)).alias("models"), F.sum("_n").alias("events"), F.avg("_n").alias("ensemble_mean"))


def chronology(df: DataFrame, keys: list[str], date: str, unit: str = "month") -> DataFrame:
    """Reports by period: period, n, and the days since the key's period before."""
    each = df.groupBy(*keys, F.trunc(F.col(date).cast("date"), unit).alias("period")).agg(F.count(F.lit(1)).alias("n"))
    return each.withColumn("since", F.datediff("period", F.lag("period").over(W.partitionBy(*keys).orderBy("period"))))


def trade_buffer(df: DataFrame, keys: list[str], direction: str, value: str) -> DataFrame:
    """imports, exports, net and the share of imports that exports cover; null where there are none."""
    total = lambda name: F.sum(F.when(F.col(direction) == name, F.col(value)).otherwise(0.0))
    sums = df.groupBy(*keys).agg(total("import").alias("imports"), total("export").alias("exports"))
    return sums.withColumn("net", F.col("exports") - F.col("imports")).withColumn("cover", F.try_divide(F.col("exports"), F.nullif("imports", F.lit(0.0))))


def direction_classes(df: DataFrame, flow: str, named: dict[str, str]) -> DataFrame:
    """direction: the class of a flow's name, case and blanks aside; flows of no class, such as transit, are dropped."""
    table = F.create_map(*(F.lit(x) for pair in named.items() for x in pair))
    return df.withColumn("direction", table[F.lower(F.trim(F.col(flow)))]).where(F.col("direction").isNotNull())


def gap_rows(df: DataFrame, place: str, value: str, neighbours: DataFrame, region: str, continent: str) -> DataFrame:
    """A missing value from the mean of its neighbours (place, neighbour), else of its region, else of its continent;
    `filled_from` tells which."""
    known = df.where(F.col(value).isNotNull())
    near = neighbours.join(known.select(F.col(place).alias("neighbour"), F.col(value).alias("_v")), "neighbour").groupBy(place).agg(F.avg("_v").alias("_near"))
    out = df.join(near, place, "left")
    for level in (region, continent):
        out = out.join(known.where(F.col(level).isNotNull()).groupBy(level).agg(F.avg(value).alias(f"_{level}")), level, "left")
    origin = F.when(F.col(value).isNotNull(), "own").when(F.col("_near").isNotNull(), "neighbours").when(F.col(f"_{region}").isNotNull(), region).when(F.col(f"_{continent}").isNotNull(), continent)
    filled = F.coalesce(value, "_near", f"_{region}", f"_{continent}")
    return out.select(*(c for c in df.columns if c != value), filled.alias(value), origin.alias("filled_from"))
