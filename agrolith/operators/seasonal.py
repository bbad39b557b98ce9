"""Seasons, baselines and analogue years.

Formulas of analyses that are known by title only (failed runs, contingency, analogues, gap filling, adoption) are this
library's own choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.functions.columns import SEASONS

from ..tables import scanned
from .neighbours import distance, nearest_years


def seasonal_means(df: DataFrame, keys: list[str], year: str, month: str, value: str, labelled_by: str = "middle") -> DataFrame:
    """Three-month means where all three months are there. DJF belongs to the year of its January, NDJ to that of its
    November; with labelled_by="first" a season belongs to the year of its first month.

    Each month is offered to its three seasons and the season counts its months, so gaps cannot pass for neighbours.
    """
    at = F.col(month)
    offers = []
    for shift in (-1, 0, 1):  # the month's place in the season, from its middle month
        middle = (at - shift - 1 + 12) % 12 + 1
        own_year = F.col(year) + F.when(at - shift < 1, -1).when(at - shift > 12, 1).otherwise(0)
        first_year = own_year - F.when(middle == 1, 1).otherwise(0)
        named = first_year if labelled_by == "first" else own_year
        offers.append(F.struct(middle.cast("int").alias("m"), named.cast("int").alias("y")))
    labels = F.array(*map(F.lit, SEASONS))
    offered = df.where(F.col(value).isNotNull()).select(*keys, value, F.explode(F.array(*offers)).alias("_s"))
    grouped = offered.groupBy(*keys, F.col("_s.y").alias("season_year"), F.col("_s.m").alias("_m")).agg(F.avg(value).alias("season_mean"), F.count(F.lit(1)).alias("_n"))
    return grouped.where("_n = 3").select(*keys, "season_year", F.element_at(labels, F.col("_m")).alias("season"), "season_mean")


def baseline(df: DataFrame, keys: list[str], year: str, value: str, first: int, last: int, least: int = 20) -> DataFrame:
    """Mean, sample deviation and linearly interpolated terciles of a baseline, for keys with enough years."""
    rows = df.where(F.col(year).between(first, last) & F.col(value).isNotNull())
    return rows.groupBy(*keys).agg(F.avg(value).alias("clim_mean"), F.stddev_samp(value).alias("clim_sd"), F.percentile(value, 1 / 3).alias("t1"), F.percentile(value, 2 / 3).alias("t2"), F.count(F.lit(1)).alias("n_years")).where(F.col("n_years") >= least)


def tercile(value: Column, t1: Column, t2: Column) -> Column:
    return F.when(value <= t1, "Dry").when(value > t2, "Wet").when(value.isNotNull(), "Near")


def anomalies(df: DataFrame, keys: list[str], year: str, value: str, first: int, last: int, least: int = 20) -> DataFrame:
    """Rows of keys with a baseline: anomaly in percent (null where the mean is 0) and tercile.

    Rows that are not plain scans are stored before they are read twice: a mean that is computed anew may differ in its last
    bit from the one that is its own tercile.
    """
    df = scanned(df, "anomalies")
    base = baseline(df, keys, year, value, first, last, least)
    joined = df.join(base, keys)
    return joined.withColumn("anomaly_pct", F.try_divide(F.col(value) - F.col("clim_mean"), F.col("clim_mean")) * 100).withColumn("tercile", tercile(F.col(value), F.col("t1"), F.col("t2")))


def failed_runs(df: DataFrame, keys: list[str], order: str, failed: Column, step: int = 1) -> DataFrame:
    """Stretches of failed rows whose order advances by one step: keys, run_start, run_end, run_length."""
    rows = df.where(failed)
    island = F.col(order) / step - F.row_number().over(W.partitionBy(*keys).orderBy(order))
    return rows.withColumn("_i", island).groupBy(*keys, "_i").agg(F.min(order).alias("run_start"), F.max(order).alias("run_end"), F.count(F.lit(1)).alias("run_length")).drop("_i")


def contingency(df: DataFrame, given: str, outcome: str, outcomes: list[str]) -> DataFrame:
    """P(outcome | given) by column, and the row count."""
    shares = [F.avg(F.when(F.col(outcome) == o, 1.0).otherwise(0.0)).alias(f"p_{o.lower()}") for o in outcomes]
    return df.where(F.col(given).isNotNull() & F.col(outcome).isNotNull()).groupBy(given).agg(F.count(F.lit(1)).alias("n"), *shares)


def regression(df: DataFrame, keys: list[str], y: str, x: str, digits: int = 6) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.round(f(y, x), digits).alias(n) for f, n in ((F.regr_slope, "slope"), (F.regr_intercept, "intercept"), (F.regr_r2, "r2"))), F.round(F.corr(y, x), digits).alias("r"), F.regr_count(y, x).alias("n"))


#: Years of history a key up to which a state is compared with all of them.
FEW_YEARS = 500


def analogues(history: DataFrame, states: DataFrame, on: list[str], features: list[str], k: int, year: str = "year") -> DataFrame:
    """For each state the k nearest years of the same keys other than its own; ties go to the earlier year. Rows with a
    feature that is null, NaN or infinite take no part; history has one row a key and year.

    Where no key has more than FEW_YEARS years of history, states meet all of their key's by an equi-join; longer keys
    are searched with bounds (neighbours.nearest_years), which gives the same rows.
    """
    if history.groupBy(*on).count().where(F.col("count") > FEW_YEARS).limit(1).count():
        return nearest_years(history, states, on, features, k, year)
    for f in features:
        history, states = history.where(F.abs(F.col(f).cast("double")) < float("inf")), states.where(F.abs(F.col(f).cast("double")) < float("inf"))
    right = history.select(*on, F.col(year).alias("analogue"), *(F.col(f).alias(f"_{f}") for f in features))
    pairs = states.join(right, on).where(F.col(year) != F.col("analogue"))
    pairs = pairs.withColumn("distance", distance([F.col(f) for f in features], [F.col(f"_{f}") for f in features]))
    place = F.row_number().over(W.partitionBy(*on, year).orderBy("distance", "analogue"))
    return pairs.withColumn("place", place).where(F.col("place") <= k).select(*on, year, "analogue", "distance", "place")


def ranked_probability_skill(forecast: DataFrame, classes: list[str], probability: list[str], observed: str) -> DataFrame:
    """rps, the climatological rps and the skill score over all rows, and the share of rows whose likeliest class came."""
    def rps(p: list[Column]) -> Column:
        total, cum_p, cum_o = F.lit(0.0), F.lit(0.0), F.lit(0.0)
        for q, name in zip(p, classes, strict=True):
            cum_p, cum_o = cum_p + q, cum_o + F.when(F.col(observed) == name, 1.0).otherwise(0.0)
            total = total + (cum_p - cum_o) * (cum_p - cum_o)
        return total / (len(classes) - 1)

    own, flat = rps([F.col(p) for p in probability]), rps([F.lit(1 / len(classes))] * len(classes))
    best = F.element_at(F.array(*map(F.lit, classes)), F.array_position(F.array(*probability), F.greatest(*probability)).cast("int"))
    summed = forecast.select(own.alias("a"), flat.alias("b"), (best == F.col(observed)).cast("int").alias("hit"))
    return summed.agg(F.avg("a").alias("rps"), F.avg("b").alias("rps_climatology"), (1 - F.try_divide(F.avg("a"), F.avg("b"))).alias("rpss"), F.avg("hit").alias("accuracy"))


def strength(z: Column) -> Column:
    """moderate from 1.0, strong from 1.5 standard deviations, by sign."""
    size = F.when(F.abs(z) >= 1.5, "strong").when(F.abs(z) >= 1.0, "moderate").otherwise("neutral")
    return F.when(z.isNull(), None).when(size == "neutral", size).otherwise(F.concat(size, F.when(z > 0, F.lit(" +")).otherwise(F.lit(" -"))))


def gap_filled(df: DataFrame, value: str, *levels: str) -> DataFrame:
    """A missing value from the mean of its first level that has one; `filled_from` names it."""
    out, sources = df, []
    for level in levels:
        means = df.where(F.col(value).isNotNull() & F.col(level).isNotNull()).groupBy(level).agg(F.avg(value).alias(f"_mean_{level}"))
        out = out.join(means, level, "left")
        sources.append((level, F.col(f"_mean_{level}")))
    origin = F.when(F.col(value).isNotNull(), "own")
    for level, mean in sources:
        origin = origin.when(mean.isNotNull(), level)
    return out.select(*(df[c] for c in df.columns if c != value and c not in levels), *levels, F.coalesce(F.col(value), *(m for _, m in sources)).alias(value), origin.alias("filled_from"))


def adopted(value: Column, rate: Column, years: Column) -> Column:
    """Value reached after some years of adoption at a yearly rate: v * (1 - (1 - a) ** t)."""
    return value * (1 - F.pow(1 - rate, years))


def total_benefit(benefit: Column, ratio: Column) -> Column:
    """Benefit less its cost, from a benefit-cost ratio."""
    return benefit - F.try_divide(benefit, ratio)
