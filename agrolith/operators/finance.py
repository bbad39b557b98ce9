"""Cash flows: discounted sums, rates of return, avoided loss and simulation."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from . import selection
from .aggregates import exceedance, quantile_summary
from .ordered import matched, numbered, running_sums
from .relational import small

PHI0 = 1 / math.sqrt(2 * math.pi)


def position(keys: list[str], order: str) -> Column:
    return F.row_number().over(W.partitionBy(*keys).orderBy(order)) - 1


def discounted(value: Column, rate: Column, t: Column) -> Column:
    """The first year is not discounted."""
    return value / F.pow(1 + rate, t)


def npv_series(df: DataFrame, keys: list[str], order: str, flow: str, rate: float) -> DataFrame:
    """t and npv: the running discounted sum."""
    df = df.withColumn("t", position(keys, order))
    by = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("npv", F.sum(discounted(F.col(flow), F.lit(rate), F.col("t"))).over(by))


def npv_scan(df: DataFrame, keys: list[str], order: list[Column | str], flow: str, rate: float) -> DataFrame:
    """The same where a key may hold any share of the rows."""
    placed = numbered(df, keys, *order, name="t")
    return running_sums(placed, keys, [F.col("t").asc()], {"npv": discounted(F.col(flow), F.lit(rate), F.col("t"))})


def bcr_series(df: DataFrame, keys: list[str], order: str, benefit: str, cost: str, rate: float) -> DataFrame:
    """Running discounted benefit over running discounted cost; null where the cost is 0."""
    df = df.withColumn("t", position(keys, order))
    by = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    total = lambda name: F.sum(discounted(F.col(name), F.lit(rate), F.col("t"))).over(by)
    return df.withColumn("bcr", F.try_divide(total(benefit), total(cost)))


def npv_of(flows: Column, rate: Column) -> Column:
    """Of an array of flows."""
    return F.aggregate(F.transform(flows, lambda x, t: x / F.pow(1 + rate, t)), F.lit(0.0), lambda a, x: a + x)


def mirr(flows: Column, finance: float, reinvest: float) -> Column:
    """(FV of gains / |PV of losses|) ** (1 / n) - 1; null without losses or gains or with a single flow."""
    n = F.size(flows) - 1
    losses = F.aggregate(F.transform(flows, lambda x, t: F.least(x, F.lit(0.0)) / F.pow(F.lit(1 + finance), t)), F.lit(0.0), lambda a, x: a + x)
    gains = F.aggregate(F.transform(flows, lambda x, t: F.greatest(x, F.lit(0.0)) * F.pow(F.lit(1 + reinvest), n - t)), F.lit(0.0), lambda a, x: a + x)
    return F.when((n > 0) & (losses < 0) & (gains > 0), F.pow(gains / F.abs(losses), 1 / n) - 1)


#: Fixed values of the rate search: its two guesses, most steps, and when it settles or gives up.
GUESS, SECOND, MOST_STEPS, SETTLED, FLAT = 0.1, 0.15, 100, 1e-6, 1e-10


def powers(base: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The C library's powers, which numpy's own differ from in the last bit."""
    wide = np.broadcast_to(base[:, None], (len(base), len(times)))
    found = pc.power(pa.array(wide.ravel()), pa.array(np.broadcast_to(times, wide.shape).ravel()))
    return found.to_numpy(zero_copy_only=False).reshape(wide.shape)


def secant_rates(flows: np.ndarray) -> np.ndarray:
    """For each row of flows (padded with zeros) the rate at which its present value is 0, by secants of all rows at
    once; NaN where they don't settle. Where a search wanders before it settles, the last bit of a value decides where, so
    terms are divided by the C library's powers and added in the order of time."""
    times = np.arange(flows.shape[1], dtype=float)

    def value(rates: np.ndarray, rows: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            return np.add.accumulate(flows[rows] / powers(1 + rates, times), axis=1)[:, -1]

    out, rows = np.full(len(flows), np.nan), np.arange(len(flows))
    a, b = np.full(len(rows), GUESS), np.full(len(rows), SECOND)
    fa, fb = value(a, rows), value(b, rows)
    for _ in range(MOST_STEPS):
        good = np.isfinite(fa) & np.isfinite(fb) & (np.abs(fb - fa) >= FLAT)
        rows, a, b, fa, fb = rows[good], a[good], b[good], fa[good], fb[good]
        if not len(rows):
            break
        c = b - fb * (b - a) / (fb - fa)
        done = np.abs(c - b) < SETTLED
        out[rows[done]] = c[done]
        rows, a, fa, b = rows[~done], b[~done], fb[~done], c[~done]
        fb = value(b, rows)
    return out


@F.pandas_udf(DoubleType())
def irr(flows: pd.Series) -> pd.Series:
    """Internal rate of return of arrays of flows; null if there is none. A batch is one matrix."""
    sizes = np.array([0 if x is None else len(x) for x in flows])
    padded = np.zeros((len(flows), max(int(sizes.max(initial=0)), 1)))
    for at, own in enumerate(flows):
        padded[at, : sizes[at]] = own if own is not None else []
    found = secant_rates(padded)
    return pd.Series(np.where(sizes < 2, np.nan, found)).astype("Float64").where(lambda x: ~np.isnan(np.where(sizes < 2, np.nan, found)), pd.NA)


#: Numbers that the flows searched together may have, and flows that a key may have: years of a project.
CELLS, MOST_FLOWS = 1_000_000, 10_000


@F.pandas_udf(ArrayType(DoubleType()))
def prefix_irrs(flows: pd.Series) -> pd.Series:
    """For each array of flows, the internal rates of its prefixes, null where there is none. The flows of many keys are one
    matrix, and a prefix is its first columns, so no prefix is held by itself.

    Each search begins at the fixed guess, not at the rate of the prefix before: where it ends, and whether it settles at
    all, depends on where it begins."""
    sizes = np.array([len(x) for x in flows], int)
    out: list[list] = [[None] * n for n in sizes]
    order = np.argsort(sizes, kind="stable")  # keys with alike many flows are padded to each other
    low = 0
    while low < len(order):
        high = low + 1
        while high < len(order) and (high + 1 - low) * sizes[order[high]] <= CELLS:
            high += 1
        own, low = order[low:high], high
        padded = np.zeros((len(own), int(sizes[own[-1]])))
        for at, key in enumerate(own):
            padded[at, : sizes[key]] = flows.iloc[key]
        for width in range(2, padded.shape[1] + 1):
            first = int(np.searchsorted(sizes[own], width))
            for key, rate in zip(own[first:], secant_rates(padded[first:, :width]).tolist(), strict=True):
                out[key][width - 1] = None if math.isnan(rate) else rate
    return pd.Series(out)


def cumulative_rates(df: DataFrame, keys: list[str], order: str, flow: str, finance: float, reinvest: float) -> DataFrame:
    """IRR and MIRR of each prefix of a key's flows. A key's flows are gathered once, for the search alone; what MIRR
    needs are running sums. A key of more than MOST_FLOWS flows is an error."""
    by = W.partitionBy(*keys).orderBy(order)
    sofar, t = by.rowsBetween(W.unboundedPreceding, 0), F.row_number().over(by) - 1
    rows = df.withColumn("_t", t)
    losses = F.sum(F.least(F.col(flow), F.lit(0.0)) / F.pow(F.lit(1 + finance), F.col("_t"))).over(sofar)
    gains = F.sum(F.greatest(F.col(flow), F.lit(0.0)) / F.pow(F.lit(1 + reinvest), F.col("_t"))).over(sofar) * F.pow(F.lit(1 + reinvest), F.col("_t"))
    rows = rows.withColumn("_losses", losses).withColumn("_gains", gains)
    both = (F.col("_t") > 0) & (F.col("_losses") < 0) & (F.col("_gains") > 0)
    rows = rows.withColumn("mirr", F.when(both, F.pow(F.col("_gains") / F.abs("_losses"), 1 / F.col("_t")) - 1))
    whole = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_t", *(c for c in df.columns if c not in (*keys, "_t")), "mirr"))).alias("_rows"))
    checked = F.when(F.size("_rows") <= MOST_FLOWS, F.transform("_rows", lambda x: F.coalesce(x[flow].cast("double"), F.lit(0.0)))).otherwise(F.raise_error(F.lit(f"a key has more than {MOST_FLOWS} flows")))
    rated = whole.withColumn("_irr", prefix_irrs(checked))
    each = rated.select(*keys, F.explode(F.arrays_zip(F.col("_rows").alias("r"), F.col("_irr").alias("irr"))).alias("_x"))
    return each.select(*keys, "_x.r.*", "_x.irr").select(*df.columns, "irr", "mirr")


def avoided_loss(cv: Column, reduction: Column, absolute: bool = False) -> Column:
    """Mean shortfall avoided when a coefficient of variation falls: phi(0) times the fall, at least 0."""
    reduced = F.greatest(F.lit(0.0), cv - F.least(reduction, cv)) if absolute else cv * (1 - reduction)
    return F.greatest(F.lit(0.0), PHI0 * (cv - reduced))


def avoided_loss_sampled(spark: SparkSession, cv: float, reduction: float, runs: int = 9, draws: int = 200_000, seed: int = 1, given: DataFrame | None = None) -> DataFrame:
    """The same by draws below each sample's median: run, avoided, one row a run. given: draws of one's own (run, x, y in
    standard deviations), whose medians are exact; else normal draws are made and their medians approximated."""
    made = given if given is not None else spark.range(runs * draws).select((F.col("id") % runs).alias("run"), F.randn(seed).alias("x"), F.randn(seed + 1).alias("y"))
    base = made.select("run", (1 + cv * F.col("x")).alias("x"), (1 + cv * (1 - reduction) * F.col("y")).alias("y"))
    if given is not None:
        medians = matched(selection.medians(base, ["run"], "x", "mx").drop("n"), selection.medians(base, ["run"], "y", "my").drop("n"), ["run"])
    else:
        medians = base.groupBy("run").agg(F.percentile_approx("x", 0.5, 10000).alias("mx"), F.percentile_approx("y", 0.5, 10000).alias("my"))
    low = matched(base, small(medians), ["run"])  # one row a run
    sums = low.groupBy("run").agg(F.sum(F.when(F.col("x") <= F.col("mx"), F.col("x"))).alias("a"), F.sum(F.when(F.col("y") <= F.col("my"), F.col("y"))).alias("b"), F.sum("x").alias("all"))
    return sums.select("run", F.greatest(F.lit(0.0), F.try_divide(F.col("b") - F.col("a"), F.col("all"))).alias("avoided"))


def triangular(u: Column, low: float, mode: float, high: float) -> Column:
    """Inverse distribution at u; the mode if the three aren't in order."""
    if not low <= mode <= high or low == high:
        return F.lit(float(mode))
    cut = (mode - low) / (high - low)
    left = low + F.sqrt(u * (high - low) * (mode - low))
    right = high - F.sqrt((1 - u) * (high - low) * (high - mode))
    return F.when(u < cut, left).otherwise(right)


def simulate(flows: DataFrame, benefit: tuple[float, float, float], cost: tuple[float, float, float], rate: float | None = None, simulations: int = 2000, seed: int = 1, year: str = "year", given: DataFrame | None = None) -> DataFrame:
    """One row a simulation and year: npv, bcr, irr_pct, mirr_pct of the flows so far, under one benefit and one cost
    scale a simulation. flows: year, project_benefit, cost, discount_rate (read if no rate is given; else 0.12). given:
    draws of one's own (simulation, u, v between 0 and 1), so that runs can be told apart by nothing but their scales.

    The years of one project are few, so they are broadcast behind a check of their number.
    """
    years = flows.where(F.col(year).isNotNull() & ~F.isnan(F.col(year).cast("double")))
    if years.limit(1001).count() > 1000:
        raise ValueError("a project has at most 1000 years")
    if rate is None:
        first = years.where("discount_rate IS NOT NULL").orderBy(year).select("discount_rate").first()
        rate = 0.12 if first is None else float(first[0])
    made = given if given is not None else flows.sparkSession.range(simulations).select(F.col("id").alias("simulation"), F.rand(seed).alias("u"), F.rand(seed + 1).alias("v"))
    runs = made.select("simulation", triangular(F.col("u"), *benefit).alias("_b"), triangular(F.col("v"), *cost).alias("_c"))
    grid = runs.crossJoin(F.broadcast(years.select(year, "project_benefit", F.col("cost").alias("_cost"))))
    grid = grid.withColumn("benefit", F.col("project_benefit") * F.col("_b")).withColumn("cost", F.col("_cost") * F.col("_c")).withColumn("flow", F.col("benefit") - F.col("cost"))
    out = npv_series(grid, ["simulation"], year, "flow", rate)
    out = bcr_series(out, ["simulation"], year, "benefit", "cost", rate)
    out = cumulative_rates(out, ["simulation"], year, "flow", rate, rate)
    return out.select("simulation", year, "npv", "bcr", (F.col("irr") * 100).alias("irr_pct"), (F.col("mirr") * 100).alias("mirr_pct"))


def simulation_bands(simulated: DataFrame, year: str = "year") -> DataFrame:
    """Quantiles by year of all four, and the shares of NPV above 0 and BCR above 1."""
    bands = [c for name in ("npv", "bcr", "irr_pct", "mirr_pct") for c in quantile_summary(F.col(name), f"{name}_")]
    return simulated.groupBy(year).agg(*bands, exceedance(F.col("npv"), 0.0).alias("p_npv_positive"), exceedance(F.col("bcr"), 1.0).alias("p_bcr_above_one"))


def avoided_loss_uncertainty(spark: SparkSession, cv: float, reduction: float, runs: int = 9, draws: int = 200_000, seed: int = 1, given: DataFrame | None = None) -> DataFrame:
    """One row: p10, p50, p90, mean and n of the runs' avoided losses (absolute values), and the samples."""
    sampled = avoided_loss_sampled(spark, cv, reduction, runs, draws, seed, given).withColumn("avoided", F.abs("avoided"))
    return sampled.agg(*quantile_summary(F.col("avoided")), F.array_sort(F.collect_list("avoided")).alias("samples"))


def simulation_finals(simulated: DataFrame, year: str = "year") -> DataFrame:
    """One row: the same quantiles and shares over each simulation's last year, and the number of simulations; over no
    rows, n is 0 and the rest null."""
    last = simulated.groupBy("simulation").agg(*(F.max_by(name, year).alias(name) for name in ("npv", "bcr", "irr_pct", "mirr_pct")))
    finals = [c for name in ("npv", "bcr", "irr_pct", "mirr_pct") for c in quantile_summary(F.col(name), f"{name}_")]
    return last.agg(F.count(F.lit(1)).alias("simulations"), *finals, exceedance(F.col("npv"), 0.0).alias("p_npv_positive"), exceedance(F.col("bcr"), 1.0).alias("p_bcr_above_one"))
