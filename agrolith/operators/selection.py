"""Exact quantiles of groups of any size, by histograms that are refined where a wanted rank lies.

A first aggregate counts each group by powers of two and PARTS parts of each: data of a few orders of magnitude have some
thousand bins, and no data more than a million. A rank's bin is found from the counts; each further pass deals the rows of such bins to BINS narrower ones between the bin's least and
largest value. A pass is one aggregate of fixed size a group and rank, combined before it is shuffled, so a group with a third
of all rows is as much work for a task as any other. A bin of one value has its answer; a bin of at most SMALL rows is
sorted. The values of a bin differ at both ends, so every pass splits it.

Groups whose values are all null have no quantiles (null) and n 0. NaN and infinities take part only where the caller
leaves them; their order is that of Spark (NaN last) and they are ranked, not interpolated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import BROADCAST_ROWS, scanned, stored
from .ordered import matched

BINS, SMALL = 1024, 4096
#: Parts of a power of two in the first pass.
PARTS = 256
#: Above every binary exponent's size, so that the bins of positive and negative values are apart.
FAR = 1100
OPEN = ["_total", "_before", "_n", "_lo", "_hi", "_ranks"]


def power_bin(x: Column) -> Column:
    """Grows with x: by sign, binary exponent and its parts; infinities and NaN have bins of their own, null has none."""
    exponent = F.floor(F.log2(F.abs(x)))
    part = F.floor((F.abs(x) / F.pow(F.lit(2.0), exponent) - 1) * PARTS)
    size = (exponent + FAR) * PARTS + F.greatest(F.least(part, F.lit(PARTS - 1)), F.lit(0))
    odd = F.when(x.isNull(), None).when(F.isnan(x), 4 * FAR * PARTS).when(F.abs(x) == float("inf"), F.signum(x) * 3 * FAR * PARTS).when(x == 0, 0)
    return odd.when(x > 0, size).otherwise(-size).cast("int")


def even_bin(x: Column) -> Column:
    return F.floor((x - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * BINS).cast("int")


def counted(rows: DataFrame, keys: list[str], bin_: Column) -> DataFrame:
    return rows.groupBy(*keys, bin_.alias("_bin")).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))


def located(bins: DataFrame, keys: list[str]) -> DataFrame:
    """The bins that hold wanted ranks, with these. bins: keys, _total, _before and _ranks of what was split, and its bins."""
    order = W.partitionBy(*keys, "_before").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    placed = bins.withColumn("_at", F.col("_before") + F.coalesce(F.sum("_n").over(order), F.lit(0)))
    held = placed.withColumn("_ranks", F.filter("_ranks", lambda r: (r >= F.col("_at")) & (r < F.col("_at") + F.col("_n"))))
    return held.where(F.size("_ranks") > 0).select(*keys, "_total", F.col("_at").alias("_before"), "_n", "_lo", "_hi", "_ranks")


def within(rows: DataFrame, open_: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that lie in open bins, with these. Few bins stand beside every task; many meet the rows by a join on the
    keys, whose long keys adaptive execution splits."""
    side = open_.select(*(F.col(k).alias(f"_k{at}") for at, k in enumerate(keys)), *OPEN)
    side = F.broadcast(side) if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else side
    same = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    for at, key in enumerate(keys):
        same &= rows[key].eqNullSafe(F.col(f"_k{at}"))
    return rows.join(side, same).drop(*(f"_k{at}" for at in range(len(keys))))


def ranked(rows: DataFrame, keys: list[str], ranks: Column) -> tuple[DataFrame, DataFrame]:
    """(keys and _values: rank -> value; keys, _total and _mean of every group). rows: keys and _v; ranks: an array of ranks
    from 0, by _total."""
    first = stored(rows.groupBy(*keys, power_bin(F.col("_v")).alias("_bin")).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_v").alias("_sum")), "bins")
    totals = first.groupBy(*keys).agg(F.sum("_n").alias("_total"), F.sum("_sum").alias("_sum"), F.min("_lo").alias("_least"), F.max("_hi").alias("_most"))
    totals = totals.withColumn("_total", F.coalesce("_total", F.lit(0))).withColumn("_mean", F.try_divide("_sum", "_total"))
    whole = totals.where("_total > 0").withColumn("_ranks", F.array_distinct(ranks)).withColumn("_before", F.lit(0).cast("long"))
    few = whole.where(F.col("_total") <= SMALL).select(*keys, "_total", "_before", F.col("_total").alias("_n"), F.col("_least").alias("_lo"), F.col("_most").alias("_hi"), "_ranks")
    many = matched(first.where("_n > 0").drop("_sum"), whole.select(*keys, "_total", "_ranks", "_before").where(F.col("_total") > SMALL), keys).where(F.col("_total").isNotNull())
    bins = stored(few.unionByName(located(many, keys)), "bins")
    narrow, solved = (F.col("_n") <= SMALL) | (F.col("_lo") == F.col("_hi")), None
    while True:
        solved = bins.where(narrow) if solved is None else solved.unionByName(bins.where(narrow))
        open_ = bins.where(~narrow)
        if not open_.limit(1).count():
            break
        split = counted(within(rows, open_, keys), [*keys, "_total", "_before", "_ranks"], even_bin(F.col("_v")))
        bins = stored(located(split, keys), "bins")
    one = solved.where(F.col("_lo") == F.col("_hi")).select(*keys, F.explode("_ranks").alias("_rank"), F.col("_lo").alias("_value"))
    rest = within(rows, solved.where(F.col("_lo") < F.col("_hi")), keys).groupBy(*keys, "_before", "_ranks").agg(F.array_sort(F.collect_list("_v")).alias("_all"))
    rest = rest.withColumn("_rank", F.explode("_ranks")).select(*keys, "_rank", F.get("_all", (F.col("_rank") - F.col("_before")).cast("int")).alias("_value"))
    found = one.unionByName(rest).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_values"))
    return found, totals


def quantiles(df: DataFrame, keys: list[str], value: str | Column, shares: dict[str, float], upper: dict[str, Callable[[Column], Column]] | None = None, mean: str | None = None) -> DataFrame:
    """keys, the quantiles by name, the mean if it has a name, and n: each group's interpolated quantiles at the shares
    (linear between neighbours, as percentile). upper: further columns, values at a rank from 0 that is a function of the
    count. One row a group of df."""
    upper = upper or {}
    column = F.col(value) if isinstance(value, str) else value
    rows = scanned(df.select(*keys, column.cast("double").alias("_v")), "values")
    n = F.col("_total")
    # ranks are exact up to 2 ** 53 rows
    at = {name: (n - 1).cast("double") * F.lit(float(share)) for name, share in shares.items()}
    wanted = [f(p).cast("long") for p in at.values() for f in (F.floor, F.ceil)] + [rank(n).cast("long") for rank in upper.values()]
    found, totals = ranked(rows, keys, F.array(*wanted))

    def between(p: Column) -> Column:
        low, high = F.col("_values")[F.floor(p).cast("long")], F.col("_values")[F.ceil(p).cast("long")]
        return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)

    columns = [between(p).alias(name) for name, p in at.items()] + [F.col("_values")[rank(n).cast("long")].alias(name) for name, rank in upper.items()]
    columns += [F.col("_mean").alias(mean)] if mean else []
    return matched(totals, found, keys).select(*keys, *columns, n.alias("n"))


def summary(df: DataFrame, keys: list[str], value: str | Column, prefix: str = "") -> DataFrame:
    """keys, p10, p50, p90, mean and n over finite values."""
    column = (F.col(value) if isinstance(value, str) else value).cast("double")
    finite = F.when(~F.isnan(column) & (F.abs(column) != float("inf")), column)
    found = quantiles(df.select(*keys, finite.alias("_f")), keys, "_f", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, mean="mean")
    return found.select(*keys, *(F.col(c).alias(f"{prefix}{c}") for c in ("p10", "p50", "p90", "mean", "n")))


def medians(df: DataFrame, keys: list[str], value: str | Column, name: str = "median") -> DataFrame:
    """keys, the median and n."""
    return quantiles(df, keys, value, {name: 0.5})


def upper_medians(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """keys, the element n // 2 of the sorted values, and n."""
    return quantiles(df, keys, value, {}, {name: lambda n: F.floor(n / 2)})
