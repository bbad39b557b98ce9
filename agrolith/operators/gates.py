"""Data-quality gates: each gives rows with flags or a report row; nothing is dropped unless its name says so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .aggregates import median_band
from .ordered import previous
from agrolith.functions.columns import product_holds, ratio_within


def serve_gate(report: DataFrame) -> DataFrame:
    """report: unattributed, max_share_pct, counties, dual_ok, shared, additivity_pct, verified -> served, label.

    dual_ok and additivity_pct may be null. The worst printed column may exceed its total by 2 %.
    """
    dual = F.coalesce((F.col("dual_ok") >= 0.98) & (F.col("shared") >= 5), F.lit(False))
    adds = F.coalesce(F.col("additivity_pct") >= 97, F.lit(False))
    sound = (F.col("unattributed") == 0) & (F.coalesce(F.col("max_share_pct"), F.lit(0.0)) <= 102) & (F.col("counties") >= 4)
    served = F.coalesce(F.col("verified"), F.lit(False)) | (sound & (dual | adds))
    label = F.when(F.coalesce(F.col("verified"), F.lit(False)), "verified by hand").when(sound & dual & adds, "two engines and totals").when(sound & dual, "two engines").when(sound & adds, "printed totals").otherwise("not served")
    return report.withColumn("served", served).withColumn("validation", label)


def best_of(df: DataFrame, keys: list[str], *score: str) -> DataFrame:
    """The row with the greatest score, compared column by column."""
    chosen = df.groupBy(*keys).agg(F.max(F.struct(*score, F.struct(*df.columns).alias("_row"))).alias("_top"))
    return chosen.select("_top._row.*")


def agreement(compared: DataFrame) -> DataFrame:
    """Shared cells and the share that agrees, from relational.reconcile()."""
    shared = F.count_if(F.col("state").isin("agree", "differ"))
    return compared.agg(shared.alias("shared"), F.try_divide(F.count_if(F.col("state") == "agree"), shared).alias("dual_ok"))


def row_sum_gate(df: DataFrame, parts: list[str], low: float = 97, high: float = 103, least: int = 6) -> DataFrame:
    """rows, bad rows and whether all rows' parts sum to within the limits and there are enough. A missing header stops."""
    if absent := [p for p in parts if p not in df.columns]:
        raise ValueError(f"no column {', '.join(absent)}")
    total = sum((F.coalesce(F.col(p), F.lit(0)) for p in parts), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~total.between(low, high)).alias("bad_rows"), ((F.count_if(~total.between(low, high)) == 0) & (F.count(F.lit(1)) >= least)).alias("passed"))


def index_gate(df: DataFrame, key: str, page: str, page_size: int, expected: int | Column, pattern: str, echo: str | None = None, order: str | None = None) -> DataFrame:
    """Completeness of a paged harvest: rows, unique keys, repeats, pages, malformed keys, and whether all are as expected.
    expected: the count that the source states. echo: the page number that the source gave back. order: what must fall
    (or stay) from page to page, by the largest of a page against the least of the one before."""
    n, unique, pages = F.count(F.lit(1)), F.countDistinct(key), F.countDistinct(page)
    bad = F.count_if(~F.col(key).cast("string").rlike(pattern))
    wanted = F.lit(expected) if isinstance(expected, int) else expected
    tests = [n == wanted, unique == n, pages == F.ceil(wanted / page_size), bad == 0]
    found = [n.alias("rows"), unique.alias("unique_keys"), (n - unique).alias("repeats"), pages.alias("pages"), bad.alias("malformed")]
    if echo:
        wrong = F.count_if(~F.col(echo).eqNullSafe(F.col(page)))
        found.append(wrong.alias("wrong_echoes"))
        tests.append(wrong == 0)
    whole = df.agg(*found, *(t.alias(f"_t{at}") for at, t in enumerate(tests)))
    complete = [F.col(f"_t{at}") for at in range(len(tests))]
    if order:
        each = df.groupBy(page).agg(F.max(order).alias("_high"), F.min(order).alias("_low"))
        steps = previous(each, [], [F.col(page).asc()], {"_before": "_low"})
        whole = whole.crossJoin(steps.agg(F.count_if(F.col("_high") > F.col("_before")).alias("out_of_order")))
        complete.append(F.col("out_of_order") == 0)
    passed = complete[0]
    for test in complete[1:]:
        passed = passed & test
    return whole.withColumn("complete", passed).drop(*(f"_t{at}" for at in range(len(tests))))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")).where("times > 1")


def constant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, distinct values (up to two are told apart), constant."""
    firsts = df.agg(*(F.min(F.col(c).cast("string")).alias(f"a_{c}") for c in columns), *(F.max(F.col(c).cast("string")).alias(f"b_{c}") for c in columns))
    entries = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")).alias("constant")) for c in columns))
    return firsts.select(F.inline(entries))


def plausible_years(df: DataFrame, keys: list[str], value: str, confirmed: Column) -> DataFrame:
    """Drops values beyond half of their key's confirmed median."""
    return median_band(df, keys, value, confirmed)


def identity_gate(df: DataFrame, keys: list[str], year: str, quantity: str, price: str, value: str) -> DataFrame:
    """Rows where quantity x price = value holds, less both years of keys whose quantities leave the ratio band."""
    sound = df.where(product_holds(F.col(quantity), F.col(price), F.col(value)))
    ordered = W.partitionBy(*keys).orderBy(year)
    jumps = sound.withColumn("_ok", F.coalesce(ratio_within(F.col(quantity), F.lag(quantity).over(ordered)), F.lit(True)))
    bad = jumps.where("NOT _ok").select(*keys).distinct()
    return sound.join(bad, keys, "left_anti")


def qc_flags(df: DataFrame, market: str, date: str, price: str, unit: str, county: str, units: list[str], bulk_rows: int, keys: list[str]) -> DataFrame:
    """qc_flag: all that is wrong with a quote, joined by `;`, empty if nothing is. Flags, doesn't drop."""
    medians = df.where(F.col(price) > 0).groupBy(market, date).agg(F.percentile(price, 0.5).alias("_median"))
    bulk = df.groupBy(date).agg(F.count(F.lit(1)).alias("_on_day"))
    times = F.count(F.lit(1)).over(W.partitionBy(*keys))
    joined = df.withColumn("_times", times).join(medians, [market, date], "left").join(bulk, date, "left")
    ratio = F.try_divide(F.col(price), F.col("_median"))
    flags = F.concat_ws(";", F.when(F.col("_on_day") > bulk_rows, "bulk_day"), F.when(F.col("_times") > 1, "duplicate"), F.when(F.col(county).isNull(), "bad_county"), F.when(F.coalesce(F.col(price) <= 0, F.lit(True)), "nonpositive"), F.when((ratio > 5) | (ratio < 0.2), "outlier"), F.when(~F.col(unit).isin(*units), "unexpected_unit"))
    return joined.withColumn("qc_flag", flags).drop("_times", "_median", "_on_day")


def suspects(df: DataFrame, keys: list[str], year: str, value: str, others: list[str], product: str | None = None, identity: tuple[str, str, str] | None = None) -> DataFrame:
    """suspect and suspect_reason, the first that holds: far below the key's other years, the same values as another
    year, with product the same values as another product of the key and year, with identity (quantity, price, value) a
    product that doesn't hold. Rows are kept."""
    by = W.partitionBy(*keys)
    most = F.max(value).over(by)
    same = F.count(F.lit(1)).over(W.partitionBy(*keys, value, *others))
    reason = F.when((F.col(value) < 0.1 * most), "under_entry").when(same > 1, "identical_years")
    if product:
        alike = W.partitionBy(*(k for k in keys if k != product), year, value, *others)
        reason = reason.when(F.min(product).over(alike) != F.max(product).over(alike), "identical_products")
    if identity:
        reason = reason.when(~product_holds(*map(F.col, identity)), "identity")
    return df.withColumn("suspect_reason", reason).withColumn("suspect", reason.isNotNull())


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free content sum, in which repeated rows count."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("content"))


def totals_gate(df: DataFrame, keys: list[str], parts: list[str], total: str, tolerance: float = 0.5) -> DataFrame:
    """Whether the parts sum to the printed total and every cell is filled."""
    added = sum((F.coalesce(F.col(p), F.lit(0.0)) for p in parts), F.lit(0.0))
    empty = sum((F.when(F.col(p).isNull(), 1).otherwise(0) for p in [*parts, total]), F.lit(0))
    return df.select(*keys, added.alias("parts_sum"), F.col(total), empty.alias("empty_cells"), (F.coalesce(F.abs(added - F.col(total)) <= tolerance, F.lit(False)) & (empty == 0)).alias("passed"))


def edition_diff(old: DataFrame, new: DataFrame, keys: list[str], value: str, absolute: float = 1.0, relative: float = 0.005) -> DataFrame:
    """Cells of both editions that differ by more than the larger of an absolute and a relative limit."""
    joined = old.select(*keys, F.col(value).alias("old_value")).join(new.select(*keys, F.col(value).alias("new_value")), keys)
    change = F.col("new_value") - F.col("old_value")
    return joined.withColumn("change", change).where(F.abs(change) > F.greatest(F.lit(absolute), relative * F.abs("old_value")))


def missing_keys(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(found.select(*keys).distinct(), keys, "left_anti")


def metadata_state(record: DataFrame) -> DataFrame:
    """has_record, has_catalogue, valid, draft -> state; has_file, url, restricted -> hosting and whether to link."""
    state = F.when(F.col("has_record") & ~F.col("valid"), "invalid").when(F.col("has_record") & F.col("draft"), "draft").when(F.col("has_record"), "authored").when(F.col("has_catalogue"), "catalogue-only").otherwise("undocumented")
    hosting = F.when(F.col("restricted"), "restricted").when(F.col("has_file"), "hosted").when(F.col("url").isNotNull(), "linked").otherwise("none")
    return record.withColumn("state", state).withColumn("hosting", hosting).withColumn("link", F.when(hosting.isin("hosted", "linked"), F.col("url")))


def audit(tables: DataFrame, served: DataFrame, key: str, least: int = 4) -> DataFrame:
    """Tables with enough counties, and whether they are served."""
    marks = served.select(key).distinct().withColumn("served", F.lit(True))
    return tables.where(F.col("counties") >= least).join(marks, key, "left").withColumn("served", F.coalesce("served", F.lit(False)))
