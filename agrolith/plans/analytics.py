"""Queries of aggregates, ordered operators, seasons, finance, gates and events.

Nations stand for counties, part types for commodities, order dates for the calendar, extended prices for prices and
quantities for weights.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from agrolith.functions import columns as C
from agrolith.operators import aggregates as A
from agrolith.operators import finance, gates, seasonal, selection
from agrolith.streaming import events as E

from .registry import query, table


def nation_orders(spark, sf_dir):
    """Orders with their customer's nation: (nation, year, month, o_orderdate, o_orderstatus, o_totalprice, o_orderkey)."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return orders.select("nation", F.year("o_orderdate").cast("long").alias("year"), F.month("o_orderdate").cast("long").alias("month"), "o_orderdate", "o_orderstatus", "o_totalprice", "o_orderkey", "o_custkey")


NATION_ORDERS = "WITH o AS (SELECT c_nationkey AS nation, year(o_orderdate) AS year, month(o_orderdate) AS month, o_orderdate, o_orderstatus, o_totalprice, o_orderkey, o_custkey FROM orders JOIN customer ON o_custkey = c_custkey)\n"


def nation_years(spark, sf_dir):
    return nation_orders(spark, sf_dir).groupBy("nation", "year").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count(F.lit(1)).alias("n"))


NATION_YEARS = NATION_ORDERS + ", y AS (SELECT nation, year, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM o GROUP BY ALL)\n"


# aggregates


@query("weighted_mean_monthly", "SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS mean_price FROM lineitem GROUP BY ALL")
def weighted_mean_monthly(spark, sf_dir):
    keys = [F.year("l_shipdate").cast("long").alias("year"), F.month("l_shipdate").cast("long").alias("month"), "l_returnflag"]
    return table(spark, sf_dir, "lineitem").groupBy(*keys).agg(F.round(A.weighted_mean(F.col("l_extendedprice"), F.col("l_quantity")), 4).alias("mean_price"))


@query("positive_sums", "SELECT c_nationkey, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1 HAVING sum(c_acctbal) > 0")
def positive_sums(spark, sf_dir):
    return A.positive_sums(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal", "balance").withColumn("balance", F.round("balance", 2))


@query("value_counts", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def value_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


@query("mode_per_user", "SELECT user_id, event_type AS mode, n AS mode_count, total FROM (SELECT user_id, event_type, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY user_id) AS BIGINT) AS total, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS place FROM events GROUP BY 1, 2) WHERE place = 1")
def mode_per_user(spark, sf_dir):
    return A.modes(table(spark, sf_dir, "events"), ["user_id"], "event_type")


@query("mode_gate", "SELECT event_id, user_id, event_type FROM events JOIN (SELECT user_id AS u, event_type AS mode FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS place FROM events GROUP BY 1, 2) WHERE place = 1 AND n >= 5) ON user_id = u AND event_type = mode")
def mode_gate(spark, sf_dir):
    return A.mode_gate(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), ["user_id"], "event_type", 5).select("event_id", "user_id", "event_type")


@query("longest_label", "SELECT lang, doc_id, length(text) AS size FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY length(text) DESC, doc_id DESC) = 1")
def longest_label(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id", F.length("text").cast("long").alias("size"))
    return docs.groupBy("lang").agg(F.max(F.struct("size", "doc_id")).alias("t")).select("lang", "t.doc_id", "t.size")


@query("latest_per_key", "SELECT o_custkey, o_totalprice AS latest FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_per_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(A.latest("o_totalprice", "o_orderdate", "o_orderkey").alias("latest"))


@query("span_per_key", "SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1")
def span_per_key(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("coverage_by_lang", "SELECT lang, round(100.0 * avg(CASE WHEN l.doc_id IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS labelled_pct FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def coverage_by_lang(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").withColumn("has", F.lit(True)), "doc_id", "left")
    return rows.groupBy("lang").agg(F.round(A.coverage(F.col("has").isNotNull()), 6).alias("labelled_pct"))


@query("distinct_lists", "SELECT c_nationkey, list_sort(list(DISTINCT c_mktsegment)) [1] AS first_segment, len(list(DISTINCT c_mktsegment)) AS n FROM customer GROUP BY 1")
def distinct_lists(spark, sf_dir):
    lists = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_set("c_mktsegment")).alias("s"))
    return lists.select("c_nationkey", F.get("s", F.lit(0)).alias("first_segment"), F.size("s").cast("long").alias("n"))


@query("quantile_summary", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 4) AS p10, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, round(avg(l_extendedprice), 4) AS mean, count(l_extendedprice) AS n FROM lineitem GROUP BY 1")
def quantile_summary(spark, sf_dir):
    summary = selection.summary(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return summary.select("l_returnflag", *(F.round(c, 4).alias(c) for c in ("p10", "p50", "p90", "mean")), "n")


@query("exceedance_prob", "SELECT o_orderpriority, round(avg(CASE WHEN o_totalprice > 150000 THEN 1.0 ELSE 0.0 END), 6) AS p FROM orders GROUP BY 1")
def exceedance_prob(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.round(A.exceedance(F.col("o_totalprice"), 150000.0), 6).alias("p"))


@query("geomean_index", "SELECT p_partkey, round(pow((p_size / 50.0) * (p_retailprice / 2000.0) * 0.5 * 0.75, 0.25), 6) AS readiness FROM part")
def geomean_index(spark, sf_dir):
    parts = [F.col("p_size") / 50.0, F.col("p_retailprice") / 2000.0, F.lit(0.5), F.lit(0.75)]
    return table(spark, sf_dir, "part").select("p_partkey", F.round(C.geometric_mean(*parts), 6).alias("readiness"))


@query("share_apportion", "SELECT s_suppkey, round(CASE WHEN sum(w) OVER p > 0 THEN w / sum(w) OVER p ELSE s_suppkey / sum(s_suppkey) OVER p END, 8) AS share FROM (SELECT *, CASE WHEN s_nationkey % 4 = 0 THEN 0.0 ELSE greatest(s_acctbal, 0) END AS w FROM supplier) WINDOW p AS (PARTITION BY s_nationkey)")
def share_apportion(spark, sf_dir):
    weight = F.when(F.col("s_nationkey") % 4 == 0, 0.0).otherwise(F.greatest("s_acctbal", F.lit(0.0)))
    return A.shares(table(spark, sf_dir, "supplier").withColumn("w", weight), ["s_nationkey"], "w", "s_suppkey").select("s_suppkey", F.round("share", 8).alias("share"))


@query("median_price_month", "SELECT p_type, year(l_shipdate) AS year, month(l_shipdate) AS month, round(median(l_extendedprice / l_quantity), 9) AS median_price, count(*) AS n_quotes FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'F' GROUP BY ALL")
def median_price_month(spark, sf_dir):
    """A price in cents over a quantity below 64 ends within seven digits, or not at all, so a mean of two middle prices has no
    half at the ninth digit."""
    rows = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").join(table(spark, sf_dir, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    quotes = rows.select("p_type", F.year("l_shipdate").cast("long").alias("year"), F.month("l_shipdate").cast("long").alias("month"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    found = selection.medians(quotes, ["p_type", "year", "month"], "price", "median_price")
    return found.withColumn("median_price", F.round("median_price", 9)).withColumnRenamed("n", "n_quotes")


@query("terms_of_trade", "SELECT year(l_shipdate) AS year, round(median(l_extendedprice) FILTER (l_returnflag = 'A') / nullif(median(l_extendedprice) FILTER (l_returnflag = 'N'), 0), 6) AS terms FROM lineitem GROUP BY 1")
def terms_of_trade(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").cast("long").alias("year"), "l_returnflag", "l_extendedprice")
    found = selection.medians(lines, ["year", "l_returnflag"], "l_extendedprice")  # one row a year and flag
    price = lambda flag: F.max(F.when(F.col("l_returnflag") == flag, F.col("median")))
    return found.groupBy("year").agg(F.round(F.try_divide(price("A"), price("N")), 6).alias("terms"))


@query("additivity", "SELECT l_orderkey, round(sum(l_quantity), 2) AS parts_sum, 100.0 AS total, round(100 * sum(l_quantity) / 100.0, 1) AS additivity_pct FROM lineitem GROUP BY 1")
def additivity(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    totals = lines.select("l_orderkey").distinct().withColumn("total", F.lit(100.0))
    return A.additivity(lines, totals, ["l_orderkey"], "l_quantity", "total").withColumn("parts_sum", F.round("parts_sum", 2))


@query("pivot_long_wide", "SELECT l_returnflag, round(sum(l_quantity) FILTER (l_linestatus = 'F'), 2) AS F, round(sum(l_quantity) FILTER (l_linestatus = 'O'), 2) AS O FROM lineitem GROUP BY 1")
def pivot_long_wide(spark, sf_dir):
    sums = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("q"))
    return A.wide(sums, ["l_returnflag"], "l_linestatus", "q", ["F", "O"])


@query("melt_prices", "SELECT p_partkey, 'retail' AS price_type, p_retailprice AS price FROM part UNION ALL SELECT p_partkey, 'wholesale', round(p_retailprice * 0.8, 2) FROM part")
def melt_prices(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("retail"), F.round(F.col("p_retailprice") * 0.8, 2).alias("wholesale"))
    return A.long(parts, ["p_partkey"], ["retail", "wholesale"], "price_type", "price")


# ordered


@query("top_k_per_nation", "SELECT c_nationkey, c_custkey, place FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer) WHERE place <= 3")
def top_k_per_nation(spark, sf_dir):
    top = A.top_k(table(spark, sf_dir, "customer"), ["c_nationkey"], 3, F.desc("c_acctbal"), F.asc("c_custkey"))
    return top.select("c_nationkey", "c_custkey", F.col("place").cast("long").alias("place"))


@query("rank_in_subset", "SELECT c_custkey, rank() OVER (ORDER BY c_acctbal DESC) AS place FROM customer WHERE c_nationkey = 7")
def rank_in_subset(spark, sf_dir):
    from pyspark.sql import Window as W

    # one nation's customers; the constant key says so to the planner
    rows = table(spark, sf_dir, "customer").where("c_nationkey = 7")
    return rows.select("c_custkey", F.rank().over(W.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"))).cast("long").alias("place"))


@query("running_total", "SELECT user_id, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS running FROM events")
def running_total(spark, sf_dir):
    return A.running(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("value"), "running").select("user_id", "event_id", F.round("running", 4).alias("running"))


@query("consecutive_repeats", "SELECT event_id, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) = event_type, false) AS repeated FROM events")
def consecutive_repeats(spark, sf_dir):
    return A.repeats_before(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "repeated")


@query("gap_clusters", """
WITH g AS (SELECT s_nationkey, s_acctbal, s_suppkey, s_acctbal - lag(s_acctbal) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal) AS gap FROM supplier),
r AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY gap DESC NULLS LAST, s_acctbal) AS place FROM g)
SELECT s_suppkey, CAST(sum(CASE WHEN gap IS NOT NULL AND place <= 2 THEN 1 ELSE 0 END) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM r""")
def gap_clusters(spark, sf_dir):
    return A.split_at_gaps(table(spark, sf_dir, "supplier"), ["s_nationkey"], "s_acctbal", 3).select("s_suppkey", F.col("cluster").cast("long").alias("cluster"))


@query("segments_since_head", "SELECT event_id, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM events")
def segments_since_head(spark, sf_dir):
    return A.groups_since(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", "segment").select("event_id", F.col("segment").cast("long").alias("segment"))


@query("upper_median", "SELECT c_nationkey, list_sort(list(c_acctbal))[len(list(c_acctbal)) // 2 + 1] AS median FROM customer GROUP BY 1")
def upper_median(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(A.upper_median("c_acctbal").alias("median"))


@query("detrended", NATION_YEARS + ", f AS (SELECT nation, regr_slope(total, year) AS s, regr_intercept(total, year) AS i FROM y GROUP BY 1) SELECT y.nation, year, round(s / 1e6, 4) AS trend_slope, round((total - (i + s * year)) / 1e6, 4) AS anomaly FROM y JOIN f USING (nation)")
def detrended(spark, sf_dir):
    return A.detrended(nation_years(spark, sf_dir), ["nation"], "year", "total").select("nation", "year", F.round(F.col("trend_slope") / 1e6, 4).alias("trend_slope"), F.round(F.col("anomaly") / 1e6, 4).alias("anomaly"))


# seasons


MONTHLY = NATION_ORDERS + ", m AS (SELECT nation, year, month, sum(o_totalprice) AS total FROM o WHERE (nation + year + month) % 5 <> 0 GROUP BY ALL)\n"


@query("seasonal_3m_mean", MONTHLY + """, s(season, k) AS (VALUES ('DJF', 1), ('JFM', 2), ('FMA', 3), ('MAM', 4), ('AMJ', 5), ('MJJ', 6), ('JJA', 7), ('JAS', 8), ('ASO', 9), ('SON', 10), ('OND', 11), ('NDJ', 12))
SELECT nation, CAST((idx - idx_k) AS BIGINT) AS season_year, season, round(avg(total), 2) AS season_mean FROM (
  SELECT nation, season, total, (year * 12 + month - 1) AS abs_month, k, (year * 12 + month - 1 - d.d) // 12 AS idx, 0 AS idx_k, (year * 12 + month - 1 - d.d) % 12 + 1 AS middle
  FROM m CROSS JOIN (VALUES (-1), (0), (1)) d(d) JOIN s ON k = (year * 12 + month - 1 - d.d) % 12 + 1)
GROUP BY 1, 2, 3 HAVING count(*) = 3""")
def seasonal_3m_mean(spark, sf_dir):
    months = nation_orders(spark, sf_dir).where("(nation + year + month) % 5 <> 0").groupBy("nation", "year", "month").agg(F.sum("o_totalprice").alias("total"))
    means = seasonal.seasonal_means(months, ["nation"], "year", "month", "total")
    return means.select("nation", F.col("season_year").cast("long").alias("season_year"), "season", F.round("season_mean", 2).alias("season_mean"))


BASE = NATION_ORDERS + """, v AS (SELECT nation, year * 12 + month AS year, sum(o_totalprice) AS total FROM o GROUP BY ALL),
b AS (SELECT nation, avg(total) AS mean, stddev_samp(total) AS sd, quantile_cont(total, 1.0/3) AS t1, quantile_cont(total, 2.0/3) AS t2, count(*) AS n FROM v WHERE year BETWEEN 23940 AND 24000 GROUP BY 1 HAVING count(*) >= 20)
"""


def monthly_totals(spark, sf_dir):
    return nation_orders(spark, sf_dir).groupBy("nation", (F.col("year") * 12 + F.col("month")).alias("year")).agg(F.sum("o_totalprice").alias("total"))


@query("baseline_tercile", BASE + "SELECT nation, round(mean, 2) AS clim_mean, round(sd, 2) AS clim_sd, round(t1, 2) AS t1, round(t2, 2) AS t2, n AS n_years FROM b")
def baseline_tercile(spark, sf_dir):
    base = seasonal.baseline(monthly_totals(spark, sf_dir), ["nation"], "year", "total", 23940, 24000)
    return base.select("nation", *(F.round(c, 2).alias(c) for c in ("clim_mean", "clim_sd", "t1", "t2")), "n_years")


@query("anomaly_pct", BASE + "SELECT nation, year, round((total - mean) / nullif(mean, 0) * 100, 4) AS anomaly_pct, CASE WHEN total <= t1 THEN 'Dry' WHEN total > t2 THEN 'Wet' ELSE 'Near' END AS tercile FROM v JOIN b USING (nation)")
def anomaly_pct(spark, sf_dir):
    rows = seasonal.anomalies(monthly_totals(spark, sf_dir), ["nation"], "year", "total", 23940, 24000)
    return rows.select("nation", "year", F.round("anomaly_pct", 4).alias("anomaly_pct"), "tercile")


@query("failed_runs", BASE + ", w AS (SELECT nation, year, year - row_number() OVER (PARTITION BY nation ORDER BY year) AS i FROM v JOIN b USING (nation) WHERE total <= t1) SELECT nation, min(year) AS run_start, max(year) AS run_end, count(*) AS run_length FROM w GROUP BY nation, i")
def failed_runs(spark, sf_dir):
    rows = seasonal.anomalies(monthly_totals(spark, sf_dir), ["nation"], "year", "total", 23940, 24000)
    return seasonal.failed_runs(rows, ["nation"], "year", F.col("tercile") == "Dry")


@query("contingency_matrix", "SELECT o_orderpriority, count(*) AS n, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END), 6) AS p_f, round(avg(CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0 END), 6) AS p_o, round(avg(CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE 0 END), 6) AS p_p FROM orders GROUP BY 1")
def contingency_matrix(spark, sf_dir):
    rows = seasonal.contingency(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])
    return rows.select("o_orderpriority", "n", *(F.round(c, 6).alias(c) for c in ("p_f", "p_o", "p_p")))


@query("ols_teleconnection", "SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, round(corr(l_extendedprice, l_quantity), 6) AS r, count(*) AS n FROM lineitem GROUP BY 1")
def ols_teleconnection(spark, sf_dir):
    fit = seasonal.regression(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity", 8)
    return fit.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"), F.round("r2", 6).alias("r2"), F.round("r", 6).alias("r"), "n")


@query("analogue_topk", NATION_YEARS + """, p AS (SELECT a.nation, a.year, b.year AS analogue, sqrt((a.n - b.n) * (a.n - b.n) + (a.total / 1e6 - b.total / 1e6) * (a.total / 1e6 - b.total / 1e6)) AS distance FROM y a JOIN y b ON a.nation = b.nation AND a.year <> b.year)
SELECT nation, year, analogue, round(distance, 6) AS distance, place FROM (SELECT *, row_number() OVER (PARTITION BY nation, year ORDER BY distance, analogue) AS place FROM p) WHERE place <= 3""")
def analogue_topk(spark, sf_dir):
    years = nation_years(spark, sf_dir).withColumn("total", F.col("total") / 1e6).withColumn("n", F.col("n").cast("double"))
    rows = seasonal.analogues(years, years, ["nation"], ["n", "total"], 3)
    return rows.select("nation", "year", "analogue", F.round("distance", 6).alias("distance"), F.col("place").cast("long").alias("place"))


@query("dekad_segments", "SELECT s_suppkey, m_start, m_end FROM (SELECT s_suppkey, ((s_suppkey * 7) % 36) // 3 + 1 AS a, ((s_suppkey * 7 + 8) % 36) // 3 + 1 AS b FROM supplier) CROSS JOIN LATERAL (SELECT a AS m_start, CASE WHEN a <= b THEN b ELSE 12 END AS m_end UNION ALL SELECT 1, b WHERE a > b)")
def dekad_segments(spark, sf_dir):
    first = C.dekad_month((F.col("s_suppkey") * 7) % 36 + 1)
    last = C.dekad_month((F.col("s_suppkey") * 7 + 8) % 36 + 1)
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(C.month_segments(first, last)).alias("s"))
    return rows.select("s_suppkey", F.col("s.m_start").cast("long").alias("m_start"), F.col("s.m_end").cast("long").alias("m_end"))


@query("gap_fill", """
WITH v AS (SELECT s_suppkey, s_nationkey, CAST(s_nationkey % 5 AS BIGINT) AS area, CASE WHEN s_suppkey % 3 = 0 OR s_nationkey = 4 THEN NULL ELSE s_acctbal END AS b FROM supplier),
n AS (SELECT s_nationkey, avg(b) AS m FROM v WHERE b IS NOT NULL GROUP BY 1), a AS (SELECT area, avg(b) AS m FROM v WHERE b IS NOT NULL GROUP BY 1)
SELECT s_suppkey, round(coalesce(b, n.m, a.m), 4) AS b, CASE WHEN b IS NOT NULL THEN 'own' WHEN n.m IS NOT NULL THEN 's_nationkey' WHEN a.m IS NOT NULL THEN 'area' END AS filled_from FROM v LEFT JOIN n USING (s_nationkey) LEFT JOIN a USING (area)""")
def gap_fill(spark, sf_dir):
    missing = (F.col("s_suppkey") % 3 == 0) | (F.col("s_nationkey") == 4)
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", (F.col("s_nationkey") % 5).cast("long").alias("area"), F.when(~missing, F.col("s_acctbal")).alias("b"))
    return seasonal.gap_filled(rows, "b", "s_nationkey", "area").select("s_suppkey", F.round("b", 4).alias("b"), "filled_from")


@query("adoption_curve", "SELECT n_nationkey, t, round(1000 * (1 - pow(1 - 0.05, t)), 6) AS adopted, round(1000 - 1000 / 1.62, 6) AS benefit FROM nation CROSS JOIN (SELECT unnest(range(0, 11)) AS t)")
def adoption_curve(spark, sf_dir):
    years = table(spark, sf_dir, "nation").select("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(10)).cast("array<bigint>")).alias("t"))
    return years.select("n_nationkey", "t", F.round(seasonal.adopted(F.lit(1000.0), F.lit(0.05), F.col("t")), 6).alias("adopted"), F.round(seasonal.total_benefit(F.lit(1000.0), F.lit(1.62)), 6).alias("benefit"))


# finance


def customer_flows(spark, sf_dir):
    """A customer's yearly flows: order totals less 150000."""
    years = nation_orders(spark, sf_dir).groupBy("o_custkey", "year").agg(F.round(F.sum("o_totalprice"), 2).alias("benefit"))
    return years.withColumn("cost", F.lit(150000.0)).withColumn("flow", F.col("benefit") - F.col("cost"))


FLOWS = NATION_ORDERS + ", f AS (SELECT o_custkey, year, round(sum(o_totalprice), 2) AS benefit, 150000.0 AS cost, round(sum(o_totalprice), 2) - 150000.0 AS flow, row_number() OVER (PARTITION BY o_custkey ORDER BY year) - 1 AS t, count(*) OVER (PARTITION BY o_custkey) AS k FROM o GROUP BY o_custkey, year)\n"


@query("running_discounted_npv", FLOWS + "SELECT o_custkey, year, t, round(sum(flow / pow(1.08, t)) OVER (PARTITION BY o_custkey ORDER BY year ROWS UNBOUNDED PRECEDING), 2) AS npv FROM f")
def running_discounted_npv(spark, sf_dir):
    rows = finance.npv_series(customer_flows(spark, sf_dir), ["o_custkey"], "year", "flow", 0.08)
    return rows.select("o_custkey", "year", F.col("t").cast("long").alias("t"), F.round("npv", 2).alias("npv"))


@query("bcr_series", FLOWS + "SELECT o_custkey, year, round(sum(benefit / pow(1.08, t)) OVER w / sum(cost / pow(1.08, t)) OVER w, 6) AS bcr FROM f WINDOW w AS (PARTITION BY o_custkey ORDER BY year ROWS UNBOUNDED PRECEDING)")
def bcr_series(spark, sf_dir):
    return finance.bcr_series(customer_flows(spark, sf_dir), ["o_custkey"], "year", "benefit", "cost", 0.08).select("o_custkey", "year", F.round("bcr", 6).alias("bcr"))


@query("mirr_customer", FLOWS + """, s AS (SELECT o_custkey, k - 1 AS n, sum(least(flow, 0) / pow(1.1, t)) AS losses, sum(greatest(flow, 0) * pow(1.12, k - 1 - t)) AS gains FROM f GROUP BY o_custkey, k)
SELECT o_custkey, CASE WHEN n > 0 AND losses < 0 AND gains > 0 THEN round(pow(gains / abs(losses), 1.0 / n) - 1, 6) END AS mirr FROM s""")
def mirr_customer(spark, sf_dir):
    flows = customer_flows(spark, sf_dir).groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("year", "flow"))), lambda x: x["flow"]).alias("flows"))
    return flows.select("o_custkey", F.round(finance.mirr(F.col("flows"), 0.10, 0.12), 6).alias("mirr"))


@query("avoided_loss_closed", "SELECT p_brand, round(greatest(0, 0.3989422804014327 * (cv - cv * 0.7)), 8) AS avoided FROM (SELECT p_brand, stddev_samp(p_retailprice) / avg(p_retailprice) AS cv FROM part GROUP BY 1)")
def avoided_loss_closed(spark, sf_dir):
    cv = table(spark, sf_dir, "part").groupBy("p_brand").agg((F.stddev_samp("p_retailprice") / F.avg("p_retailprice")).alias("cv"))
    return cv.select("p_brand", F.round(finance.avoided_loss(F.col("cv"), F.lit(0.3)), 8).alias("avoided"))


# gates


@query("gate_report", """
WITH r AS (SELECT p_type, 0 AS unattributed, 100.0 * max(p_size) / 50 AS max_share_pct, count(DISTINCT p_brand) AS counties, CASE WHEN count(*) % 2 = 0 THEN 0.99 END AS dual_ok, count(*) AS shared, 90.0 + count(*) % 11 AS additivity_pct, false AS verified FROM part GROUP BY 1)
SELECT p_type, unattributed = 0 AND max_share_pct <= 102 AND counties >= 4 AND (coalesce(dual_ok >= 0.98 AND shared >= 5, false) OR additivity_pct >= 97) AS served FROM r""")
def gate_report(spark, sf_dir):
    report = table(spark, sf_dir, "part").groupBy("p_type").agg(F.lit(0).alias("unattributed"), (100.0 * F.max("p_size") / 50).alias("max_share_pct"), F.countDistinct("p_brand").alias("counties"), F.when(F.count(F.lit(1)) % 2 == 0, 0.99).alias("dual_ok"), F.count(F.lit(1)).alias("shared"), (90.0 + F.count(F.lit(1)) % 11).alias("additivity_pct"), F.lit(False).alias("verified"))
    return gates.serve_gate(report).select("p_type", "served")


@query("qc_flags", """
WITH q AS (SELECT l_orderkey, l_linenumber, l_suppkey AS market, CAST(date_trunc('year', l_shipdate) AS DATE) AS day, l_extendedprice AS price, l_returnflag AS unit, nullif(l_suppkey % 10, 0) AS county FROM lineitem),
m AS (SELECT market, day, median(price) AS mid FROM q WHERE price > 0 GROUP BY ALL), b AS (SELECT day, count(*) AS on_day FROM q GROUP BY 1)
SELECT l_orderkey, l_linenumber, concat_ws(';', CASE WHEN on_day > 9000 THEN 'bulk_day' END, CASE WHEN count(*) OVER (PARTITION BY l_orderkey) > 1 THEN 'duplicate' END, CASE WHEN county IS NULL THEN 'bad_county' END,
  CASE WHEN coalesce(price <= 0, true) THEN 'nonpositive' END, CASE WHEN price / mid > 5 OR price / mid < 0.2 THEN 'outlier' END, CASE WHEN unit NOT IN ('A', 'N') THEN 'unexpected_unit' END) AS qc_flag
FROM q LEFT JOIN m USING (market, day) LEFT JOIN b USING (day)""")
def qc_flags(spark, sf_dir):
    quotes = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("market"), F.trunc(F.col("l_shipdate").cast("date"), "year").alias("day"), F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("unit"), F.nullif(F.col("l_suppkey") % 10, F.lit(0)).alias("county"))
    return gates.qc_flags(quotes, "market", "day", "price", "unit", "county", ["A", "N"], 9000, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "qc_flag")


@query("dup_keys", "SELECT l_orderkey, l_linenumber, count(*) AS times FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_keys(spark, sf_dir):
    return gates.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("constant_columns", "SELECT 'l_linestatus' AS \"column\", min(l_linestatus) = max(l_linestatus) AS constant FROM lineitem UNION ALL SELECT 'l_tax', min(l_tax) = max(l_tax) FROM lineitem")
def constant_columns(spark, sf_dir):
    return gates.constant_columns(table(spark, sf_dir, "lineitem"), ["l_linestatus", "l_tax"])


@query("plausible_values", "WITH m AS (SELECT c_nationkey, list_sort(list(c_acctbal))[len(list(c_acctbal)) // 2 + 1] AS mid FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1) SELECT c_custkey, c_acctbal FROM customer LEFT JOIN m USING (c_nationkey) WHERE mid IS NULL OR abs(c_acctbal - mid) <= 0.5 * abs(mid)")
def plausible_values(spark, sf_dir):
    return gates.plausible_years(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal", F.col("c_custkey") % 2 == 0).select("c_custkey", "c_acctbal")


@query("edition_diff", "SELECT s_suppkey, s_acctbal AS old_value, round(s_acctbal * 1.01, 2) AS new_value FROM supplier WHERE abs(round(s_acctbal * 1.01, 2) - s_acctbal) > greatest(1.0, 0.005 * abs(s_acctbal))")
def edition_diff(spark, sf_dir):
    old = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return gates.edition_diff(old, old.withColumn("s_acctbal", F.round(F.col("s_acctbal") * 1.01, 2)), ["s_suppkey"], "s_acctbal").drop("change")


@query("row_sum_gate", "WITH p AS (SELECT s_suppkey, 40 + s_suppkey % 3 AS a, 30 AS b, 29 AS c FROM supplier) SELECT count(*) AS rows, count(*) FILTER (a + b + c NOT BETWEEN 97 AND 103) AS bad_rows, count(*) FILTER (a + b + c NOT BETWEEN 97 AND 103) = 0 AND count(*) >= 6 AS passed FROM p")
def row_sum_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select((40 + F.col("s_suppkey") % 3).alias("a"), F.lit(30).alias("b"), F.lit(29).alias("c"))
    return gates.row_sum_gate(rows, ["a", "b", "c"])


@query("index_gate", "SELECT count(*) AS rows, count(DISTINCT page_id) AS unique_keys, 0 AS repeats, count(DISTINCT page_id // 20) AS pages, count(*) FILTER (NOT regexp_matches(CAST(page_id AS VARCHAR), '^[0-9]+$')) AS malformed, true AS complete FROM pages")
def index_gate(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.floor(F.col("page_id") / 20).alias("p"))
    return gates.index_gate(pages, "page_id", "p", 20, table(spark, sf_dir, "pages").count(), "^[0-9]+$")


@query("missing_keys", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def missing_keys(spark, sf_dir):
    return gates.missing_keys(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("csv_serialise", "SELECT n_nationkey, CAST(n_nationkey AS VARCHAR) || ',' || n_name || ',' || CAST(n_regionkey AS VARCHAR) AS line FROM nation")
def csv_serialise(spark, sf_dir):
    from agrolith.sources.sinks import csv_line

    nation = table(spark, sf_dir, "nation")
    return nation.select("n_nationkey", csv_line(nation.columns).alias("line"))


# events (event-time windows are an extension beyond the reference's surface)


@query("tumbling_events", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_events(spark, sf_dir):
    return E.tumbling(table(spark, sf_dir, "events"), "1 hour").select("start", "event_type", "n", F.round("total", 4).alias("total"))


@query("sliding_events", "SELECT time_bucket(INTERVAL 30 MINUTE, ts) - to_minutes(30 * k) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events CROSS JOIN (VALUES (0), (1)) s(k) GROUP BY ALL")
def sliding_events(spark, sf_dir):
    return E.tumbling(table(spark, sf_dir, "events"), "1 hour", "30 minutes").select("start", "event_type", "n", F.round("total", 4).alias("total"))


@query("session_events", """
WITH g AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS head FROM events),
s AS (SELECT *, sum(head) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, session""")
def session_events(spark, sf_dir):
    return E.sessions(table(spark, sf_dir, "events"), "30 minutes").select("user_id", "start", "n")


@query("stream_hourly_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_hourly_counts(spark, sf_dir):
    counted = E.run_available(spark, f"{sf_dir}/events.parquet", lambda rows: E.tumbling(rows, "1 hour"), "complete")
    return counted.select("start", "event_type", "n", F.round("total", 4).alias("total"))


@query("stream_dedupe_watermark", "SELECT DISTINCT event_id, user_id FROM events")
def stream_dedupe_watermark(spark, sf_dir):
    return E.run_available(spark, f"{sf_dir}/events.parquet", lambda rows: E.deduplicated(rows, ["event_id"], "40 days").select("event_id", "user_id"), "append")
