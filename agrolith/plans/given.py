"""Operators whose other queries read literals or made-up draws, here over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrolith.functions.columns import SEASONS
from agrolith.operators import aggregates as A
from agrolith.operators import finance, relational
from agrolith.plans.registry import query, table
from agrolith.sources import files
from agrolith.streaming.events import shared


@query("resolved_names", """
WITH k AS (SELECT p_name || ' ' || p_type || ' ' || p_brand || ' no ' || p_partkey AS key, p_name || ' ' || p_type AS kind, p_name || ' ' || p_type || ' ' || p_brand AS brand, p_partkey FROM part), n AS (SELECT count(*) AS n FROM part),
t AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN key WHEN 1 THEN brand WHEN 2 THEN kind WHEN 3 THEN 'the first' WHEN 4 THEN 'no ' || c_custkey ELSE left(key, 2) END AS name FROM customer, n JOIN k ON p_partkey = c_custkey * 7 % n),
u AS (SELECT name, CASE WHEN count(*) = 1 THEN min(key) END AS key FROM (SELECT DISTINCT name FROM t WHERE length(name) >= 3) JOIN k ON starts_with(key, name || ' ') GROUP BY 1)
SELECT c_custkey, t.name, coalesce(k.key, CASE WHEN t.name = 'the first' THEN (SELECT key FROM k WHERE p_partkey = 0) END, u.key) AS key FROM t LEFT JOIN k ON k.key = t.name LEFT JOIN u ON u.name = t.name""")
def resolved_names(spark, sf_dir):
    """Customers' names of parts: whole, begun, ambiguous, by alias and unknown."""
    known = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("kind"), F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("brand"))
    known = known.withColumn("key", F.concat("brand", F.lit(" no "), F.col("p_partkey").cast("string")))
    n = known.count()
    first = known.where("p_partkey = 0").first()
    asked = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 7 % n).alias("p_partkey")).join(known, "p_partkey")
    at = F.col("c_custkey") % 6
    name = F.when(at == 0, F.col("key")).when(at == 1, F.col("brand")).when(at == 2, F.col("kind")).when(at == 3, "the first").when(at == 4, F.concat(F.lit("no "), F.col("c_custkey").cast("string"))).otherwise(F.substring("key", 1, 2))
    return relational.resolve_names(asked.select("c_custkey", name.alias("name")), known.select("key"), {"the first": first["key"]} if first else {})


@query("transposed_orders", "WITH a AS (SELECT list(o_orderkey ORDER BY o_orderkey) AS x, list(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END ORDER BY o_orderkey)[1:5] AS y FROM orders GROUP BY o_custkey) SELECT x, y FROM (SELECT unnest(x) AS x, unnest(y) AS y FROM a) WHERE x IS NOT NULL OR y IS NOT NULL")
def transposed_orders(spark, sf_dir):
    """Customers' columns of unequal length as rows."""
    own = F.array_sort(F.collect_list(F.struct("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("p"))))
    arrays = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(own.alias("o"))
    arrays = arrays.select(F.transform("o", lambda r: r["o_orderkey"]).alias("x"), F.slice(F.transform("o", lambda r: r["p"]), 1, 5).alias("y"))
    return A.rows_from_columns(arrays, "x", "y")


LABELS = ", ".join(f"'{s}'" for s in SEASONS)


@query("season_text", f"SELECT [{LABELS}][month(o_orderdate)] AS season, CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n, CAST(sum(o_orderkey % 1000) AS DOUBLE) AS total FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 1000 <> 999 GROUP BY ALL")
def season_text(spark, sf_dir):
    """Orders as lines of an index, among prose, unknown seasons, missing marks and lines with too many words."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("y"), F.element_at(F.array(*map(F.lit, SEASONS)), F.month("o_orderdate")).alias("s"))
    key = F.col("o_orderkey")
    value = F.when(key % 1000 == 999, "-99.9").otherwise(F.concat((key % 1000).cast("string"), F.lit(".0")))
    bad = F.when(key % 20 == 0, F.concat_ws(" ", F.lit("XXX"), "y", value)).otherwise(F.concat_ws(" ", "s", "y", value, F.lit("note")))
    line = F.when(key % 10 == 0, bad).otherwise(F.concat(F.lit("  "), F.concat_ws("   ", "s", "y", value)))
    folder = shared(spark, "seasons")
    orders.select(line.alias("value")).write.text(folder)
    found = files.season_index(spark, folder).groupBy("season", F.col("year").cast("long").alias("year"))
    return found.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("year_matrices", "SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month, CAST(sum(n) AS DOUBLE) AS value, count(*) AS files FROM (SELECT o_orderstatus, date_trunc('month', o_orderdate) AS o_orderdate, count(*) AS n FROM orders GROUP BY ALL) WHERE year(o_orderdate) BETWEEN 1996 AND 1999 GROUP BY ALL")
def year_matrices(spark, sf_dir):
    """A file a status: its first line bounds the years, rows have a count a month (or a missing mark), the rest is prose."""
    months = table(spark, sf_dir, "orders").groupBy("o_orderstatus", F.year("o_orderdate").alias("y")).agg(*(F.count_if(F.month("o_orderdate") == m).alias(f"m{m}") for m in range(1, 13)))
    row = F.concat_ws(" ", F.col("y").cast("string"), *(F.when(F.col(f"m{m}") == 0, "-9999").otherwise(F.col(f"m{m}").cast("string")) for m in range(1, 13)))
    texts = months.groupBy("o_orderstatus").agg(F.concat_ws("\n", F.lit("  1996  1999"), F.array_sort(F.collect_list(row)), F.lit("prose of the source"), F.lit("1997 is a year")).alias("value"))
    folder = shared(spark, "matrices")
    texts.repartition("o_orderstatus").write.partitionBy("o_orderstatus").text(folder)
    found = files.year_matrix(spark, folder).groupBy(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"))
    return found.agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("files"))


#: A project a year from orders, and draws from customers, in SQL.
PROJECT = """
WITH p AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS year, row_number() OVER (ORDER BY year(o_orderdate)) - 1 AS t, sum(o_totalprice) FILTER (o_orderstatus = 'F') / 1e6 AS b, sum(o_totalprice) FILTER (o_orderstatus <> 'F') / 1.1e6 AS c FROM orders GROUP BY year(o_orderdate)),
d AS (SELECT c_custkey AS s, (c_custkey * 37 % 1000 + 0.5::DOUBLE) / 1000 AS u, (c_custkey * 91 % 997 + 0.5::DOUBLE) / 997 AS v FROM customer),
k AS (SELECT s, CASE WHEN u < 0.3::DOUBLE / 0.5 THEN 0.7 + sqrt(u * 0.5 * (1.0::DOUBLE - 0.7)) ELSE 1.2 - sqrt((1 - u) * 0.5 * (1.2::DOUBLE - 1.0)) END AS kb, CASE WHEN v < 0.1::DOUBLE / 0.4 THEN 0.9 + sqrt(v * 0.4 * (1.0::DOUBLE - 0.9)) ELSE 1.3 - sqrt((1 - v) * 0.4 * (1.3::DOUBLE - 1.0)) END AS kc FROM d),
r AS (SELECT s, year, sum((kb * b - kc * c) / pow(1.1, t)) OVER w AS npv, sum(kb * b / pow(1.1, t)) OVER w / sum(kc * c / pow(1.1, t)) OVER w AS bcr FROM p, k WINDOW w AS (PARTITION BY s ORDER BY year ROWS UNBOUNDED PRECEDING))
"""


def simulated(spark, sf_dir):
    key = F.col("c_custkey")
    draws = table(spark, sf_dir, "customer").select(key.alias("simulation"), ((key * 37 % 1000 + 0.5) / 1000).alias("u"), ((key * 91 % 997 + 0.5) / 997).alias("v"))
    done = F.col("o_orderstatus") == "F"
    years = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").cast("long").alias("year")).agg((F.sum(F.when(done, F.col("o_totalprice"))) / 1e6).alias("project_benefit"), (F.sum(F.when(~done, F.col("o_totalprice"))) / 1.1e6).alias("cost"))
    return finance.simulate(years, (0.7, 1.0, 1.2), (0.9, 1.0, 1.3), rate=0.1, given=draws)


QUANTILES = "round(quantile_cont({0}, 0.1), 4) AS {0}_p10, round(quantile_cont({0}, 0.5), 4) AS {0}_p50, round(quantile_cont({0}, 0.9), 4) AS {0}_p90, round(avg({0}), 4) AS {0}_mean, count({0}) AS {0}_n"
BANDS = [f"{name}_{part}" for name in ("npv", "bcr") for part in ("p10", "p50", "p90", "mean")]


@query("simulated_bands", PROJECT + f"SELECT year, {QUANTILES.format('npv')}, {QUANTILES.format('bcr')}, round(avg(CASE WHEN npv > 0 THEN 1.0 ELSE 0 END), 6) AS p_npv_positive, round(avg(CASE WHEN bcr > 1 THEN 1.0 ELSE 0 END), 6) AS p_bcr_above_one FROM r GROUP BY 1")
def simulated_bands(spark, sf_dir):
    """Bands by year of a project from orders, with a draw a customer."""
    bands = finance.simulation_bands(simulated(spark, sf_dir))
    return bands.select("year", *(F.round(c, 4).alias(c) for c in BANDS), "npv_n", "bcr_n", F.round("p_npv_positive", 6).alias("p_npv_positive"), F.round("p_bcr_above_one", 6).alias("p_bcr_above_one"))


@query("simulated_finals", PROJECT + f", f AS (SELECT * FROM r WHERE year = (SELECT max(year) FROM p)) SELECT count(*) AS simulations, {QUANTILES.format('npv')}, {QUANTILES.format('bcr')}, round(avg(CASE WHEN npv > 0 THEN 1.0 ELSE 0 END), 6) AS p_npv_positive FROM f")
def simulated_finals(spark, sf_dir):
    finals = finance.simulation_finals(simulated(spark, sf_dir))
    return finals.select("simulations", *(F.round(c, 4).alias(c) for c in BANDS), "npv_n", "bcr_n", F.round("p_npv_positive", 6).alias("p_npv_positive"))


@query("avoided_loss_given", """
WITH e AS (SELECT event_id % 9 AS run, 1 + 0.3::DOUBLE * (value / 20 - 1) AS x, 1 + 0.3::DOUBLE * (1 - 0.2::DOUBLE) * (event_id * 7919 % 1000 / 500.0::DOUBLE - 1) AS y FROM events),
m AS (SELECT run, median(x) AS mx, median(y) AS my FROM e GROUP BY 1), s AS (SELECT run, greatest(0, (sum(y) FILTER (y <= my) - sum(x) FILTER (x <= mx)) / sum(x)) AS avoided FROM e JOIN m USING (run) GROUP BY 1)
SELECT round(quantile_cont(avoided, 0.1), 6) AS p10, round(quantile_cont(avoided, 0.5), 6) AS p50, round(quantile_cont(avoided, 0.9), 6) AS p90, round(avg(avoided), 6) AS mean, count(*) AS n, round(min(avoided), 6) AS least FROM s""")
def avoided_loss_given(spark, sf_dir):
    """Nine runs with draws from events."""
    key = F.col("event_id")
    draws = table(spark, sf_dir, "events").select((key % 9).alias("run"), (F.col("value") / 20 - 1).alias("x"), (key * 7919 % 1000 / F.lit(500.0) - 1).alias("y"))
    found = finance.avoided_loss_uncertainty(spark, 0.3, 0.2, given=draws)
    return found.select(*(F.round(c, 6).alias(c) for c in ("p10", "p50", "p90", "mean")), "n", F.round(F.get("samples", F.lit(0)), 6).alias("least"))
