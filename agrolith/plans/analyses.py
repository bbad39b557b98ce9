"""Queries of the selection rules, lookups, analyses by title, nested documents, grids and harvest gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrolith.functions import columns as C
from agrolith.operators import aggregates as A
from agrolith.operators import analyses, finance, gates, grids, hierarchy, nested, relational, seasonal, selection

from .analytics import NATION_ORDERS, customer_flows, nation_orders
from .registry import query, table

FLOWS = NATION_ORDERS + ", f AS (SELECT o_custkey, year, round(sum(o_totalprice), 2) - 150000.0 AS flow FROM o GROUP BY o_custkey, year)\n"


# selection


@query("included_places", "SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal > 0 AND c_nationkey NOT IN (3, 7, 11)")
def included_places(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", (F.col("c_acctbal") > 0).alias("include"))
    return relational.included(rows, "include", "c_nationkey", [3, 7, 11])


@query("builder_predicates", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND trim(o_orderpriority) <> '' AND NOT starts_with(o_orderpriority, '2') AND regexp_full_match(CAST(year(o_orderdate) AS VARCHAR), '\\d{4}')")
def builder_predicates(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    rows = rows.where(F.trim("o_orderpriority") != "").where(~F.col("o_orderpriority").startswith("2"))
    return rows.where(F.year("o_orderdate").cast("string").rlike(r"^\d{4}$")).select("o_orderkey")


@query("direction_classes", "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'export' WHEN 'N' THEN 'import' END AS direction FROM lineitem WHERE l_returnflag IN ('A', 'N')")
def direction_classes(spark, sf_dir):
    return analyses.direction_classes(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit(" "), "l_returnflag").alias("flow")), "flow", {"a": "export", "n": "import"}).drop("flow")


BOUNDARIES = """
WITH a AS (SELECT r_name AS admin0, n_name AS admin1, c_name AS admin2 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def places(spark, sf_dir):
    t = lambda name: table(spark, sf_dir, name)
    joined = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    whole = joined.select(F.col("r_name").alias("admin0"), F.col("n_name").alias("admin1"), F.col("c_name").alias("admin2"))
    return {0: whole.select("admin0").distinct(), 1: whole.select("admin0", "admin1").distinct(), 2: whole}


@query("boundaries_none", BOUNDARIES + "SELECT DISTINCT admin0, false AS selected FROM a")
def boundaries_none(spark, sf_dir):
    return relational.boundaries(places(spark, sf_dir), ["admin0", "admin1", "admin2"], [None, [], None])[1]


@query("boundaries_one", BOUNDARIES + "SELECT DISTINCT admin0, admin1, false AS selected FROM a WHERE admin0 = 'ASIA'")
def boundaries_one(spark, sf_dir):
    return relational.boundaries(places(spark, sf_dir), ["admin0", "admin1", "admin2"], ["ASIA", None, None])[1]


@query("boundaries_capped", BOUNDARIES + "SELECT DISTINCT admin0, admin1, coalesce(admin1 IN ('NATION_2', 'NATION_7'), false) AS selected FROM a WHERE admin0 IN ('ASIA', 'EUROPE')")
def boundaries_capped(spark, sf_dir):
    """The level below is asked for but capped, so its parents' names are marks and no filter."""
    return relational.boundaries(places(spark, sf_dir), ["admin0", "admin1", "admin2"], [["ASIA", "EUROPE"], ["NATION_2", "NATION_7"], None], most=1)[1]


@query("pruned_selection", "SELECT n_regionkey, n_nationkey FROM nation WHERE n_nationkey % 3 = 0 AND n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name <> 'ASIA')")
def pruned_selection(spark, sf_dir):
    chosen = table(spark, sf_dir, "nation").where("n_nationkey % 3 = 0").select("n_regionkey", "n_nationkey")
    return hierarchy.prune(chosen, table(spark, sf_dir, "region").where("r_name <> 'ASIA'").select(F.col("r_regionkey").alias("n_regionkey")), ["n_regionkey"])


# lookups


LOOKUP = "WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN upper(replace(p_name, ' ', '-')) WHEN p_partkey % 9 = 0 THEN 'unknown ' || p_size ELSE p_name END AS name FROM part), k AS (SELECT DISTINCT p_name FROM part WHERE p_name NOT LIKE '%cold%')\n"


def looked_up(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 4 == 0, F.upper(F.translate("p_name", " ", "-"))).when(F.col("p_partkey") % 9 == 0, F.concat(F.lit("unknown "), F.col("p_size").cast("string"))).otherwise(F.col("p_name"))
    known = part.where("p_name NOT LIKE '%cold%'").select("p_name").distinct()
    return relational.looked_up(part.select("p_partkey", name.alias("name")), known, "name", "p_name", C.norm)


@query("norm_lookup", LOOKUP + "SELECT p_partkey, p_name FROM t JOIN k ON lower(replace(t.name, '-', ' ')) = p_name")
def norm_lookup(spark, sf_dir):
    return looked_up(spark, sf_dir)[0].select("p_partkey", "p_name")


@query("norm_lookup_report", LOOKUP + "SELECT name, count(*) AS rows FROM t WHERE lower(replace(name, '-', ' ')) NOT IN (SELECT p_name FROM k) GROUP BY 1")
def norm_lookup_report(spark, sf_dir):
    return looked_up(spark, sf_dir)[1]


@query("map_lookup_report", "SELECT c_mktsegment, count(*) AS rows FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE') GROUP BY 1")
def map_lookup_report(spark, sf_dir):
    codes = spark.createDataFrame([("BUILDING", "B"), ("FURNITURE", "F")], "segment string, code string")
    return relational.looked_up(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), codes, "c_mktsegment", "segment", lambda c: c)[1]


@query("production_area", NATION_ORDERS + "SELECT nation, year, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS production, round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS area FROM o GROUP BY ALL HAVING sum(o_totalprice) FILTER (o_orderstatus = 'F') IS NOT NULL")
def production_area(spark, sf_dir):
    """Production with the area of the same place and year, where there is one."""
    long = nation_orders(spark, sf_dir).groupBy("nation", "year", "o_orderstatus").agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    wide = A.wide(long, ["nation", "year"], "o_orderstatus", "v", ["F", "O"])
    return wide.where(F.col("F").isNotNull()).select("nation", "year", F.col("F").alias("production"), F.col("O").alias("area"))


@query("related_keys", "SELECT n_nationkey, r AS related FROM (SELECT n_nationkey, unnest([n_nationkey + 1, n_nationkey * 5]) AS r FROM nation) WHERE r NOT IN (SELECT n_nationkey FROM nation) GROUP BY ALL")
def related_keys(spark, sf_dir):
    key = F.col("n_nationkey")
    return relational.unknown_related(table(spark, sf_dir, "nation").select(key, F.array(key + 1, key * 5).alias("r")), "n_nationkey", "r")


STAR = NATION_ORDERS + """, s AS (SELECT CASE month(o_orderdate) WHEN 1 THEN 'DJF' WHEN 4 THEN 'MAM' WHEN 8 THEN 'JAS' WHEN 11 THEN 'OND' END AS season, year, o_orderstatus AS i, sum(o_totalprice) AS v FROM o WHERE month IN (1, 4, 8, 11) GROUP BY ALL),
t AS (SELECT nation, season, year, count(*) AS n FROM (SELECT nation, year, CASE month WHEN 4 THEN 'MAM' WHEN 11 THEN 'OND' ELSE 'JJA' END AS season FROM o WHERE month IN (4, 7, 11)) GROUP BY ALL)
"""


@query("predictor_star", STAR + "SELECT t.nation, t.season, t.year, t.n, CASE t.season WHEN 'MAM' THEN 'DJF' WHEN 'OND' THEN 'JAS' END AS predictor, round(a.v, 2) AS f, round(b.v, 2) AS o FROM t LEFT JOIN s a ON a.i = 'F' AND a.year = t.year AND a.season = CASE t.season WHEN 'MAM' THEN 'DJF' WHEN 'OND' THEN 'JAS' END LEFT JOIN s b ON b.i = 'O' AND b.year = t.year AND b.season = CASE t.season WHEN 'MAM' THEN 'DJF' WHEN 'OND' THEN 'JAS' END")
def predictor_star(spark, sf_dir):
    orders = nation_orders(spark, sf_dir)
    season = F.create_map(*(F.lit(x) for pair in {1: "DJF", 4: "MAM", 8: "JAS", 11: "OND"}.items() for x in pair))
    drivers = orders.where("month IN (1, 4, 8, 11)").groupBy(F.col("o_orderstatus").alias("index"), season[F.col("month").cast("int")].alias("season"), "year").agg(F.sum("o_totalprice").alias("value"))
    target = F.when(F.col("month") == 4, "MAM").when(F.col("month") == 11, "OND").otherwise("JJA")
    targets = orders.where("month IN (4, 7, 11)").groupBy("nation", target.alias("season"), "year").agg(F.count(F.lit(1)).alias("n"))
    return analyses.predictor_star(targets, drivers, ["F", "O"]).select("nation", "season", "year", "n", "predictor", F.round("F", 2).alias("f"), F.round("O", 2).alias("o"))


@query("zonal_mask", """
WITH p AS (SELECT o_orderkey, CAST(o_orderkey % 101 AS DOUBLE) AS x, CAST((o_orderkey * 7) % 97 AS DOUBLE) AS y, o_totalprice FROM orders)
SELECT area, count(*) AS pixels, round(avg(o_totalprice), 4) AS mean FROM (
  SELECT 'square' AS area, * FROM p WHERE x >= 10.5 AND x < 40.5 AND y >= 5.5 AND y < 50.5
  UNION ALL SELECT 'triangle', * FROM p WHERE y > 40.25 AND y <= 90.25 AND x >= 50.1 + (y - 40.25) * 0.4 AND x < 90.1 - (y - 40.25) * 0.4) GROUP BY 1""")
def zonal_mask(spark, sf_dir):
    rings = [("square", [(10.5, 5.5), (40.5, 5.5), (40.5, 50.5), (10.5, 50.5)]), ("triangle", [(50.1, 40.25), (90.1, 40.25), (70.1, 90.25)])]
    areas = spark.createDataFrame(rings, "area string, ring array<struct<x: double, y: double>>")
    key = F.col("o_orderkey")
    pixels = table(spark, sf_dir, "orders").select((key % 101).cast("double").alias("x"), ((key * 7) % 97).cast("double").alias("y"), "o_totalprice")
    return grids.zonal(pixels, areas, 20.0, "o_totalprice").withColumn("mean", F.round("mean", 4))


# aggregates and order


@query("approx_distinct_users", "SELECT event_type, true AS close FROM events GROUP BY 1")
def approx_distinct_users(spark, sf_dir):
    """The approximate count lies within three of its standard errors (5 %) of the exact one."""
    exact, rough = F.countDistinct("user_id"), F.approx_count_distinct("user_id", 0.05)
    return table(spark, sf_dir, "events").groupBy("event_type").agg((F.abs(exact - rough) <= 0.15 * exact + 1).alias("close"))


@query("headline_sums", "SELECT s_suppkey, CASE WHEN a IS NOT NULL OR b IS NOT NULL THEN coalesce(a, 0) + coalesce(b, 0) END AS total FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 3.5 END AS a, CASE WHEN s_suppkey % 3 = 0 THEN 1.25 END AS b FROM supplier)")
def headline_sums(spark, sf_dir):
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select("s_suppkey", A.sum_present(F.when(key % 2 == 0, 3.5), F.when(key % 3 == 0, 1.25)).alias("total"))


@query("average_row", "WITH s AS (SELECT CAST(s_nationkey AS VARCHAR) AS place, round(avg(s_acctbal), 4) AS v FROM supplier GROUP BY 1) SELECT * FROM s UNION ALL SELECT 'average', round(avg(v), 4) FROM s")
def average_row(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("place")).agg(F.round(F.avg("s_acctbal"), 4).alias("v"))
    return A.with_average(rows, "place", "average", "v").withColumn("v", F.round("v", 4))


@query("national_totals", "SELECT p_brand, " + ", ".join(f"round(sum(l_quantity) FILTER (year(l_shipdate) = {y}), 2) AS y{y}" for y in (1996, 1997, 1998)) + " FROM lineitem JOIN part ON l_partkey = p_partkey WHERE year(l_shipdate) BETWEEN 1996 AND 1998 GROUP BY 1")
def national_totals(spark, sf_dir):
    year = F.year("l_shipdate")
    rows = table(spark, sf_dir, "lineitem").where(year.between(1996, 1998)).join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    sums = rows.groupBy("p_brand", F.concat(F.lit("y"), year.cast("string")).alias("y")).agg(F.round(F.sum("l_quantity"), 2).alias("q"))
    return A.wide(sums, ["p_brand"], "y", "q", ["y1996", "y1997", "y1998"])


@query("kept_best", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus DESC, o_totalprice DESC, o_orderkey) = 1")
def kept_best(spark, sf_dir):
    return relational.keep_best(table(spark, sf_dir, "orders"), ["o_custkey"], F.desc("o_orderstatus"), F.desc("o_totalprice"), F.asc("o_orderkey")).select("o_custkey", "o_orderkey")


@query("first_seen", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def first_seen(spark, sf_dir):
    return relational.keep_best(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], F.asc("event_id"))


@query("wrapped_rows", """
WITH w AS (SELECT s_nationkey, s_suppkey, s_name, CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal END AS v FROM supplier),
g AS (SELECT *, coalesce(count(v) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM w)
SELECT s_nationkey, max(s_suppkey) AS s_suppkey, string_agg(s_name, ' ' ORDER BY s_suppkey) AS s_name, max(v) AS v FROM g GROUP BY s_nationkey, g HAVING count(v) > 0""")
def wrapped_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_name", F.when(F.col("s_suppkey") % 3 == 0, F.col("s_acctbal")).alias("v"))
    return A.merged_wrapped(rows, ["s_nationkey"], "s_suppkey", "s_name", "v").select("s_nationkey", "s_suppkey", "s_name", "v")


@query("rank_in_subset_global", "SELECT * FROM (SELECT c_custkey, c_nationkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS global_place FROM customer) JOIN (SELECT c_custkey, rank() OVER (ORDER BY c_acctbal DESC) AS place FROM customer WHERE c_nationkey = 7) USING (c_custkey)")
def rank_in_subset_global(spark, sf_dir):
    """A subset ranked anew; the place among all stays."""
    from pyspark.sql import Window as W

    everyone = relational.placed(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), "global_place", F.desc("c_acctbal"), F.asc("c_custkey"))
    own = F.rank().over(W.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"))).cast("long")
    return everyone.where("c_nationkey = 7").select("c_custkey", "c_nationkey", "global_place", own.alias("place"))


@query("nulls_last_places", "SELECT doc_id, toxic, row_number() OVER (ORDER BY toxic DESC NULLS LAST, doc_id) AS place FROM documents LEFT JOIN labels USING (doc_id)")
def nulls_last_places(spark, sf_dir):
    """Nulls come last in a falling order, over all rows."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "toxic")
    return relational.placed(rows, "place", F.col("toxic").desc_nulls_last(), F.asc("doc_id"))


#: The search for a rate in SQL, from prefixes p (o_custkey, year, fl): secants from 0.1 and 0.15, a hundred at most, until one
#: moves by less than 1e-6; none where the two values are as good as equal.
SECANT = """p2 AS MATERIALIZED (SELECT * FROM p WHERE len(fl) >= 2),
s AS (SELECT o_custkey, year, fl, 0 AS step, 0.1::DOUBLE AS a, 0.15::DOUBLE AS b, NULL::DOUBLE AS rate FROM p2
  UNION ALL SELECT o_custkey, year, fl, step + 1, b, c, CASE WHEN abs(c - b) < 1e-6 THEN c END FROM (SELECT *, b - vb * (b - a) / (vb - va) AS c FROM (SELECT *,
    list_sum(list_transform(fl, lambda x, i: x / pow(1 + a, i - 1))) AS va, list_sum(list_transform(fl, lambda x, i: x / pow(1 + b, i - 1))) AS vb FROM s WHERE rate IS NULL AND step < 100)
    WHERE abs(vb - va) >= 1e-10)),
found AS (SELECT o_custkey, year, rate FROM s WHERE rate IS NOT NULL)
"""


@query("cumulative_rates", "WITH RECURSIVE" + FLOWS.removeprefix("WITH") + """, t AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY year) - 1 AS t FROM f),
m AS (SELECT a.o_custkey, a.year, a.t AS n, sum(least(b.flow, 0) / pow(1.1, b.t)) AS losses, sum(greatest(b.flow, 0) * pow(1.12, a.t - b.t)) AS gains FROM t a JOIN t b ON a.o_custkey = b.o_custkey AND b.t <= a.t GROUP BY ALL),
p AS (SELECT o_custkey, year, list(flow) OVER (PARTITION BY o_custkey ORDER BY year ROWS UNBOUNDED PRECEDING) AS fl FROM f), """ + SECANT + """
SELECT m.o_custkey, m.year, CASE WHEN n > 0 AND losses < 0 AND gains > 0 THEN round(pow(gains / abs(losses), 1.0 / n) - 1, 6) END AS mirr, round(rate, 4) AS irr FROM m LEFT JOIN found USING (o_custkey, year)""")  # fmt: skip
def cumulative_rates(spark, sf_dir):
    """IRR and MIRR of every prefix."""
    rows = finance.cumulative_rates(customer_flows(spark, sf_dir), ["o_custkey"], "year", "flow", 0.10, 0.12)
    return rows.select("o_custkey", "year", F.round("mirr", 6).alias("mirr"), F.round("irr", 4).alias("irr"))


@query("irr_customer", "WITH RECURSIVE" + FLOWS.removeprefix("WITH") + ", p AS (SELECT o_custkey, 0 AS year, list(flow ORDER BY year) AS fl FROM f GROUP BY 1), " + SECANT + "SELECT o_custkey, len(fl) AS n, round(rate, 4) AS irr FROM p LEFT JOIN found USING (o_custkey)")
def irr_customer(spark, sf_dir):
    """Each customer's internal rate of return."""
    flows = customer_flows(spark, sf_dir).groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("year", "flow"))), lambda x: x["flow"]).alias("flows"))
    return flows.select("o_custkey", F.size("flows").cast("long").alias("n"), F.round(finance.irr("flows"), 4).alias("irr"))


@query("irr_closed", """
WITH o AS (SELECT o_orderkey, o_totalprice AS p, o_totalprice * (1 + (o_custkey % 50) / 100.0) AS a, o_totalprice * (0.6 + (o_custkey % 30) / 100.0) AS b FROM orders)
SELECT o_orderkey, round(a / p - 1, 4) AS two, round(2 * b / (sqrt(b * b + 4 * p * b) - b) - 1, 4) AS three FROM o""")
def irr_closed(spark, sf_dir):
    """Rates that have a formula: one return after a year, and two equal ones."""
    orders = table(spark, sf_dir, "orders")
    p, a, b = F.col("o_totalprice"), F.col("o_totalprice") * (1 + F.col("o_custkey") % 50 / F.lit(100.0)), F.col("o_totalprice") * (0.6 + F.col("o_custkey") % 30 / F.lit(100.0))
    return orders.select("o_orderkey", F.round(finance.irr(F.array(-p, a)), 4).alias("two"), F.round(finance.irr(F.array(-p, b, b)), 4).alias("three"))


@query("clean_median_price", """
WITH q AS (SELECT l_orderkey, l_partkey, l_suppkey AS market, CAST(date_trunc('year', l_shipdate) AS DATE) AS day, month(l_shipdate) AS month, l_extendedprice AS price, l_returnflag AS unit, nullif(l_suppkey % 10, 0) AS county FROM lineitem),
m AS (SELECT market, day, median(price) AS mid FROM q WHERE price > 0 GROUP BY ALL), b AS (SELECT day, count(*) AS on_day FROM q GROUP BY 1), d AS (SELECT l_orderkey FROM q GROUP BY 1 HAVING count(*) > 1)
SELECT p_type, year(day) AS year, month, round(median(price), 6) AS median_price, count(*) AS n_quotes FROM q JOIN part ON l_partkey = p_partkey JOIN m USING (market, day) JOIN b USING (day)
WHERE on_day <= 9000000 AND l_orderkey NOT IN (SELECT l_orderkey FROM d) AND county IS NOT NULL AND price > 0 AND price / mid <= 5 AND price / mid >= 0.2 AND unit IN ('A', 'N') GROUP BY ALL""")
def clean_median_price(spark, sf_dir):
    """Median price over quotes without a flag; six digits, so that a mean of two middle prices has no half to round."""
    quotes = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.col("l_suppkey").alias("market"), F.trunc(F.col("l_shipdate").cast("date"), "year").alias("day"), F.month("l_shipdate").cast("long").alias("month"), F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("unit"), F.nullif(F.col("l_suppkey") % 10, F.lit(0)).alias("county"))
    clean = gates.qc_flags(quotes, "market", "day", "price", "unit", "county", ["A", "N"], 9_000_000, ["l_orderkey"]).where("qc_flag = ''")
    rows = clean.join(table(spark, sf_dir, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    quotes = rows.select("p_type", F.year("day").cast("long").alias("year"), "month", "price")
    found = selection.medians(quotes, ["p_type", "year", "month"], "price", "median_price")
    return found.withColumn("median_price", F.round("median_price", 6)).withColumnRenamed("n", "n_quotes")


# analyses


@query("phase_means", "SELECT CASE WHEN abs(z) >= 1.5 THEN 'strong' WHEN abs(z) >= 1 THEN 'moderate' ELSE 'neutral' END || CASE WHEN abs(z) < 1 THEN '' WHEN z > 0 THEN ' +' ELSE ' -' END AS phase, count(*) AS n, round(avg(c_acctbal), 4) AS mean FROM (SELECT c_acctbal, (c_custkey % 41 - 20) / 10.0 AS z FROM customer) GROUP BY 1")
def phase_means(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("z", (F.col("c_custkey") % 41 - 20) / F.lit(10.0))
    return analyses.phase_means(rows, "z", "c_acctbal").withColumn("mean", F.round("mean", 4))


@query("benchmark_gap", NATION_ORDERS + ", v AS (SELECT nation, year, avg(o_totalprice) AS v FROM o GROUP BY ALL) SELECT a.nation, a.year, round(a.v - b.v, 4) AS gap FROM v a LEFT JOIN v b ON b.nation = 7 AND a.year = b.year WHERE a.nation <> 7")
def benchmark_gap(spark, sf_dir):
    rows = nation_orders(spark, sf_dir).groupBy("nation", "year").agg(F.avg("o_totalprice").alias("v"))
    return analyses.benchmark_gap(rows, "nation", ["year"], "v", 7).select("nation", "year", F.round("gap", 4).alias("gap"))


@query("readiness_hazard_shares", "WITH c AS (SELECT p_brand, CASE WHEN p_size < 15 THEN 'Low' WHEN p_size < 35 THEN 'Medium' ELSE 'High' END AS r, CASE WHEN p_retailprice < 1000 THEN 'Low' WHEN p_retailprice < 1400 THEN 'Medium' ELSE 'High' END AS h FROM part) SELECT p_brand, count(*) AS n, round(100.0 * avg(CASE WHEN r = 'High' AND h = 'High' THEN 1.0 ELSE 0 END), 6) AS opportunity_pct, round(100.0 * avg(CASE WHEN r = 'Low' AND h = 'High' THEN 1.0 ELSE 0 END), 6) AS gap_pct FROM c GROUP BY 1")
def readiness_hazard_shares(spark, sf_dir):
    names = ["Low", "Medium", "High"]
    ready, hazard = C.class_between(F.col("p_size"), [15, 35], names), C.class_between(F.col("p_retailprice"), [1000, 1400], names)
    shares = analyses.class_shares(table(spark, sf_dir, "part").withColumns({"r": ready, "h": hazard}), ["p_brand"], F.col("r"), F.col("h"), ("High", "High"), ("Low", "High"))
    return shares.select("p_brand", "n", F.round("opportunity_pct", 6).alias("opportunity_pct"), F.round("gap_pct", 6).alias("gap_pct"))


@query("readiness_gap", "SELECT p_partkey, least(a, b) AS low, greatest(a, b) AS high, a - b AS gap, CASE WHEN a > b THEN 'access' WHEN a < b THEN 'readiness' ELSE 'none' END AS leads, row_number() OVER (ORDER BY a - b DESC, p_partkey) AS place FROM (SELECT p_partkey, p_size * 2.0 AS a, p_partkey % 101 * 1.0 AS b FROM part)")
def readiness_gap(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * F.lit(2.0)).alias("access"), (F.col("p_partkey") % 101 * F.lit(1.0)).alias("readiness"))
    gaps = analyses.two_measure_gap(rows, "access", "readiness").drop("access", "readiness")
    return relational.placed(gaps, "place", F.desc("gap"), F.asc("p_partkey"))


@query("group_gap", NATION_ORDERS + """, v AS (SELECT nation, year, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS w, avg(o_totalprice) FILTER (o_orderstatus = 'O') AS m FROM o GROUP BY ALL),
l AS (SELECT CAST(nation AS VARCHAR) AS place, year, w, m, w - m AS gap FROM v WHERE w IS NOT NULL AND m IS NOT NULL QUALIFY row_number() OVER (PARTITION BY nation ORDER BY year DESC) = 1)
SELECT place, year, round(w, 4) AS women, round(m, 4) AS men, round(gap, 4) AS gap FROM l UNION ALL SELECT 'average', NULL, round(avg(w), 4), round(avg(m), 4), round(avg(gap), 4) FROM l""")
def group_gap(spark, sf_dir):
    group = F.when(F.col("o_orderstatus") == "F", "women").when(F.col("o_orderstatus") == "O", "men")
    rows = nation_orders(spark, sf_dir).groupBy(F.col("nation").cast("string").alias("place"), "year", group.alias("sex")).agg(F.avg("o_totalprice").alias("v"))
    return analyses.group_gap(rows, ["place"], "year", "sex", "v", ("women", "men"), "place").select("place", "year", *(F.round(c, 4).alias(c) for c in ("women", "men", "gap")))


@query("horizon_change", NATION_ORDERS + ", v AS (SELECT nation, avg(o_totalprice) FILTER (year = 1996) AS b, avg(o_totalprice) FILTER (year = 1998) AS h FROM o WHERE year IN (1996, 1998) GROUP BY 1), c AS (SELECT *, (h - b) / b * 100 AS p FROM v) SELECT nation, round(p, 4) AS change_pct, CASE WHEN p > 1 THEN 'up' WHEN p < -1 THEN 'down' WHEN p IS NOT NULL THEN 'stable' END AS trend FROM c")
def horizon_change(spark, sf_dir):
    rows = nation_orders(spark, sf_dir).where("year IN (1996, 1998)").groupBy("nation", "year").agg(F.avg("o_totalprice").alias("v"))
    return analyses.horizon_change(rows, ["nation"], "year", "v", 1996, 1998).select("nation", F.round("change_pct", 4).alias("change_pct"), "trend")


@query("cumulative_thresholds", """
WITH e AS (SELECT o_orderpriority AS model, o_orderdate AS day, o_orderkey % 60 AS loss, 1 + o_orderkey % 3 AS farms FROM orders),
h AS (SELECT model, day, t.t AS threshold, sum(CASE WHEN loss >= t.t THEN farms ELSE 0 END) AS hit FROM e CROSS JOIN (VALUES (30), (40), (50)) t(t) GROUP BY ALL)
SELECT model, day, threshold, CAST(sum(hit) OVER (PARTITION BY model, threshold ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS impacted FROM h""")
def cumulative_thresholds(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("model"), F.col("o_orderdate").alias("day"), (key % 60).alias("loss"), (1 + key % 3).alias("farms"))
    return analyses.impacted(rows, ["model"], "day", "loss", "farms", (30, 40, 50))


@query("ensemble_mean", "SELECT event_type, count(*) AS models, CAST(sum(n) AS BIGINT) AS events, round(avg(n), 6) AS ensemble_mean FROM (SELECT event_type, user_id % 11 AS m, count(*) AS n FROM events GROUP BY ALL) GROUP BY 1")
def ensemble_mean(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("m", F.col("user_id") % 11)
    return analyses.ensemble(rows, ["event_type"], "m").withColumn("ensemble_mean", F.round("ensemble_mean", 6))


@query("report_chronology", NATION_ORDERS + ", p AS (SELECT nation, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS n FROM o GROUP BY ALL) SELECT nation, strftime(period, '%Y-%m') AS period, n, date_diff('day', lag(period) OVER (PARTITION BY nation ORDER BY period), period) AS since FROM p")
def report_chronology(spark, sf_dir):
    rows = analyses.chronology(nation_orders(spark, sf_dir), ["nation"], "o_orderdate")
    return rows.withColumn("since", F.col("since").cast("long")).withColumn("period", C.year_month_text(F.year("period"), F.month("period")))


@query("trade_buffer", "WITH s AS (SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS i, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS e FROM lineitem GROUP BY 1) SELECT l_suppkey, i AS imports, e AS exports, e - i AS net, round(e / nullif(i, 0), 6) AS cover FROM s")
def trade_buffer(spark, sf_dir):
    rows = analyses.direction_classes(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_quantity"), "l_returnflag", {"a": "export", "n": "import", "r": "transit"})
    return analyses.trade_buffer(rows, ["l_suppkey"], "direction", "l_quantity").withColumn("cover", F.round("cover", 6))


@query("gap_fill_levels", """
WITH v AS (SELECT n_nationkey AS place, n_regionkey AS region, n_regionkey % 2 AS continent, CASE WHEN n_nationkey % 3 = 0 OR n_regionkey = 3 THEN NULL ELSE n_nationkey * 1.5 END AS b FROM nation),
n AS (SELECT x.place, avg(y.b) AS m FROM v x JOIN v y ON y.place = x.place + 1 AND x.place % 2 = 0 WHERE y.b IS NOT NULL GROUP BY 1),
r AS (SELECT region, avg(b) AS m FROM v WHERE b IS NOT NULL GROUP BY 1), c AS (SELECT continent, avg(b) AS m FROM v WHERE b IS NOT NULL GROUP BY 1)
SELECT place, round(coalesce(b, n.m, r.m, c.m), 6) AS b, CASE WHEN b IS NOT NULL THEN 'own' WHEN n.m IS NOT NULL THEN 'neighbours' WHEN r.m IS NOT NULL THEN 'region' WHEN c.m IS NOT NULL THEN 'continent' END AS filled_from FROM v LEFT JOIN n USING (place) LEFT JOIN r USING (region) LEFT JOIN c USING (continent)""")
def gap_fill_levels(spark, sf_dir):
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    rows = table(spark, sf_dir, "nation").select(key.alias("place"), region.alias("region"), (region % 2).alias("continent"), F.when(~((key % 3 == 0) | (region == 3)), key * F.lit(1.5)).alias("b"))
    near = rows.where("place % 2 = 0").select("place", (F.col("place") + 1).alias("neighbour"))
    return analyses.gap_rows(rows, "place", "b", near, "region", "continent").select("place", F.round("b", 6).alias("b"), "filled_from")


HINDCAST = NATION_ORDERS + """, y AS (SELECT nation, year, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM o GROUP BY ALL),
b AS (SELECT nation, quantile_cont(total, 1.0/3) AS t1, quantile_cont(total, 2.0/3) AS t2 FROM y WHERE year BETWEEN 1995 AND 2001 GROUP BY 1 HAVING count(*) >= 3),
k AS (SELECT y.nation, y.year, y.n, CASE WHEN total <= t1 THEN 0 WHEN total > t2 THEN 2 ELSE 1 END AS c FROM y JOIN b USING (nation)),
p AS (SELECT a.nation, a.year, a.c AS came, z.c FROM k a JOIN k z ON a.nation = z.nation AND a.year <> z.year QUALIFY row_number() OVER (PARTITION BY a.nation, a.year ORDER BY abs(a.n - z.n), z.year) <= 3),
s AS (SELECT nation, year, came, avg(CASE WHEN c = 0 THEN 1.0 ELSE 0 END) AS d, avg(CASE WHEN c = 1 THEN 1.0 ELSE 0 END) AS m, avg(CASE WHEN c = 2 THEN 1.0 ELSE 0 END) AS w FROM p GROUP BY ALL),
r AS (SELECT (pow(d - (came = 0)::INT, 2) + pow(d + m - (came <= 1)::INT, 2) + pow(d + m + w - 1, 2)) / 2 AS a, (pow(1.0/3 - (came = 0)::INT, 2) + pow(2.0/3 - (came <= 1)::INT, 2)) / 2 AS f,
  CASE WHEN d >= m AND d >= w THEN 0 WHEN m >= w THEN 1 ELSE 2 END = came AS hit FROM s)
SELECT round(avg(a), 6) AS rps, round(avg(f), 6) AS rps_climatology, round(1 - avg(a) / avg(f), 6) AS rpss, round(avg(hit::INT), 6) AS accuracy FROM r"""


@query("hindcast_skill", HINDCAST)
def hindcast_skill(spark, sf_dir):
    """Tercile shares of each year's three analogues against what came: rps, rpss and accuracy."""
    years = nation_orders(spark, sf_dir).groupBy("nation", "year").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count(F.lit(1)).alias("n"))
    known = seasonal.anomalies(years, ["nation"], "year", "total", 1995, 2001, least=3).select("nation", "year", "tercile", F.col("n").cast("double").alias("n"))
    near = seasonal.analogues(known.select("nation", "year", "n"), known.select("nation", "year", "n"), ["nation"], ["n"], 3)
    outcome = known.select("nation", F.col("year").alias("analogue"), F.col("tercile").alias("then"))
    shares = near.join(outcome, ["nation", "analogue"]).groupBy("nation", "year").agg(*(F.avg(F.when(F.col("then") == c, 1.0).otherwise(0.0)).alias(f"p_{c.lower()}") for c in ("Dry", "Near", "Wet")))
    forecast = shares.join(known.select("nation", "year", "tercile"), ["nation", "year"])
    scores = seasonal.ranked_probability_skill(forecast, ["Dry", "Near", "Wet"], ["p_dry", "p_near", "p_wet"], "tercile")
    return scores.select(*(F.round(c, 6).alias(c) for c in ("rps", "rps_climatology", "rpss", "accuracy")))


@query("triangular_quantiles", """
WITH u AS (SELECT p_partkey, (p_partkey % 100 + 0.5) / 100 AS u FROM part)
SELECT p_partkey, round(CASE WHEN u < 0.25 THEN 1 + sqrt(u * 4 * 1) ELSE 5 - sqrt((1 - u) * 4 * 3) END, 8) AS x, 2.0 AS flat FROM u""")
def triangular_quantiles(spark, sf_dir):
    u = (F.col("p_partkey") % 100 + 0.5) / 100
    return table(spark, sf_dir, "part").select("p_partkey", F.round(finance.triangular(u, 1.0, 2.0, 5.0), 8).alias("x"), finance.triangular(u, 3.0, 2.0, 5.0).alias("flat"))


PROJECT = "WITH p AS (SELECT t, CASE WHEN t = 0 THEN 0.0 ELSE 300.0 + 20 * t END AS b, CASE WHEN t = 0 THEN 1000.0 ELSE 50.0 END AS c FROM range(10) r(t))\n"


def project(spark):
    return spark.createDataFrame([(t, 0.0 if t == 0 else 300.0 + 20 * t, 1000.0 if t == 0 else 50.0, 0.1) for t in range(10)], "year int, project_benefit double, cost double, discount_rate double")


@query("simulation_finals", PROJECT + "SELECT 200 AS simulations, round(sum((b - c) / pow(1.1, t)), 4) AS npv_p50, round(sum((b - c) / pow(1.1, t)), 4) AS npv_p90, round(sum(b / pow(1.1, t)) / sum(c / pow(1.1, t)), 6) AS bcr_p10, 1.0 AS p_npv_positive, 200 AS npv_n FROM p")
def simulation_finals(spark, sf_dir):
    """With scales that cannot vary, every simulation is the project itself."""
    finals = finance.simulation_finals(finance.simulate(project(spark), (1.0, 1.0, 1.0), (1.0, 1.0, 1.0), simulations=200))
    return finals.select("simulations", F.round("npv_p50", 4).alias("npv_p50"), F.round("npv_p90", 4).alias("npv_p90"), F.round("bcr_p10", 6).alias("bcr_p10"), "p_npv_positive", "npv_n")


@query("simulation_empty", "SELECT 0 AS simulations, NULL::DOUBLE AS npv_p50, 0 AS npv_n")
def simulation_empty(spark, sf_dir):
    finals = finance.simulation_finals(finance.simulate(project(spark).limit(0), (0.7, 1.0, 1.2), (0.9, 1.0, 1.3), simulations=20))
    return finals.select("simulations", "npv_p50", "npv_n")


@query("simulation_bands", PROJECT + "SELECT t AS year, true AS inside FROM p")
def simulation_bands(spark, sf_dir):
    """At the operator's defaults, every year's NPV quantiles lie between those of the worst and the best scales."""
    bands = finance.simulation_bands(finance.simulate(project(spark), (0.7, 1.0, 1.2), (0.9, 1.0, 1.3)))
    ends = [finance.simulate(project(spark), (b, b, b), (c, c, c), simulations=1).select("year", F.col("npv").alias(name)) for b, c, name in ((0.7, 1.3, "worst"), (1.2, 0.9, "best"))]
    joined = bands.join(ends[0], "year").join(ends[1], "year")
    inside = (F.col("worst") <= F.col("npv_p10")) & (F.col("npv_p10") <= F.col("npv_p50")) & (F.col("npv_p50") <= F.col("npv_p90")) & (F.col("npv_p90") <= F.col("best")) & (F.col("npv_n") == 2000)
    return joined.select(F.col("year").cast("long").alias("year"), inside.alias("inside"))


@query("avoided_loss_uncertainty", "SELECT 9 AS n, true AS near, true AS ordered")
def avoided_loss_uncertainty(spark, sf_dir):
    """The runs' median lies within 2 % of the closed form; quantiles are in order and the samples are all there."""
    found = finance.avoided_loss_uncertainty(spark, 0.3, 0.2)
    closed = finance.PHI0 * 0.3 * 0.2
    ordered = (F.col("p10") <= F.col("p50")) & (F.col("p50") <= F.col("p90")) & (F.size("samples") == F.col("n"))
    return found.select("n", (F.abs(F.col("p50") - closed) <= 0.02 * closed).alias("near"), ordered.alias("ordered"))


# gates


@query("validation_labels", """
WITH r AS (SELECT p_type, max(p_size) AS m, count(*) AS n, count(DISTINCT p_brand) AS b FROM part GROUP BY 1), t AS (SELECT *, m * 2.0 <= 102 AND b >= 4 AS sound, n % 2 = 0 AND n >= 5 AS dual, 90 + n % 11 >= 97 AS adds FROM r)
SELECT p_type, CASE WHEN n % 13 = 0 THEN 'verified by hand' WHEN sound AND dual AND adds THEN 'two engines and totals' WHEN sound AND dual THEN 'two engines' WHEN sound AND adds THEN 'printed totals' ELSE 'not served' END AS validation FROM t""")
def validation_labels(spark, sf_dir):
    n = F.count(F.lit(1))
    report = table(spark, sf_dir, "part").groupBy("p_type").agg(F.lit(0).alias("unattributed"), (100.0 * F.max("p_size") / 50).alias("max_share_pct"), F.countDistinct("p_brand").alias("counties"), F.when(n % 2 == 0, 0.99).alias("dual_ok"), n.alias("shared"), (90.0 + n % 11).alias("additivity_pct"), (n % 13 == 0).alias("verified"))
    return gates.serve_gate(report).select("p_type", "validation")


@query("index_gate_full", """
WITH d AS (SELECT *, page_id // 20 AS p, CASE WHEN page_id = 25 THEN 0 ELSE page_id // 20 END AS echo, -page_id AS o FROM pages UNION ALL SELECT *, 0, 0, 5 FROM pages WHERE page_id = 3)
SELECT count(*) AS rows, count(DISTINCT page_id) AS unique_keys, count(*) - count(DISTINCT page_id) AS repeats, count(DISTINCT p) AS pages, 0 AS malformed, count(*) FILTER (echo <> p) AS wrong_echoes, 0 AS out_of_order, false AS complete FROM d""")
def index_gate_full(spark, sf_dir):
    """A harvest with a repeated row and a wrong echo, against the count that the source states."""
    pages = table(spark, sf_dir, "pages")
    page = F.floor(F.col("page_id") / 20)
    rows = pages.select("page_id", page.alias("p"), F.when(F.col("page_id") == 25, F.lit(0).cast("long")).otherwise(page).alias("echo"), (-F.col("page_id")).alias("o"))
    again = rows.where("page_id = 3").withColumn("o", F.lit(5).cast("long"))
    return gates.index_gate(rows.unionByName(again), "page_id", "p", 20, pages.count(), "^[0-9]+$", echo="echo", order="o")


@query("suspect_reasons", """
WITH r AS (SELECT s_nationkey AS k, s_suppkey % 4 AS product, s_suppkey // 4 AS year, CASE WHEN s_suppkey % 4 = 1 THEN 7.0 WHEN s_suppkey % 4 = 2 THEN 7.0 WHEN s_suppkey % 17 = 0 THEN 0.1 ELSE 10.0 + s_suppkey END AS q, 2.0 AS p, s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 3.0 END AS spoil FROM supplier),
v AS (SELECT *, coalesce(spoil, q * p) AS v FROM r), n AS (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1)
SELECT s_suppkey, CASE WHEN q < 0.1 * max(q) OVER (PARTITION BY k, product) THEN 'under_entry' WHEN count(*) OVER (PARTITION BY k, product, q, v) > 1 THEN 'identical_years'
  WHEN min(product) OVER (PARTITION BY k, year, q, v) <> max(product) OVER (PARTITION BY k, year, q, v) THEN 'identical_products' WHEN NOT abs(q * p - v) <= greatest(2, 0.02 * abs(v)) THEN 'identity' END AS reason FROM v""")
def suspect_reasons(spark, sf_dir):
    key = F.col("s_suppkey")
    q = F.when(key % 4 == 1, 7.0).when(key % 4 == 2, 7.0).when(key % 17 == 0, 0.1).otherwise(10.0 + key)
    rows = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), (key % 4).alias("product"), F.floor(key / 4).alias("year"), q.alias("q"), F.lit(2.0).alias("p"), "s_suppkey")
    rows = rows.withColumn("v", F.when(F.col("s_suppkey") % 5 == 0, 3.0).otherwise(F.col("q") * F.col("p")))
    return gates.suspects(rows, ["k", "product"], "year", "q", ["v"], product="product", identity=("q", "p", "v")).select("s_suppkey", F.col("suspect_reason").alias("reason"))


@query("content_fingerprint", "SELECT count(*) AS rows, true AS same, true AS differs, true AS repeats_count FROM orders")
def content_fingerprint(spark, sf_dir):
    """The fingerprint is the same in any order, another after any change, and sees a repeated row."""
    orders = table(spark, sf_dir, "orders")
    own = gates.fingerprint(orders)
    other = gates.fingerprint(orders.orderBy(F.desc("o_totalprice"))).select(F.col("rows").alias("r1"), F.col("content").alias("c1"))
    changed = gates.fingerprint(orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 7, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")))).select(F.col("content").alias("c2"))
    twice = gates.fingerprint(orders.unionByName(orders.where("o_orderkey IN (3, 4)"))).select(F.col("rows").alias("r3"), F.col("content").alias("c3"))
    return own.crossJoin(other).crossJoin(changed).crossJoin(twice).select("rows", ((F.col("rows") == F.col("r1")) & (F.col("content") == F.col("c1"))).alias("same"), (F.col("content") != F.col("c2")).alias("differs"), ((F.col("r3") == F.col("rows") + 2) & (F.col("c3") != F.col("content"))).alias("repeats_count"))  # one row each


@query("slice_preserved", "SELECT o_orderstatus <> 'P' AS kept, count(*) AS rows, true AS same FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def slice_preserved(spark, sf_dir):
    """Replacing one slice leaves the rest as it was, by row count and fingerprint."""
    orders = table(spark, sf_dir, "orders")
    new = orders.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    after = relational.replace_slice(orders, new, F.col("o_orderstatus") == "P")
    rest = gates.fingerprint(orders.where("o_orderstatus <> 'P'"))
    then = gates.fingerprint(after.where("o_orderstatus <> 'P'")).select(F.col("rows").alias("r"), F.col("content").alias("c"))
    return rest.crossJoin(then).select(F.lit(True).alias("kept"), "rows", ((F.col("rows") == F.col("r")) & (F.col("content") == F.col("c"))).alias("same"))  # one row each


@query("longest_name", "SELECT s_nationkey, s_name AS name FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY length(s_name) DESC, s_suppkey DESC) = 1")
def longest_name(spark, sf_dir):
    return table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(A.longest("s_name", "s_suppkey").alias("name"))


@query("additivity_totals", "SELECT o_orderkey, round(sum(l_extendedprice), 2) AS parts_sum, o_totalprice AS total, round(100 * sum(l_extendedprice) / o_totalprice, 1) AS additivity_pct FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_totalprice")
def additivity_totals(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")
    totals = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("total"))
    rows = A.additivity(lines, totals, ["o_orderkey"], "l_extendedprice", "total").where(F.col("total").isNotNull())
    return rows.withColumn("parts_sum", F.round("parts_sum", 2))


@query("value_portfolio", "WITH v AS (SELECT s_nationkey, s_suppkey, greatest(s_acctbal, 0) AS w FROM supplier), n AS (SELECT c_nationkey, sum(c_acctbal) AS total FROM customer GROUP BY 1 HAVING sum(c_acctbal) > 0) SELECT s_suppkey, round(total * w / sum(w) OVER (PARTITION BY s_nationkey), 4) AS apportioned FROM v JOIN n ON s_nationkey = c_nationkey QUALIFY sum(w) OVER (PARTITION BY s_nationkey) > 0")
def value_portfolio(spark, sf_dir):
    """Positive national values, apportioned to places by their weights."""
    totals = A.positive_sums(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal", "total").withColumnRenamed("c_nationkey", "s_nationkey")
    weights = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", F.greatest("s_acctbal", F.lit(0.0)).alias("w"), F.lit(0.0).alias("none"))
    shares = A.shares(weights, ["s_nationkey"], "w", "none").where(F.col("share").isNotNull())
    return shares.join(totals, "s_nationkey").select("s_suppkey", F.round(F.col("total") * F.col("share"), 4).alias("apportioned"))


# nested documents


@query("plume_rows", """
SELECT s_nationkey AS k, 'm' || (s_suppkey % 3) AS model, l.l AS label, CAST(l.i AS BIGINT) AS place, CASE WHEN l.i < 2 THEN s_suppkey * 1.5 + l.i END AS value, s_suppkey FROM supplier CROSS JOIN (VALUES ('DJF', 0), ('JFM', 1), ('FMA', 2)) l(l, i)""")
def plume_rows(spark, sf_dir):
    key = F.col("s_suppkey").cast("string")
    value = lambda at: (F.col("s_suppkey") * F.lit(1.5) + at).cast("string")
    text = F.concat(F.lit('{"labels": ["DJF", "JFM", "FMA"], "models": [{"name": "m'), (F.col("s_suppkey") % 3).cast("string"), F.lit('", "values": ['), value(0), F.lit(", "), value(1), F.lit('], "id": '), key, F.lit("}]}"))
    rows = nested.parsed(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), "s_suppkey", text.alias("text")), "text", "labels array<string>, models array<struct<name: string, values: array<double>>>")
    flat = nested.flattened(rows.drop("text"), "doc")
    return nested.model_rows(flat, ["k", "s_suppkey"], "models", "labels").withColumn("place", F.col("place").cast("long"))


@query("alert_fanout", "SELECT event_id, unnest(CASE WHEN event_id % 3 = 0 THEN [] ELSE ['a' || event_id % 5, 'b'] END) AS county FROM events")
def alert_fanout(spark, sf_dir):
    counties = F.when(F.col("event_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("a"), (F.col("event_id") % 5).cast("string")), F.lit("b")))
    return nested.fan_out(table(spark, sf_dir, "events").select("event_id", counties.alias("counties")), "counties", "county")


@query("geojson_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS name, CAST(NULL AS VARCHAR) AS absent FROM events")
def geojson_props(spark, sf_dir):
    text = F.concat(F.lit('{"type": "Feature", "properties": {"name": "'), "event_type", F.lit('", "inner": '), "props", F.lit("}}"))
    rows = nested.parsed(table(spark, sf_dir, "events").select("event_id", text.alias("t")), "t", "properties struct<name: string, absent: string, inner: struct<k: bigint>>")
    return nested.flattened(rows.select("event_id", "doc.properties"), "properties").select("event_id", "k", "name", "absent")


@query("event_seasons", "SELECT o_orderkey, s AS season, year(o_orderdate) AS year FROM orders CROSS JOIN (VALUES ('MAM'), ('OND')) t(s) WHERE o_orderkey % 2 = 0")
def event_seasons(spark, sf_dir):
    year = F.year("o_orderdate").cast("string")
    labels = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.concat(F.lit("MAM-"), year), F.concat(F.lit("OND-"), year)))
    return nested.season_rows(table(spark, sf_dir, "orders").select("o_orderkey", labels.alias("seasons")), "seasons").withColumn("year", F.col("year").cast("long"))


@query("balanced_slice", """SELECT event_id, '{"a": {"b": "}' || event_type || '"}, "c": ' || props || '}' AS object FROM events""")
def balanced_slice(spark, sf_dir):
    wanted = F.concat(F.lit('{"a": {"b": "}'), "event_type", F.lit('"}, "c": '), "props", F.lit("}"))
    page = F.concat(F.lit("<script>state = "), wanted, F.lit("; other = {1}}</script>"))
    return table(spark, sf_dir, "events").select("event_id", page.alias("page")).select("event_id", C.balanced_slice(F.col("page"), F.instr("page", "state = ")).alias("object"))


@query("object_entries", "SELECT n_nationkey, k.k AS key, CASE k.k WHEN 'name' THEN n_name ELSE CAST(n_regionkey AS VARCHAR) END AS value FROM nation CROSS JOIN (VALUES ('name'), ('region')) k(k)")
def object_entries(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")).alias("o"))
    pairs = rows.select("n_nationkey", nested.from_entries(nested.entries("o", rows)).alias("m"))
    return pairs.select("n_nationkey", F.explode("m").alias("key", "value"))


@query("transposed_rows", "SELECT x, y FROM (SELECT unnest([1, 2, NULL, 4]) AS x, unnest(['a', NULL, NULL, 'd']) AS y) WHERE x IS NOT NULL OR y IS NOT NULL")
def transposed_rows(spark, sf_dir):
    columns = spark.createDataFrame([([1, 2, None, 4], ["a", None, None, "d"])], "x array<int>, y array<string>")
    return A.rows_from_columns(columns, "x", "y")


@query("cells_by_layout", """
SELECT s_suppkey, m AS metric, y AS year, CASE WHEN i < 3 THEN s_suppkey + i * 10.0 END AS value FROM supplier CROSS JOIN (VALUES ('area', 2019, 0), ('production', 2019, 1), ('area', 2020, 2), ('production', 2020, 3)) l(m, y, i)""")
def cells_by_layout(spark, sf_dir):
    cells = F.array(*(F.col("s_suppkey") + at * F.lit(10.0) for at in range(3)))
    layout = [("area", 2019), ("production", 2019), ("area", 2020), ("production", 2020)]
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(C.by_layout(cells, layout)).alias("c"))
    return rows.select("s_suppkey", "c.metric", "c.year", "c.value")


# grids


WORDS = "WITH w AS (SELECT o_custkey AS page, 10.0 * (o_orderkey % 4) + 0.5 * (o_orderkey % 2) AS x, CAST(o_orderkey // 4 AS DOUBLE) * 3 AS y, CAST(o_orderkey AS VARCHAR) AS text, o_orderkey FROM orders)\n"


def words(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"), (F.lit(10.0) * (key % 4) + F.lit(0.5) * (key % 2)).alias("x"), (F.floor(key / 4).cast("double") * 3).alias("y"), key.cast("string").alias("text"))


@query("grid_lines", WORDS + ", g AS (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY page ORDER BY y, x) > 100 THEN 1 ELSE 0 END AS h FROM w), b AS (SELECT *, sum(h) OVER (PARTITION BY page ORDER BY y, x ROWS UNBOUNDED PRECEDING) AS band FROM g) SELECT page, CAST(band AS BIGINT) AS band, string_agg(text, ' ' ORDER BY x, text) AS line FROM b GROUP BY page, band")
def grid_lines(spark, sf_dir):
    return grids.lines(words(spark, sf_dir), 100.0)


@query("grid_cells", WORDS + ", g AS (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY page ORDER BY y, x) > 100 THEN 1 ELSE 0 END AS h FROM w), b AS (SELECT *, sum(h) OVER (PARTITION BY page ORDER BY y, x ROWS UNBOUNDED PRECEDING) AS band FROM g) SELECT page, CAST(band AS BIGINT) AS band, CASE WHEN x < 5 THEN 'name' ELSE 'area' END AS \"column\", string_agg(text, ' ' ORDER BY x, text) AS text FROM b WHERE x < 12 GROUP BY ALL")
def grid_cells(spark, sf_dir):
    return grids.cells(words(spark, sf_dir), [("name", 0.0), ("area", 10.0)], 100.0, 2.0)


@query("grid_turned", WORDS + "SELECT page, text, CASE WHEN page % 2 = 0 THEN -y ELSE x END AS x, CASE WHEN page % 2 = 0 THEN x ELSE y END AS y FROM (SELECT page, x, y, CASE WHEN page % 2 = 0 THEN reverse(text) ELSE text END AS text FROM w)")
def grid_turned(spark, sf_dir):
    """Pages on their side with glyphs in reverse order, set upright."""
    rows = words(spark, sf_dir).withColumn("turned", F.col("page") % 2 == 0)
    return grids.upright(rows, "turned", mirrored=True).drop("turned")


@query("reading_order", WORDS + """, b AS (SELECT page, x, y, CASE WHEN o_orderkey % 5 = 0 THEN 'A' || o_orderkey || ' head' ELSE text END AS text, o_orderkey FROM w),
p AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY floor(x / 20), y, x) AS place FROM b)
SELECT page, place, last_value(CASE WHEN text LIKE 'A%' THEN regexp_extract(text, '^A[0-9]+') END IGNORE NULLS) OVER (PARTITION BY page ORDER BY place ROWS UNBOUNDED PRECEDING) AS region FROM p""")
def reading_order(spark, sf_dir):
    head = F.when(F.col("text").cast("long") % 5 == 0, F.concat(F.lit("A"), "text", F.lit(" head"))).otherwise(F.col("text"))
    blocks = words(spark, sf_dir).withColumn("text", head)
    return grids.reading_order(blocks, 20.0, "^A[0-9]+").select("page", F.col("place").cast("long").alias("place"), "region")


@query("season_anomaly_terciles", NATION_ORDERS + """, m AS (SELECT nation, year, avg(o_totalprice) AS v FROM o GROUP BY ALL), b AS (SELECT nation, quantile_cont(v, 1.0/3) AS t1, quantile_cont(v, 2.0/3) AS t2 FROM m GROUP BY 1 HAVING count(*) >= 3)
SELECT CASE WHEN v <= t1 THEN 'Dry' WHEN v > t2 THEN 'Wet' ELSE 'Near' END AS tercile, count(*) AS n FROM m JOIN b USING (nation) GROUP BY 1""")
def season_anomaly_terciles(spark, sf_dir):
    rows = nation_orders(spark, sf_dir).groupBy("nation", "year").agg(F.avg("o_totalprice").alias("v"))
    return seasonal.anomalies(rows, ["nation"], "year", "v", 0, 9999, least=3).groupBy("tercile").agg(F.count(F.lit(1)).alias("n"))
