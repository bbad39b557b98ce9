"""Queries of column functions and of the remaining gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrolith.functions import columns as C
from agrolith.operators import aggregates as A
from agrolith.operators import gates, seasonal

from .registry import query, table


@query("text_functions", r"""
SELECT p_partkey, upper(p_type[1]) || lower(p_type[2:]) AS capital, regexp_extract(p_name, '[^_#-]*$') AS tail, regexp_replace('Yield ' || p_type || ', 2021', ',?\s*\d{4}$', '') AS label,
       regexp_replace(p_name || '.csv', '\.[^./]+$', '') AS stem, 'Maize' AS crop, lower(p_type) AS season FROM part""")
def text_functions(spark, sf_dir):
    named = F.concat(F.lit("Maize ("), F.lower("p_type"), F.lit(")"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        C.first_upper(F.lower("p_type")).alias("capital"),
        F.regexp_extract("p_name", "[^_#-]*$", 0).alias("tail"),
        C.drop_trailing_year(F.concat(F.lit("Yield "), F.col("p_type"), F.lit(", 2021"))).alias("label"),
        C.without_extension(F.concat("p_name", F.lit(".csv"))).alias("stem"),
        C.outside_parentheses(named).alias("crop"),
        C.inside_parentheses(named).alias("season"),
    )


@query("paragraph_counts", "SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS n FROM documents")
def paragraph_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(C.paragraphs(F.col("text"))).cast("long").alias("n"))


CELLS = "WITH c AS (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN '–' WHEN 1 THEN '1,2' || s_suppkey WHEN 2 THEN 'n/a' WHEN 3 THEN 'Total' ELSE ' ' || s_suppkey || '.5 ' END AS cell FROM supplier)\n"


@query("table_cells", CELLS + "SELECT s_suppkey, CASE WHEN lower(trim(cell)) IN ('', '-', '–', '—', 'n/a', 'na', '..') THEN 'missing' WHEN try_cast(replace(trim(cell), ',', '') AS DOUBLE) IS NOT NULL THEN 'number' ELSE 'text' END AS kind, try_cast(replace(trim(cell), ',', '') AS DOUBLE) AS value FROM c")
def table_cells(spark, sf_dir):
    key = F.col("s_suppkey").cast("string")
    cell = F.when(F.col("s_suppkey") % 5 == 0, "–").when(F.col("s_suppkey") % 5 == 1, F.concat(F.lit("1,2"), key)).when(F.col("s_suppkey") % 5 == 2, "n/a").when(F.col("s_suppkey") % 5 == 3, "Total").otherwise(F.concat(F.lit(" "), key, F.lit(".5 ")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", cell.alias("cell")).select("s_suppkey", C.cell_kind(F.col("cell")).alias("kind"), C.numeric_cell(F.col("cell")).alias("value"))


@query("number_functions", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice / 70001.3 * 100, 6) AS pct, round((l_extendedprice - 20001.37) / 20001.37 * 100, 6) AS anomaly, greatest(0, least(100, l_quantity * 3)) AS clamped,
       abs(l_quantity * 900 - l_extendedprice) <= greatest(2, abs(l_extendedprice) * 0.02) AS holds, l_quantity / 10 BETWEEN 0.25 AND 4 AS banded, round_even(l_linenumber / 8.0, 0) * 8 AS grid,
       CASE WHEN l_discount < 0.03 THEN 'Low' WHEN l_discount < 0.06 THEN 'Middle' ELSE 'High' END AS class FROM lineitem""")
def number_functions(spark, sf_dir):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(C.percent_of(p, F.lit(70001.3)), 6).alias("pct"),
        F.round(C.percent_anomaly(p, F.lit(20001.37)), 6).alias("anomaly"),
        C.clamp_percent(q * 3).alias("clamped"),
        C.product_holds(q, F.lit(900.0), p).alias("holds"),
        C.ratio_within(q, F.lit(10.0)).alias("banded"),
        C.band(F.col("l_linenumber")).cast("double").alias("grid"),
        C.class_between(F.col("l_discount"), [0.03, 0.06], ["Low", "Middle", "High"]).alias("class"),
    )


@query("unit_scaling", "SELECT p_partkey, p_retailprice * CASE p_size % 3 WHEN 0 THEN 1000000 WHEN 1 THEN 0.001 ELSE 0.404686 END AS scaled FROM part")
def unit_scaling(spark, sf_dir):
    unit = F.element_at(F.array(F.lit("million"), F.lit("kg"), F.lit("acre")), (F.col("p_size") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", C.scaled_by(F.col("p_retailprice"), unit, {"million": 1e6, "kg": 0.001, "acre": 0.404686}).alias("scaled"))


@query("array_functions", "SELECT o_custkey, count(*) AS filled, CAST(len(list(o_totalprice)) AS BIGINT) AS n FROM orders GROUP BY 1")
def array_functions(spark, sf_dir):
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_totalprice").alias("v"), F.count(F.lit(1)).alias("n"))
    return lists.select("o_custkey", C.filled(F.col("v")).cast("long").alias("filled"), F.size("v").cast("long").alias("n"))


@query("freshness", "SELECT o_orderkey, CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02') <= 40 THEN 'fresh' ELSE 'late' END AS state FROM orders")
def freshness(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", C.age_state(F.col("o_orderdate").cast("date"), F.lit("1998-08-02").cast("date"), F.lit(40)).alias("state"))


@query("date_parts", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS period, make_timestamp(epoch_ms(o_orderdate) * 1000) AS back FROM orders")
def date_parts(spark, sf_dir):
    date = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select("o_orderkey", C.year_month_text(F.year("o_orderdate"), F.month("o_orderdate")).alias("period"), C.from_epoch_ms(F.unix_millis(date)).cast("timestamp_ntz").alias("back"))


@query("strength_classes", "SELECT c_custkey, CASE WHEN abs(z) >= 1.5 THEN 'strong' WHEN abs(z) >= 1 THEN 'moderate' ELSE 'neutral' END || CASE WHEN abs(z) < 1 THEN '' WHEN z > 0 THEN ' +' ELSE ' -' END AS class FROM (SELECT c_custkey, (c_acctbal - 4500) / 3000 AS z FROM customer)")
def strength_classes(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", seasonal.strength((F.col("c_acctbal") - 4500) / 3000).alias("class"))


@query("largest_cluster", """
WITH g AS (SELECT s_suppkey, s_nationkey, s_acctbal, CASE WHEN s_acctbal - lag(s_acctbal) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal) > 1500 THEN 1 ELSE 0 END AS head FROM supplier),
c AS (SELECT *, sum(head) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal ROWS UNBOUNDED PRECEDING) AS k FROM g), n AS (SELECT s_nationkey, k, count(*) AS n FROM c GROUP BY ALL),
b AS (SELECT s_nationkey, k FROM n QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY n DESC, k) = 1) SELECT s_suppkey FROM c SEMI JOIN b USING (s_nationkey, k)""")
def largest_cluster(spark, sf_dir):
    return A.largest_cluster(table(spark, sf_dir, "supplier"), ["s_nationkey"], "s_acctbal", 1500.0).select("s_suppkey")


@query("best_orientation", "SELECT c_nationkey, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment DESC, c_acctbal DESC, c_custkey DESC) = 1")
def best_orientation(spark, sf_dir):
    return gates.best_of(table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_mktsegment", "c_acctbal"), ["c_nationkey"], "c_mktsegment", "c_acctbal", "c_custkey").select("c_nationkey", "c_custkey")


@query("identity_gate", """
WITH t AS (SELECT s_suppkey % 20 AS k, s_suppkey AS y, CASE WHEN s_suppkey % 13 = 0 THEN 900.0 ELSE 100.0 + s_suppkey END AS q, 2.0 AS p, CASE WHEN s_suppkey % 7 = 0 THEN 1.0 ELSE CASE WHEN s_suppkey % 13 = 0 THEN 1800.0 ELSE 200.0 + 2 * s_suppkey END END AS v FROM supplier),
s AS (SELECT *, coalesce(q / lag(q) OVER (PARTITION BY k ORDER BY y) BETWEEN 0.25 AND 4, true) AS ok FROM t WHERE abs(q * p - v) <= greatest(2, 0.02 * abs(v)))
SELECT k, y FROM s WHERE k NOT IN (SELECT k FROM s WHERE NOT ok)""")
def identity_gate(spark, sf_dir):
    key = F.col("s_suppkey")
    q = F.when(key % 13 == 0, 900.0).otherwise(100.0 + key)
    rows = table(spark, sf_dir, "supplier").select((key % 20).alias("k"), key.alias("y"), q.alias("q"), F.lit(2.0).alias("p"), F.when(key % 7 == 0, 1.0).otherwise(q * 2).alias("v"))
    return gates.identity_gate(rows, ["k"], "y", "q", "p", "v").select("k", "y")


@query("totals_gate", "SELECT s_suppkey, abs(100.0 + s_suppkey - total) <= 0.5 AND a IS NOT NULL AS passed FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 9 <> 0 THEN 60.0 END AS a, 40.0 + s_suppkey AS b, 100.0 + s_suppkey + s_suppkey % 2 AS total FROM supplier)")
def totals_gate(spark, sf_dir):
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(key % 9 != 0, 60.0).alias("a"), (40.0 + key).alias("b"), (100.0 + key + key % 2).alias("total"))
    return gates.totals_gate(rows, ["s_suppkey"], ["a", "b"], "total").select("s_suppkey", "passed")


@query("suspect_rows", "SELECT o_orderkey, CASE WHEN o_totalprice < 0.1 * max(o_totalprice) OVER (PARTITION BY o_custkey) THEN 'under_entry' WHEN count(*) OVER (PARTITION BY o_custkey, o_totalprice, o_orderstatus) > 1 THEN 'identical_years' END AS reason FROM orders")
def suspect_rows(spark, sf_dir):
    return gates.suspects(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "o_totalprice", ["o_orderstatus"]).select("o_orderkey", F.col("suspect_reason").alias("reason"))


@query("metadata_states", """
SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 AND n_nationkey % 4 = 0 THEN 'invalid' WHEN n_nationkey % 2 = 0 AND n_nationkey % 3 = 0 THEN 'draft' WHEN n_nationkey % 2 = 0 THEN 'authored' WHEN n_regionkey = 1 THEN 'catalogue-only' ELSE 'undocumented' END AS state,
       CASE WHEN n_regionkey = 4 THEN 'restricted' WHEN n_nationkey % 5 = 0 THEN 'hosted' WHEN n_nationkey % 7 <> 0 THEN 'linked' ELSE 'none' END AS hosting FROM nation""")
def metadata_states(spark, sf_dir):
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    record = table(spark, sf_dir, "nation").select("n_nationkey", (key % 2 == 0).alias("has_record"), (key % 4 != 0).alias("valid"), (key % 3 == 0).alias("draft"), (region == 1).alias("has_catalogue"), (region == 4).alias("restricted"), (key % 5 == 0).alias("has_file"), F.when(key % 7 != 0, F.lit("https://example.org/x")).alias("url"))
    return gates.metadata_state(record).select("n_nationkey", "state", "hosting")


@query("served_audit", "SELECT c_nationkey AS key, count(DISTINCT c_mktsegment) AS counties, c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000) AS served FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) >= 4")
def served_audit(spark, sf_dir):
    tables = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("key")).agg(F.countDistinct("c_mktsegment").alias("counties"))
    served = table(spark, sf_dir, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("key"))
    return gates.audit(tables, served, "key")
