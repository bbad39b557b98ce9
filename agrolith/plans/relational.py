"""Queries of scans, the table specification, parameters, levels, joins and sets, on the star schema.

Regions, nations and customers stand for the three levels of a hierarchy, part types for commodities.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from agrolith.functions import columns as C
from agrolith.operators import gates, hierarchy, params, relational
from agrolith.operators.spec import Filter, Sort, TableSpec, evaluate, render_sql, search

from .registry import query, table

LEVELS = """
WITH base AS (
  SELECT r_name AS admin0_name, n_name AS admin1_name, c_name AS admin2_name, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
levels AS (
  SELECT admin0_name, admin1_name, admin2_name, CAST(GROUPING(admin0_name, admin1_name, admin2_name) AS BIGINT) AS level_id,
         round(sum(o_totalprice), 2) AS revenue, count(*) AS n_orders
  FROM base GROUP BY ROLLUP (admin0_name, admin1_name, admin2_name))
"""


def levels(spark, sf_dir, depth):
    """Revenue at one level of a rollup-encoded table: by so many leading keys, so no other level is expanded. Customers, nations and regions are joined smallest first;
    the planner broadcasts what it knows to be small."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", F.col("n_name").alias("admin1_name"), F.col("r_name").alias("admin0_name"))
    customers = table(spark, sf_dir, "customer").join(relational.small(places), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    base = orders.join(customers.select("c_custkey", "admin0_name", "admin1_name", F.col("c_name").alias("admin2_name")), F.col("o_custkey") == F.col("c_custkey"))
    return hierarchy.rollup_table(base, ["admin0_name", "admin1_name", "admin2_name"], F.round(F.sum("o_totalprice"), 2).alias("revenue"), F.count(F.lit(1)).alias("n_orders"), depths=[depth])


@query("admin_rollup_level0", LEVELS + "SELECT * FROM levels WHERE level_id = 3")
def admin_rollup_level0(spark, sf_dir):
    return levels(spark, sf_dir, 1).where(params.level_column({}, grouping="level_id"))


@query("admin_rollup_level1", LEVELS + "SELECT * FROM levels WHERE admin0_name IN ('ASIA', 'EUROPE') AND admin1_name IS NOT NULL AND admin2_name IS NULL")
def admin_rollup_level1(spark, sf_dir):
    bind = params.Bindings()
    where = params.level_sql({"admin0": ["ASIA", "EUROPE"]}, bind)
    name = f"levels_{uuid.uuid4().hex}"
    levels(spark, sf_dir, 2).createOrReplaceTempView(name)
    found = spark.sql(f"SELECT * FROM {name} WHERE {where}", args=bind.params)
    spark.catalog.dropTempView(name)  # the frame keeps its plan
    return found


@query("admin_rollup_level2", LEVELS + "SELECT * FROM levels WHERE admin0_name IN ('AFRICA') AND admin1_name IN (SELECT min(n_name) FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AFRICA') AND level_id = 0")
def admin_rollup_level2(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    first = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where("r_name = 'AFRICA'").agg(F.min("n_name")).first()[0]
    return levels(spark, sf_dir, 3).where(params.level_column({"admin0": "AFRICA", "admin1": first}, grouping="level_id"))


@query("cube_returnflag_status", "SELECT l_returnflag, l_linestatus, CAST(GROUPING(l_returnflag, l_linestatus) AS BIGINT) AS level_id, round(sum(l_quantity), 2) AS quantity, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_returnflag_status(spark, sf_dir):
    return hierarchy.cube_table(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], F.round(F.sum("l_quantity"), 2).alias("quantity"), F.count(F.lit(1)).alias("n"))


FILTERS = {
    "eq": ("part", Filter("eq", "p_brand", ["Brand#1"]), "p_brand = 'Brand#1'"),
    "ne": ("part", Filter("ne", "p_size", [10]), "p_size <> 10"),
    "lt": ("customer", Filter("lt", "c_acctbal", [0.0]), "c_acctbal < 0"),
    "lte": ("part", Filter("lte", "p_size", [5]), "p_size <= 5"),
    "gt": ("customer", Filter("gt", "c_acctbal", [9000.0]), "c_acctbal > 9000"),
    "gte": ("part", Filter("gte", "p_size", [45]), "p_size >= 45"),
    "in": ("customer", Filter("in", "c_mktsegment", ["BUILDING", "MACHINERY"]), "c_mktsegment IN ('BUILDING', 'MACHINERY')"),
    "nin": ("customer", Filter("nin", "c_mktsegment", ["BUILDING", "MACHINERY"]), "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"),
    "c": ("part", Filter("c", "p_name", ["1"]), "contains(p_name, '1')"),
    "nc": ("part", Filter("nc", "p_type", ["a"]), "NOT contains(p_type, 'a')"),
    "n": ("labelled", Filter("n", "toxic"), "toxic IS NULL"),
    "nn": ("labelled", Filter("nn", "toxic"), "toxic IS NOT NULL"),
    "v": ("labelled", Filter("v", "ratio"), "ratio IS NOT NULL AND NOT isnan(ratio)"),
    "nv": ("labelled", Filter("nv", "ratio"), "ratio IS NULL OR isnan(ratio)"),
}
LABELLED = "(SELECT d.doc_id, lang, toxic, CASE WHEN quality = 0 THEN 'NaN'::DOUBLE ELSE CAST(quality AS DOUBLE) END AS ratio FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def filtered(source, entry):
    def run(spark, sf_dir):
        if source != "labelled":
            return evaluate(table(spark, sf_dir, source), TableSpec(filter=[entry]))
        docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
        ratio = F.when(F.col("quality") == 0, F.lit(float("nan"))).otherwise(F.col("quality").cast("double"))
        rows = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "lang", "toxic", ratio.alias("ratio"))
        # NaN has no common text form in result hashes
        return evaluate(rows, TableSpec(filter=[entry])).withColumn("ratio", F.nanvl("ratio", F.lit(-1.0)))

    return run


for _name, (_source, _entry, _condition) in FILTERS.items():
    _sql = f"SELECT * FROM {_source} WHERE {_condition}" if _source != "labelled" else f"SELECT doc_id, lang, toxic, CASE WHEN isnan(ratio) THEN -1 ELSE ratio END AS ratio FROM {LABELLED} WHERE {_condition}"
    query(f"spec_filter_{_name}", _sql)(filtered(_source, _entry))


@query("spec_pipeline", "SELECT o_orderkey AS key, o_totalprice / 1000 AS thousands FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50 OFFSET 10")
def spec_pipeline(spark, sf_dir):
    spec = TableSpec(derive={"thousands": "o_totalprice / 1000"}, filter=[Filter("eq", "o_orderstatus", ["F"])], sort=[Sort("o_totalprice", "desc"), Sort("o_orderkey")], slice=(10, 60), select=["o_orderkey", "thousands"], names={"o_orderkey": "key"})
    return evaluate(table(spark, sf_dir, "orders"), spec)


@query("spec_rendered_sql", "SELECT c_custkey AS id, c_name FROM customer WHERE c_acctbal >= 5000 AND c_mktsegment IN ('AUTOMOBILE') ORDER BY c_custkey LIMIT 40 OFFSET 5")
def spec_rendered_sql(spark, sf_dir):
    spec = TableSpec(filter=[Filter("gte", "c_acctbal", [5000.0]), Filter("in", "c_mktsegment", ["AUTOMOBILE"])], sort=[Sort("c_custkey")], slice=(5, 45), select=["c_custkey", "c_name"], names={"c_custkey": "id"})
    name = f"customer_{uuid.uuid4().hex}"
    table(spark, sf_dir, "customer").createOrReplaceTempView(name)
    sql, args = render_sql(name, spec)
    found = spark.sql(sql, args=args)
    spark.catalog.dropTempView(name)  # the frame keeps its plan
    return found


@query("row_search", r"SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE regexp_matches(concat_ws(' ', CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR)), '(?i)(^|\W)nation_1')")
def row_search(spark, sf_dir):
    return search(table(spark, sf_dir, "nation"), "nation_1")


@query("slice_offset", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 100 OFFSET 50")
def slice_offset(spark, sf_dir):
    return evaluate(table(spark, sf_dir, "customer"), TableSpec(sort=[Sort("c_custkey")], slice=(50, 150), select=["c_custkey", "c_name"]))


@query("sort_nulls_last_desc", "SELECT doc_id, toxic FROM documents LEFT JOIN labels USING (doc_id) ORDER BY toxic DESC NULLS LAST, doc_id")
def sort_nulls_last_desc(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "toxic")
    return evaluate(rows, TableSpec(sort=[Sort("toxic", "desc"), Sort("doc_id")]))


@query("collated_sort", "SELECT p_type, row_number() OVER (ORDER BY p_type COLLATE NOCASE.NOACCENT) AS place FROM (SELECT DISTINCT p_type FROM part)")
def collated_sort(spark, sf_dir):
    types = table(spark, sf_dir, "part").select("p_type").distinct()
    return relational.placed(types, "place", F.collate("p_type", "UNICODE_CI_AI").asc())


@query("left_last_wins", "SELECT c_custkey, last.o_orderkey AS last_order, last.o_totalprice AS last_price FROM customer LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) last ON c_custkey = last.o_custkey")
def left_last_wins(spark, sf_dir):
    joined = relational.left_last_wins(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), "c_custkey", "o_custkey", ["o_orderdate", "o_orderkey"])
    return joined.select("c_custkey", F.col("data.o_orderkey").alias("last_order"), F.col("data.o_totalprice").alias("last_price"))


@query("semi_selection", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment IN ('FURNITURE') AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def semi_selection(spark, sf_dir):
    nations = relational.selected(table(spark, sf_dir, "nation").withColumn("n_regionkey", F.col("n_regionkey").cast("string")), {"n_regionkey": "1"})
    customers = relational.selected(table(spark, sf_dir, "customer"), {"c_mktsegment": ["FURNITURE"]})
    return relational.cascade(nations.select(F.col("n_nationkey").alias("c_nationkey")), customers, ["c_nationkey"]).select("c_custkey", "c_name")


@query("anti_unmatched", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def anti_unmatched(spark, sf_dir):
    large = table(spark, sf_dir, "orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return relational.unmatched(table(spark, sf_dir, "customer").select("c_custkey"), large, ["c_custkey"])


@query("many_to_one", "SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def many_to_one(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return relational.many_to_one(table(spark, sf_dir, "supplier"), nations, "s_nationkey").select("s_suppkey", "s_name", "n_name")


@query("star_lookup", "SELECT r_name, p_brand, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey GROUP BY r_name, p_brand")
def star_lookup(spark, sf_dir):
    t = lambda name: table(spark, sf_dir, name)
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    customers = t("customer").join(relational.small(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    orders = t("orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "r_name")
    lines = t("lineitem").join(t("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy("r_name", "p_brand").agg(F.sum((F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")).cast("double").alias("revenue"), F.count(F.lit(1)).alias("n"))


TOKENS = [("NATION_1",), ("nation two",), ("East",), ("Old Name",), ("no such place",)]
KNOWN = [("NATION_1",), ("NATION_2",), ("East Region",), ("West Region",), ("West Coast",)]
ALIASES = {"nation two": "NATION_2", "Old Name": "West Coast"}


@query("resolve_prefix_join", """
WITH t(name) AS (VALUES ('NATION_1'), ('nation two'), ('East'), ('Old Name'), ('no such place'), ('West')),
k(key) AS (VALUES ('NATION_1'), ('NATION_2'), ('East Region'), ('West Region'), ('West Coast')),
a(name, key) AS (VALUES ('nation two', 'NATION_2'), ('Old Name', 'West Coast'))
SELECT name, coalesce((SELECT key FROM k WHERE k.key = t.name), (SELECT a.key FROM a JOIN k USING (key) WHERE a.name = t.name),
  (SELECT CASE WHEN count(*) = 1 THEN min(key) END FROM k WHERE length(t.name) >= 3 AND starts_with(key, t.name || ' '))) AS key FROM t""")
def resolve_prefix_join(spark, sf_dir):
    names = spark.createDataFrame([*TOKENS, ("West",)], "name string")
    return relational.resolve_names(names, spark.createDataFrame(KNOWN, "key string"), ALIASES)


@query("nearest_bin_join", """
WITH c(centre) AS (VALUES (950.0), (1000.0), (1050.0), (1100.0), (1400.0), (1900.0))
SELECT p_partkey, p_retailprice, (SELECT centre FROM c WHERE abs(p_retailprice - centre) <= 30 ORDER BY abs(p_retailprice - centre), centre LIMIT 1)::DOUBLE AS centre FROM part""")
def nearest_bin_join(spark, sf_dir):
    centres = spark.createDataFrame([(float(c),) for c in (950, 1000, 1050, 1100, 1400, 1900)], "centre double")
    return relational.nearest(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), centres, "p_retailprice", "centre", 30.0)


@query("range_bin_join", """
WITH b(low, high, class) AS (VALUES (NULL, 0.0, 'debt'), (0.0, 1000.0, 'low'), (1000.0, 5000.0, 'middle'), (5000.0, NULL, 'high'))
SELECT c_custkey, c_acctbal, class FROM customer LEFT JOIN b ON (low IS NULL OR c_acctbal >= low) AND (high IS NULL OR c_acctbal < high)""")
def range_bin_join(spark, sf_dir):
    bins = spark.createDataFrame([(None, 0.0, "debt"), (0.0, 1000.0, "low"), (1000.0, 5000.0, "middle"), (5000.0, None, "high")], "low double, high double, class string")
    return relational.bin_join(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), bins, "c_acctbal")


RECONCILED = """
WITH a AS (SELECT s_suppkey AS k, s_acctbal AS v FROM supplier WHERE s_suppkey % 7 <> 0),
b AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 = 0 THEN s_acctbal + 100 ELSE s_acctbal END AS v FROM supplier WHERE s_suppkey % 11 <> 0),
j AS (SELECT coalesce(a.k, b.k) AS k, a.v AS value_a, b.v AS value_b, CASE WHEN b.k IS NULL THEN 'only_a' WHEN a.k IS NULL THEN 'only_b'
  WHEN abs(a.v - b.v) < greatest(0.5, 0.001 * abs(a.v)) THEN 'agree' ELSE 'differ' END AS state FROM a FULL JOIN b ON a.k = b.k)
"""


def reconciled(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"))
    other = supplier.where("k % 11 <> 0").withColumn("v", F.when(F.col("k") % 5 == 0, F.col("v") + 100).otherwise(F.col("v")))
    return relational.reconcile(supplier.where("k % 7 <> 0"), other, ["k"], "v", 0.5, 0.001)


@query("full_outer_reconcile", RECONCILED + "SELECT * FROM j")
def full_outer_reconcile(spark, sf_dir):
    return reconciled(spark, sf_dir)


@query("dual_agreement", RECONCILED + "SELECT count(*) FILTER (state IN ('agree', 'differ')) AS shared, round(count(*) FILTER (state = 'agree') / nullif(count(*) FILTER (state IN ('agree', 'differ')), 0), 6) AS dual_ok FROM j")
def dual_agreement(spark, sf_dir):
    return gates.agreement(reconciled(spark, sf_dir)).withColumn("dual_ok", F.round("dual_ok", 6))


@query("cascade_children", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name LIKE 'A%')")
def cascade_children(spark, sf_dir):
    regions = table(spark, sf_dir, "region").where("r_name LIKE 'A%'").select(F.col("r_regionkey").alias("n_regionkey"))
    return relational.cascade(regions, table(spark, sf_dir, "nation"), ["n_regionkey"]).select("n_nationkey", "n_name")


@query("union_allow_missing", "SELECT s_nationkey AS place, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_nationkey, c_acctbal, c_mktsegment FROM customer")
def union_allow_missing(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("place"), F.col("s_acctbal").alias("balance"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("place"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return relational.concat_rows(suppliers, customers)


@query("upsert_slice", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_orderstatus = 'P') UNION ALL SELECT o_orderkey, round(o_totalprice * 2, 2) FROM orders WHERE o_orderstatus = 'P'")
def upsert_slice(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    new = orders.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    return relational.replace_slice(orders, new, F.col("o_orderstatus") == "P").select("o_orderkey", "o_totalprice")


@query("upsert_keys", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT s_suppkey, 0.0 FROM supplier WHERE s_suppkey % 3 = 0")
def upsert_keys(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return relational.upsert(supplier, supplier.where("s_suppkey % 3 = 0").withColumn("s_acctbal", F.lit(0.0)), ["s_suppkey"])


@query("except_keys", "SELECT c_nationkey AS nation FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000")
def except_keys(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).subtract(table(spark, sf_dir, "supplier").where("s_acctbal > 9000").select("s_nationkey"))


@query("intersect_keys", "SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9900 INTERSECT SELECT s_nationkey FROM supplier")
def intersect_keys(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("nation")).intersect(table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("distinct_types", "SELECT DISTINCT p_type, p_brand FROM part")
def distinct_types(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_type", "p_brand").distinct()


@query("alias_keys", "SELECT DISTINCT lower(n_name) AS alias, n_nationkey FROM nation UNION SELECT 'n' || n_nationkey, n_nationkey FROM nation")
def alias_keys(spark, sf_dir):
    records = table(spark, sf_dir, "nation").select("n_nationkey", F.array(F.lower("n_name"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))).alias("aliases"))
    return relational.alias_keys(records, "n_nationkey", "aliases").select("alias", "n_nationkey")


@query("norm_names", "SELECT p_partkey, trim(translate(replace(replace(lower(regexp_replace(p_name, '\\s+', ' ', 'g')), '''', ''), '.', ''), '-', ' ')) AS name FROM part")
def norm_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.norm(F.col("p_name")).alias("name"))


@query("template_fill", "SELECT n_nationkey, 'Nation ' || n_name || ' of ' || r_name || '.' AS text FROM nation JOIN region ON n_regionkey = r_regionkey")
def template_fill(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("n_nationkey", C.fill_template(F.lit("Nation :::nation::: of ::: region :::."), {"nation": F.col("n_name"), "region": F.col("r_name")}).alias("text"))


@query("num_tokens_extract", r"SELECT doc_id, len(regexp_extract_all(text, '(-?\d[\d,]*(?:\.\d+)?)')) AS n_numbers FROM documents")
def num_tokens_extract(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(C.numbers_in(F.col("text"))).cast("long").alias("n_numbers"))


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("html_links", "SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)) AS href FROM pages")
def html_links(spark, sf_dir):
    found = F.regexp_extract_all("html", F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.explode(found).alias("href"))


@query("html_text", "SELECT page_id, length(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))) > 0 AS has_text FROM pages")
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", (F.length(C.strip_tags(F.col("html"))) > 0).alias("has_text"))


@query("composite_keys", "SELECT c_custkey, c_mktsegment || '||' || coalesce(CAST(nullif(c_nationkey, 3) AS VARCHAR), '') AS key FROM customer")
def composite_keys(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", C.composite_key(F.col("c_mktsegment"), F.nullif("c_nationkey", F.lit(3))).alias("key"))


@query("two_way_classes", "SELECT a || ' × ' || b AS class, count(*) AS n FROM (SELECT CASE WHEN p_size < 15 THEN 'Low' WHEN p_size < 35 THEN 'Medium' ELSE 'High' END AS a, CASE WHEN p_retailprice < 1000 THEN 'Low' WHEN p_retailprice < 1400 THEN 'Medium' ELSE 'High' END AS b FROM part) GROUP BY 1")
def two_way_classes(spark, sf_dir):
    names = ["Low", "Medium", "High"]
    a, b = C.class_between(F.col("p_size"), [15, 35], names), C.class_between(F.col("p_retailprice"), [1000, 1400], names)
    return table(spark, sf_dir, "part").groupBy(C.two_way_class(a, b).alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("period_from_text", """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(month(o_orderdate) AS BIGINT) END AS month,
CASE o_orderkey % 3 WHEN 0 THEN 'year-only' WHEN 1 THEN 'month-year' ELSE 'year-month' END AS basis FROM orders""")
def period_from_text(spark, sf_dir):
    month = F.element_at(F.array(*map(F.lit, C.MONTHS)), F.month("o_orderdate"))
    year = F.year("o_orderdate").cast("string")
    title = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Bulletin "), year)).when(F.col("o_orderkey") % 3 == 1, F.concat(C.first_upper(month), F.lit(" 12, "), year)).otherwise(F.concat(year, F.lit(" "), month, F.lit(" issue")))
    y, m, basis = C.period_of(F.col("title"))
    return table(spark, sf_dir, "orders").select("o_orderkey", title.alias("title")).select("o_orderkey", y.cast("long").alias("year"), m.cast("long").alias("month"), basis.alias("basis"))
