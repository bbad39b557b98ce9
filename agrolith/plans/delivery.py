"""What readers and sinks hand on, checked whole: order, titles and dates, downloads, sidecars, single rows and batches."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from agrolith.operators import relational
from agrolith.plans.registry import query, table
from agrolith.sources import catalog, html, sinks
from agrolith.streaming import events
from agrolith.tables import stored

#: A link whose title has tags, entities and blanks, and a date as far behind it as the page's number says.
LINK = """'<a class="x" href="/p?id=' || page_id || '&amp;k=1"> The <b>' || page_id || '</b>  &lt;th&gt;\n page </a>' || repeat('.', page_id * 37 % 1300) || ' ' || (1 + page_id % 12) || '/05/2024'"""


@query("link_details", f"""
WITH p AS (SELECT page_id, {LINK} || html AS html FROM pages)
SELECT page_id, '/p?id=' || page_id || '&k=1' AS href, 'The ' || page_id || ' <th> page' AS title, CASE WHEN page_id * 37 % 1300 + 1 + length((1 + page_id % 12) || '/05/2024') <= 900 THEN (1 + page_id % 12) || '/05/2024' END AS date FROM p
UNION ALL SELECT page_id, replace(m[1], '&amp;', '&'), trim(regexp_replace(replace(regexp_replace(m[2], '<[^>]*>', ' ', 'g'), '&amp;', '&'), '\\s+', ' ', 'g')), NULL
FROM (SELECT page_id, unnest(list_transform(regexp_extract_all(html, '(?s)<a\\s[^>]*?href="[^"]*"[^>]*>.*?</a>'), lambda a: [regexp_extract(a, 'href="([^"]*)"', 1), regexp_extract(a, '(?s)^<a\\s[^>]*>(.*)</a>$', 1)])) AS m FROM pages)""")
def link_details(spark, sf_dir):
    """Links with title and date, of pages before whose own links one with a date stands."""
    number = F.col("page_id").cast("string")
    head = F.concat(F.lit('<a class="x" href="/p?id='), number, F.lit('&amp;k=1"> The <b>'), number, F.lit("</b>  &lt;th&gt;\n page </a>"))
    dated = F.concat(F.expr("repeat('.', CAST(page_id * 37 % 1300 AS INT))"), F.lit(" "), (1 + F.col("page_id") % 12).cast("string"), F.lit("/05/2024"))
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(head, dated, F.col("html")).alias("html"))
    return html.exploded(pages, "page_id", "html", html.link_rows, ["href", "title", "date"])


@query("json_order", "SELECT row_number() OVER (ORDER BY c_nationkey, c_name) AS place, c_nationkey, c_name FROM customer")
def json_order(spark, sf_dir):
    """Documents in the order of their lines, file by file."""
    path = f"{events.shared(spark, 'json')}.ndjson"
    sinks.write_json(table(spark, sf_dir, "customer").select("c_nationkey", "c_name"), path, ["c_nationkey", "c_name"])
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\n")).alias("line", "value"))
    placed = relational.placed(texts.where("value <> ''"), "place", "file", "line")
    return placed.select("place", F.from_json("value", "c_nationkey bigint, c_name string").alias("r")).select("place", "r.*")


@query("builder_rules", "SELECT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#12', 'Brand#23', 'Brand#34', 'Brand#41') AND p_size <> 7 AND trim(p_name) <> '' AND NOT starts_with(p_brand, 'Brand#1') AND regexp_full_match(CAST(1990 + p_size % 20 AS VARCHAR), '\\d{4}')")
def builder_rules(spark, sf_dir):
    rows = table(spark, sf_dir, "part").withColumn("year", (1990 + F.col("p_size") % 20).cast("string"))
    return relational.accepted(rows, among={"p_brand": ["Brand#11", "Brand#12", "Brand#23", "Brand#34", "Brand#41"]}, unlike={"p_size": 7}, filled=["p_name"], not_prefixed={"p_brand": "Brand#1"}, years=["year"]).select("p_partkey")


@query("csv_plain", "SELECT 's_suppkey,s_name,note' || chr(13) || chr(10) || string_agg(s_suppkey || ',' || s_name || ',' || CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN '\"a,\"\"b\"\"\"' ELSE '\"c' || chr(13) || chr(10) || 'd\"' END, chr(13) || chr(10) ORDER BY s_suppkey) AS text FROM supplier")
def csv_plain(spark, sf_dir):
    """A download without a mark and without a last end of line."""
    note = F.when(F.col("s_suppkey") % 3 == 1, 'a,"b"').when(F.col("s_suppkey") % 3 == 2, "c\nd")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", note.alias("note")).orderBy("s_suppkey")
    return spark.createDataFrame([(sinks.csv_text(rows, bom=False, last_newline=False),)], "text string")


@query("sidecar_columns", "SELECT 'Orders' AS title, (SELECT count(*) FROM orders) AS rows, unnest(['o_orderkey', 'o_orderpriority', 'o_totalprice']) AS name, unnest(['bigint', 'string', 'double']) AS type")
def sidecar_columns(spark, sf_dir):
    text = sinks.sidecar(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), title="Orders")
    told = json.loads(text)
    return spark.createDataFrame([(told["title"], told["rows"], c["name"], c["type"]) for c in told["columns"]], "title string, rows bigint, name string, type string")


@query("single_row", "SELECT * FROM (SELECT o_orderstatus, max(o_totalprice) AS most, count(*) AS n FROM orders GROUP BY 1) WHERE o_orderstatus = 'F' UNION ALL SELECT 'none', NULL, count(*) FROM orders WHERE o_totalprice < 0")
def single_row(spark, sf_dir):
    """The row of a query with a bound value, and that a query without rows has none."""
    sources = catalog.Catalog.of(spark, {"orders_of_row": table(spark, sf_dir, "orders")})
    text = "SELECT o_orderstatus, max(o_totalprice) AS most, count(*) AS n FROM orders_of_row WHERE o_orderstatus = ? GROUP BY 1"
    rows = [sources.row(text, "F"), sources.row(text, "no such status") or {"o_orderstatus": "none", "most": None, "n": 0}]
    return spark.createDataFrame([tuple(row.values()) for row in rows], "o_orderstatus string, most double, n bigint")


@query("latest_and_queue", """
SELECT 'latest' AS sink, event_id % 3 AS part, count(*) AS n, round(sum(value), 2) AS total FROM events WHERE event_id % 3 = 2 GROUP BY ALL
UNION ALL SELECT 'queue', event_id % 3, count(*), round(sum(value), 2) FROM events GROUP BY ALL""")
def latest_and_queue(spark, sf_dir):
    """Three batches of a stream: a sink that keeps the newest whole, and one that hands on each."""
    rows = table(spark, sf_dir, "events").select(F.pmod("event_id", F.lit(3)).alias("part"), "value")
    source, queued = events.shared(spark, "batches"), events.shared(spark, "queued")
    latest = events.Latest()
    queue = events.Queue(lambda batch, number: batch.write.mode("overwrite").parquet(f"{queued}/{number}"))
    states = [events.shared(spark, "state") for _ in range(2)]
    for part in range(3):
        rows.where(F.col("part") == part).write.mode("append").parquet(source)
        for sink, state in zip((latest, queue), states, strict=True):
            stream = spark.readStream.schema(rows.schema).parquet(source)
            stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
    totals = lambda frame, sink: frame.groupBy(F.lit(sink).alias("sink"), "part").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
    every = spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(queued)
    return stored(totals(latest.frame(spark), "latest").unionByName(totals(every, "queue")), "sinks")
