"""Queries that write a table with a sink or another format and read it back, and those of the remaining column functions."""

from __future__ import annotations

import io
import os
import sqlite3
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from agrolith.functions import columns as C
from agrolith.functions.rowwise import RowFunction
from agrolith.functions.types import coerce, infer
from agrolith.operators.spec import Filter, TableSpec, evaluate
from agrolith.sources import catalog, containers, files, harvest, html, sinks
from agrolith.streaming import events as E

from .registry import query, table

NATION = "SELECT n_nationkey, n_name, n_regionkey FROM nation"


def nation(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("long").alias("n_regionkey"))


def again(df):
    return df.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("long").alias("n_regionkey"))


def put(spark, name: str, data: bytes) -> str:
    """A file in the shared folder, written through the file system that Spark knows it by."""
    path = f"{E.shared(spark, 'file')}/{name}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(data))
    out.close()
    return path


def written(spark, df, kind: str, **options) -> str:
    path = f"{E.shared(spark, 'table')}.{kind}"
    df.coalesce(1).write.options(**options).format({"tsv": "csv", "ndjson": "json"}.get(kind, kind)).save(path)
    return path


# sources


@query("source_csv", NATION)
def source_csv(spark, sf_dir):
    return again(catalog.load(spark, written(spark, nation(spark, sf_dir), "csv", header=True)))


@query("source_csv_untyped", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation")
def source_csv_untyped(spark, sf_dir):
    return catalog.load(spark, written(spark, nation(spark, sf_dir), "csv", header=True), typed=False).select("n_nationkey", "n_name")


@query("source_csv_semicolons", NATION)
def source_csv_semicolons(spark, sf_dir):
    return again(files.read_csv(spark, written(spark, nation(spark, sf_dir), "csv", header=True, sep=";"), sep=";", schema="n_nationkey bigint, n_name string, n_regionkey bigint"))


@query("source_tsv", NATION)
def source_tsv(spark, sf_dir):
    return again(catalog.load(spark, written(spark, nation(spark, sf_dir), "tsv", header=True, sep="\t")))


@query("source_ndjson", NATION)
def source_ndjson(spark, sf_dir):
    return again(catalog.load(spark, written(spark, nation(spark, sf_dir), "ndjson")))


@query("source_json", NATION)
def source_json(spark, sf_dir):
    rows = nation(spark, sf_dir).agg(F.to_json(F.array_sort(F.collect_list(F.struct("*")))).alias("j"))  # one row a nation
    return again(catalog.load(spark, put(spark, "nation.json", rows.first()[0].encode())))


@query("source_orc", NATION)
def source_orc(spark, sf_dir):
    return again(catalog.load(spark, written(spark, nation(spark, sf_dir), "orc")))


@query("source_xml", NATION)
def source_xml(spark, sf_dir):
    return again(catalog.load(spark, written(spark, nation(spark, sf_dir), "xml", rowTag="row")))


@query("source_text", "SELECT n_name AS value FROM nation")
def source_text(spark, sf_dir):
    return catalog.load(spark, put(spark, "names.txt", "\n".join(r[0] for r in nation(spark, sf_dir).select("n_name").collect()).encode()))  # one row a nation


@query("source_chunks", "SELECT count(*) AS chunks, 1000 AS bytes, 97 AS last FROM range(8)")
def source_chunks(spark, sf_dir):
    parts = catalog.chunks(spark, put(spark, "bytes.bin", bytes(range(250)) * 4), 129).withColumn("n", F.octet_length("chunk"))
    return parts.agg(F.count(F.lit(1)).alias("chunks"), F.sum("n").alias("bytes"), F.max_by("n", "place").cast("long").alias("last"))


#: A picture of one red point.
PIXEL = bytes.fromhex("89504e470d0a1a0a0000000d4948445200000001000000010802000000907753de0000000c49444154789c63f8cfc0000003010100c9fe92ef0000000049454e44ae426082")


@query("source_image", "SELECT 1 AS height, 1 AS width, 3 AS channels")
def source_image(spark, sf_dir):
    return catalog.load(spark, put(spark, "pixel.png", PIXEL)).select("height", "width", "channels")


@query("source_arrow", NATION)
def source_arrow(spark, sf_dir):
    found = nation(spark, sf_dir).toArrow()  # one row a nation
    out = io.BytesIO()
    with pa.ipc.new_file(out, found.schema) as writer:
        writer.write_table(found)
    return again(catalog.load(spark, put(spark, "nation.arrow", out.getvalue())))


@query("source_arrow_stream", NATION)
def source_arrow_stream(spark, sf_dir):
    found = nation(spark, sf_dir).toArrow()  # one row a nation
    out = io.BytesIO()
    with pa.ipc.new_stream(out, found.schema) as writer:
        writer.write_table(found, max_chunksize=7)
    return again(catalog.load(spark, put(spark, "nation.feather", out.getvalue())))


@query("source_sqlite", NATION)
def source_sqlite(spark, sf_dir):
    path = f"{E.shared(spark, 'sqlite').removeprefix('file:').replace('//', '/')}.sqlite"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE nation (n_nationkey INTEGER, n_name TEXT, n_regionkey INTEGER)")
        db.executemany("INSERT INTO nation VALUES (?, ?, ?)", [tuple(r) for r in nation(spark, sf_dir).collect()])  # one row a nation
    db.close()
    return again(catalog.load(spark, path, table="nation"))


@query("source_zip", NATION)
def source_zip(spark, sf_dir):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("nation.csv", sinks.csv_text(nation(spark, sf_dir), bom=False))
    lines = containers.zip_members(spark, put(spark, "nation.zip", out.getvalue())).select(F.explode(F.split(F.decode("content", "UTF-8"), "\r\n")).alias("l")).where("l <> '' AND l NOT LIKE 'n_nationkey%'")
    parts = F.split("l", ",")
    return lines.select(parts[0].cast("long").alias("n_nationkey"), parts[1].alias("n_name"), parts[2].cast("long").alias("n_regionkey"))


@query("source_xlsx", NATION)
def source_xlsx(spark, sf_dir):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = lambda ref, v: f'<c r="{ref}"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
    table_rows = [("n_nationkey", "n_name", "n_regionkey"), *map(tuple, nation(spark, sf_dir).collect())]  # one row a nation
    body = "".join(f'<row r="{at}">' + "".join(cell(f"{c}{at}", v) for c, v in zip("ABC", row, strict=True)) + "</row>" for at, row in enumerate(table_rows, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="Nations" sheetId="1"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    return again(catalog.load(spark, put(spark, "nation.xlsx", out.getvalue()), sheet="Nations", range="A1:C"))


@query("source_encrypted", NATION)
def source_encrypted(spark, sf_dir):
    sealed = containers.seal(spark, nation(spark, sf_dir).toArrow(), password="only a test")  # noqa: S106  one row a nation
    return again(containers.read_encrypted(spark, put(spark, "nation.kep", sealed), password="only a test"))  # noqa: S106


@query("source_views", "SELECT n_nationkey FROM nation WHERE n_regionkey = 1 AND n_nationkey > 5")
def source_views(spark, sf_dir):
    catalog.register_views(spark, [{"key": "agrolith_view", "path": f"{sf_dir}/nation.parquet", "select": ["n_nationkey"], "where": ["n_regionkey = 1", "n_nationkey > 5"]}, {"key": " ", "path": "nowhere"}])
    found = spark.table("agrolith_view")
    spark.catalog.dropTempView("agrolith_view")
    return found


@query("source_catalog", "SELECT r_name, count(*) AS n FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY 1")
def source_catalog(spark, sf_dir):
    regions = [r.asDict() for r in table(spark, sf_dir, "region").collect()]  # five rows
    c = catalog.Catalog(spark, {"agrolith_regions": regions, "agrolith_nations": {"file": f"{sf_dir}/nation.parquet"}})
    return spark.sql("SELECT r_name, count(*) AS n FROM {r} JOIN {n} ON r_regionkey = n_regionkey GROUP BY 1", r=c.frame("agrolith_regions"), n=c.frame("agrolith_nations"))


@query("source_season_index", "SELECT s AS season, CAST(y AS BIGINT) AS year, round(y / 1000.0 + k, 3) AS value FROM (VALUES ('DJF', 0), ('MAM', 1), ('OND', 2)) t(s, k) CROSS JOIN range(1990, 1995) r(y) WHERE y <> 1993")
def source_season_index(spark, sf_dir):
    seasons = {"DJF": 0, "MAM": 1, "OND": 2}
    lines = ["SEAS YR ANOM", *(f"{s} {y} {-99.9 if y == 1993 else y / 1000 + k:.3f}" for s, k in seasons.items() for y in range(1990, 1995)), "XXX 1990 1.0"]
    return files.season_index(spark, put(spark, "seasons.txt", "\n".join(lines).encode())).withColumn("year", F.col("year").cast("long"))


@query("source_fixed_width", "SELECT CAST(y AS BIGINT) AS year, CAST(m AS BIGINT) AS month, round(m / 10.0, 1) AS value FROM range(1951, 1954) a(y) CROSS JOIN range(1, 13) b(m)")
def source_fixed_width(spark, sf_dir):
    values = "".join(f"{m / 10:6.1f}" for m in range(1, 13))
    lines = ["ORIGINAL", f"1950{values}", "STANDARDIZED DATA", "YEAR JAN", *(f"{y}{values}" for y in range(1951, 1954)), f"1954{'-999.9' * 12}"]
    return files.fixed_width_months(spark, put(spark, "fixed.txt", "\n".join(lines).encode())).select(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), "value")


@query("source_year_matrix", "SELECT CAST(y AS BIGINT) AS year, CAST(m AS BIGINT) AS month, CAST(y + m AS DOUBLE) AS value FROM range(1950, 1953) a(y) CROSS JOIN range(1, 13) b(m)")
def source_year_matrix(spark, sf_dir):
    lines = ["1950 1952", *(f"{y} " + " ".join(str(y + m) for m in range(1, 13)) for y in (*range(1950, 1953), 1999)), "some prose"]
    return files.year_matrix(spark, put(spark, "matrix.txt", "\n".join(lines).encode())).select(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), "value")


@query("source_html_tables", "SELECT n_nationkey AS id, 'S' || n_nationkey AS season, CAST(n_regionkey AS VARCHAR) AS dry, n_name AS wet FROM nation")
def source_html_tables(spark, sf_dir):
    """The table is found by its header, whatever the order of its columns; a repeated first column counts once."""
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    row = F.concat(F.lit("<tr><th>S"), F.col("n_nationkey").cast("string"), F.lit("</th>"), cell(F.col("n_name")), cell(F.col("n_regionkey").cast("string")), F.lit("</tr>"))
    page = F.concat(F.lit("<table><tr><td>x</td></tr></table><table><tr><th>Season</th><th>Wet years</th><th>Dry years</th></tr>"), row, row, F.lit("</table>"))
    pages = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), page.alias("html"))
    return html.exploded(pages, "id", "html", lambda text: html.table_rows(text, ["season", "dry", "wet"]), ["season", "dry", "wet"])


@query("page_links", "SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"[^>]*>', 1)) AS href FROM pages")
def page_links(spark, sf_dir):
    found = html.exploded(table(spark, sf_dir, "pages"), "page_id", "html", html.link_rows, ["href", "title", "date"])
    return found.select("page_id", F.replace("href", F.lit("&"), F.lit("&amp;")).alias("href"))


@query("harvest_pages", "SELECT 1 + n_nationkey // 5 AS page, 1 + n_nationkey // 5 AS echo, n_name AS name FROM nation")
def harvest_pages(spark, sf_dir):
    """A paged grid whose second page fails at first and whose session ends once; each page is fetched as needed."""
    names = [r[0] for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").select("n_name").collect()]  # one row a nation
    state = {"asked": 0}

    def fetch(page: int, session: int) -> str:
        state["asked"] += 1
        if state["asked"] == 2:
            raise ConnectionError("no answer")
        if state["asked"] == 4:
            return "please log in"
        return f"<b>{page}</b>" + "".join(f"<i>{n}</i>" for n in names[5 * (page - 1) : 5 * page])

    between = lambda text, mark: [p.split(f"</{mark}>")[0] for p in text.split(f"<{mark}>")[1:]]
    import tempfile

    with tempfile.TemporaryDirectory() as folder:
        client = harvest.Harvester(fetch, folder, login=lambda: state["asked"], expired=lambda t: "log in" in t, echo=lambda t: int(between(t, "b")[0]), sleep=lambda _: None)
        return harvest.harvested(spark, client, -(-len(names) // 5), lambda t: [(n,) for n in between(t, "i")], ["name"])


# sinks


@query("sink_csv_parts", "SELECT 'n_nationkey,n_name,n_regionkey' AS line, count(*) > 0 AS each FROM nation UNION ALL SELECT n_nationkey || ',' || n_name || ',' || n_regionkey, true FROM nation")
def sink_csv_parts(spark, sf_dir):
    """Every part file begins with the header."""
    path = E.shared(spark, "csv")
    sinks.write_csv(nation(spark, sf_dir).repartition(3), path)
    parts = spark.read.text(path, wholetext=True).select(F.split("value", "\r\n").alias("l")).select(F.filter("l", lambda x: x != "").alias("l"))
    headed = F.get("l", F.lit(0)) == "n_nationkey,n_name,n_regionkey"
    heads = parts.groupBy().agg(F.bool_and(headed).alias("each")).select(F.lit("n_nationkey,n_name,n_regionkey").alias("line"), "each")
    return heads.unionByName(parts.select(F.explode(F.slice("l", F.lit(2), F.size("l"))).alias("line"), F.lit(True).alias("each")))


@query("sink_json", NATION)
def sink_json(spark, sf_dir):
    path = f"{E.shared(spark, 'json')}.ndjson"
    sinks.write_json(nation(spark, sf_dir), path, ["n_regionkey", "n_nationkey"])
    return again(catalog.load(spark, path))


@query("sink_report", NATION)
def sink_report(spark, sf_dir):
    path = E.shared(spark, "report")
    sinks.write_report(nation(spark, sf_dir), path)
    return again(spark.read.option("header", True).csv(path))


@query("sink_parquet", "SELECT CAST(n_regionkey AS SMALLINT) AS n_regionkey, n_name FROM nation")
def sink_parquet(spark, sf_dir):
    path = E.shared(spark, "parquet")
    sinks.write_parquet(nation(spark, sf_dir), path, {"n_regionkey": "smallint", "n_name": "string"})
    return spark.read.parquet(path)


# specification


@query("spec_types", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 1.5 WHEN 1 THEN o_orderkey END AS number, CASE o_orderkey % 4 WHEN 2 THEN TIMESTAMP '2021-03-05 00:00:00' END AS date, CASE o_orderkey % 4 WHEN 3 THEN true WHEN 0 THEN true WHEN 1 THEN o_orderkey <> 0 END AS flag FROM orders")
def spec_types(spark, sf_dir):
    key = F.col("o_orderkey")
    text = F.when(key % 4 == 0, " 1.5 ").when(key % 4 == 1, key.cast("string")).when(key % 4 == 2, "2021-03-05").otherwise("TRUE")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    return rows.select("o_orderkey", coerce(F.col("t"), "number").alias("number"), F.when(key % 4 == 2, coerce(F.col("t"), "date")).cast("timestamp_ntz").alias("date"), coerce(F.col("t"), "boolean").alias("flag"))


@query("spec_inferred", "SELECT * FROM (VALUES ('a', 'integer'), ('b', 'number'), ('c', 'date'), ('d', 'string'), ('e', 'boolean')) t(name, type)")
def spec_inferred(spark, sf_dir):
    key = F.col("n_nationkey")
    rows = table(spark, sf_dir, "nation").select(key.cast("string").alias("a"), (key + F.lit(0.5)).cast("string").alias("b"), F.concat(F.lit("3/"), (key + 1).cast("string"), F.lit("/2020")).alias("c"), F.col("n_name").alias("d"), (key > 3).cast("string").alias("e"))
    return spark.createDataFrame(list(infer(rows).items()), "name string, type string")


@query("spec_js_nulls", "SELECT doc_id, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(toxic, 0) < 1 AND lang < 'f' AND (toxic <> 1 OR toxic IS NULL)")
def spec_js_nulls(spark, sf_dir):
    """The in-memory dialect: a null number counts as 0, a null text compares with nothing."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "lang", "toxic")
    return evaluate(rows, TableSpec(filter=[Filter("lt", "toxic", [1]), Filter("lt", "lang", ["f"]), Filter("ne", "toxic", [1])], select=["doc_id", "toxic"], nulls="js"))


@query("spec_valid_by_type", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0")
def spec_valid_by_type(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 3 == 0, "12").when(F.col("o_orderkey") % 3 == 1, "12 kg").otherwise("NaN")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    return evaluate(rows, TableSpec(types={"t": "number"}, filter=[Filter("v", "t")], select=["o_orderkey"]))


@query("spec_column_operands", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_tax > l_discount AND l_quantity <> l_linenumber")
def spec_column_operands(spark, sf_dir):
    entries = [Filter("gt", "l_tax", [F.col("l_discount")]), Filter("ne", "l_quantity", [F.col("l_linenumber")])]
    return evaluate(table(spark, sf_dir, "lineitem"), TableSpec(filter=entries, select=["l_orderkey", "l_linenumber"]))


@query("spec_row_functions", "SELECT n_nationkey, CASE WHEN n_nationkey % 5 <> 0 THEN n_regionkey * 1.0 / (n_nationkey % 5) END AS ratio, n_nationkey % 5 = 0 AS failed, upper(n_name) || '!' AS loud FROM nation")
def spec_row_functions(spark, sf_dir):
    """Python row functions: errors by row and column, types inferred, and no output seen by another."""
    spec = TableSpec(derive={"ratio": RowFunction(lambda row: row["n_regionkey"] / (row["n_nationkey"] % 5), "double"), "loud": RowFunction(lambda row: row["n_name"].upper() + "!")}, errors="errors")
    out = evaluate(table(spark, sf_dir, "nation"), spec)
    return out.select("n_nationkey", "ratio", F.contains(F.coalesce(F.col("errors")["ratio"], F.lit("")), F.lit("ZeroDivisionError")).alias("failed"), "loud")


@query("spec_dropped", "SELECT n_nationkey, n_regionkey FROM nation")
def spec_dropped(spark, sf_dir):
    return evaluate(nation(spark, sf_dir), TableSpec(select=[c for c in nation(spark, sf_dir).columns if c != "n_name"]))


@query("group_function", "WITH g AS (SELECT s_nationkey, s_acctbal - lag(s_acctbal) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS gap FROM supplier) SELECT s_nationkey, round(max(gap), 4) AS widest FROM g GROUP BY 1")
def group_function(spark, sf_dir):
    """A whole-group algorithm over Arrow tables: the widest gap of a nation's sorted balances."""
    import pyarrow.compute as pc

    def widest(group: pa.Table) -> pa.Table:
        values = group.column("s_acctbal").sort()
        gaps = pc.subtract(values[1:], values[:-1]) if len(values) > 1 else pa.array([], pa.float64())
        return pa.table({"s_nationkey": group.column("s_nationkey")[:1], "widest": pa.array([pc.max(gaps).as_py()], pa.float64())})

    rows = table(spark, sf_dir, "supplier").select("s_nationkey", "s_acctbal")
    return rows.groupBy("s_nationkey").applyInArrow(widest, "s_nationkey int, widest double").withColumn("widest", F.round("widest", 4))


# streams


@query("stream_filter_map", "SELECT event_id, value * 2 AS twice FROM events WHERE event_type = 'signup'")
def stream_filter_map(spark, sf_dir):
    return E.run_available(spark, f"{sf_dir}/events.parquet", lambda rows: E.mapped_stream(E.filtered_stream(rows, F.col("event_type") == "signup"), event_id=F.col("event_id"), twice=F.col("value") * 2), "append")


@query("generated_range", "SELECT value, value * value AS square FROM range(3, 50, 4) r(value)")
def generated_range(spark, sf_dir):
    return E.mapped_stream(E.generated(spark, 3, 50, 4), value=F.col("value"), square=F.col("value") * F.col("value"))


@query("refresh_on_change", "SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN s_acctbal + 1 ELSE s_acctbal END AS v, false AS changed FROM supplier WHERE s_suppkey % 7 <> 0 OR s_suppkey % 10 <> 9 UNION ALL SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN s_acctbal + 1 ELSE s_acctbal END, true FROM supplier WHERE s_suppkey % 5 = 0 OR (s_suppkey % 7 = 0 AND s_suppkey % 10 = 9)")
def refresh_on_change(spark, sf_dir):
    """Revised and new rows replace a snapshot's; a second refresh from the same source changes nothing."""
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    source = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(key % 5 == 0, balance + 1).otherwise(balance).alias("v"))
    held = table(spark, sf_dir, "supplier").select("s_suppkey", balance.alias("v")).where("s_suppkey % 7 <> 0 OR s_suppkey % 10 <> 9")
    fresh = source.where("s_suppkey % 5 = 0 OR (s_suppkey % 7 = 0 AND s_suppkey % 10 = 9)")
    after, changed = E.refreshed(held, fresh, ["s_suppkey"])
    _, none = E.refreshed(after, fresh, ["s_suppkey"])
    snapshot = after.where("s_suppkey % 7 <> 0 OR s_suppkey % 10 <> 9")
    return snapshot.withColumn("changed", F.lit(False)).unionByName(changed.drop("state").withColumn("changed", F.lit(True))).unionByName(none.drop("state").withColumn("changed", F.lit(True)))


@query("batches_of_arrow", "SELECT sum(o_orderkey) AS total, count(*) AS n FROM orders")
def batches_of_arrow(spark, sf_dir):
    """A result read batch by batch; only a running sum is kept."""
    total = n = 0
    for batch in E.batches(table(spark, sf_dir, "orders").select("o_orderkey")):
        total += sum(batch.column(0).to_pylist())
        n += batch.num_rows
    return spark.createDataFrame([(total, n)], "total bigint, n bigint")


@query("growing_rows", "SELECT count(*) AS n, true AS done FROM nation")
def growing_rows(spark, sf_dir):
    *_, last = E.growing(table(spark, sf_dir, "nation"))
    return spark.createDataFrame([(len(last.rows), last.done and last.error is None)], "n bigint, done boolean")


# column functions


@query("alias_values", "SELECT n_nationkey, CASE n_name WHEN 'NATION_1' THEN 'One' WHEN 'NATION_2' THEN 'Two' ELSE n_name END AS name, substr(n_name, 1, 5) AS code, CASE WHEN regexp_extract(n_name, '[^_]*$') IN ('3', '4', '11') THEN regexp_extract(n_name, '[^_]*$') END AS tail FROM nation")
def alias_values(spark, sf_dir):
    name = F.col("n_name")
    return table(spark, sf_dir, "nation").select("n_nationkey", C.alias(name, {"NATION_1": "One", "NATION_2": "Two"}).alias("name"), C.prefix_code(name, 5).alias("code"), C.tail_in(name, "_", ["3", "4", "11"]).alias("tail"))


@query("fallback_texts", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'Name' END AS title, CASE WHEN n_nationkey % 3 = 0 THEN 'kurz' ELSE 'short' END AS inner, 'only' AS only, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'Name' END AS local FROM nation")
def fallback_texts(spark, sf_dir):
    key, name = F.col("n_nationkey"), F.col("n_name")
    own = F.struct(F.when(key % 2 == 0, name).alias("title"), F.struct(F.when(key % 3 == 0, "kurz").alias("inner")).alias("deep"))
    other = F.struct(F.lit("Name").alias("title"), F.struct(F.lit("short").alias("inner"), F.lit("only").alias("only")).alias("deep"))
    rows = table(spark, sf_dir, "nation").select("n_nationkey", own.alias("own"), other.alias("other"), F.map_filter(F.create_map(F.lit("de"), F.when(key % 2 == 0, name), F.lit("en"), F.lit("Name")), lambda _, v: v.isNotNull()).alias("texts"))
    merged = C.with_fallback(F.col("own"), F.col("other"), rows.schema["own"].dataType, rows.schema["other"].dataType)
    return rows.select("n_nationkey", merged.alias("m"), C.localised(F.col("texts"), "de").alias("local")).select("n_nationkey", "m.title", "m.deep.inner", "m.deep.only", "local")


@query("html_plain_text", "SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))) AS text_md5 FROM pages")
def html_plain_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(C.strip_tags(F.col("html")).cast("binary")).alias("text_md5"))


@query("html_escaped", "SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')) AS text_md5 FROM pages")
def html_escaped(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(C.escape_html(F.col("html")).cast("binary")).alias("text_md5"))


@query("number_tokens", r"WITH n AS (SELECT doc_id, list_transform(regexp_extract_all(text, '-?[0-9][0-9,]*(?:\.[0-9]+)?'), lambda x: replace(x, ',', '')) AS t FROM documents) SELECT doc_id, md5(array_to_string(t, ' ')) AS tokens_md5, CAST(t[1] AS DOUBLE) AS first FROM n")
def number_tokens(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.concat_ws(" ", C.number_tokens(text)).cast("binary")).alias("tokens_md5"), F.get(C.numbers_in(text), F.lit(0)).alias("first"))


@query("leading_names", "SELECT p_partkey, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_size || '|-|7' END AS rest FROM part")
def leading_names(spark, sf_dir):
    text = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit("  "), F.col("p_size").cast("string"), F.lit(" - 7")))
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("t")).select("p_partkey", C.leading_name(F.col("t")).alias("name"), F.concat_ws("|", C.numeric_rest(F.col("t"))).alias("rest"))


@query("identifier_forms", "SELECT c_custkey, c_custkey % 3 = 0 AS uuid, c_custkey % 3 = 1 AS iso, c_custkey % 3 = 2 AS header FROM customer")
def identifier_forms(spark, sf_dir):
    key = F.col("c_custkey")
    text = F.when(key % 3 == 0, F.concat(F.lit("0a1B2c3D-0000-1111-2222-"), F.lpad(key.cast("string"), 12, "0"))).when(key % 3 == 1, F.concat(F.lit("2020-01-"), F.lpad((key % 28 + 1).cast("string"), 2, "0"))).otherwise(F.concat(F.lit("AB"), (key % 100).cast("string"), F.lit(".2")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", text.alias("t"))
    return rows.select("c_custkey", *(C.matches_form(F.col("t"), form).alias(name) for name, form in (("uuid", C.UUID), ("iso", C.ISO_DATE), ("header", C.HEADER))))


@query("paragraph_texts", "WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS p FROM documents) SELECT doc_id, len(p) AS n, md5(array_to_string(p, chr(10))) AS text_md5 FROM p")
def paragraph_texts(spark, sf_dir):
    found = C.paragraphs(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(found).cast("long").alias("n"), F.md5(F.array_join(found, "\n").cast("binary")).alias("text_md5"))


@query("first_matches", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderkey AS VARCHAR) END AS number FROM orders")
def first_matches(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("No. "), key)).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("no 7, ref:"), key)).otherwise(F.lit("none"))
    return table(spark, sf_dir, "orders").select("o_orderkey", C.first_match(text, [r"No\. (\d+)", r"ref:(\d+)"]).alias("number"))


@query("citations", "SELECT n_nationkey, n_name || '.' || CASE WHEN n_nationkey % 2 = 0 THEN ' ' || n_regionkey || '.' ELSE '' END || ' Report.' AS cited FROM nation")
def citations(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", C.citation(F.concat("n_name", F.lit(" ")), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey").cast("string")), F.lit("Report..")).alias("cited"))


@query("folded_search", "SELECT doc_id FROM documents WHERE contains(strip_accents(lower(text)), 'fur')")
def folded_search(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(C.folded_contains(F.col("text"), "für")).select("doc_id")


@query("wrapped_words", "SELECT n_nationkey, n_name || ' aa' || chr(10) || 'bbbbbbbbbbbbbbbb' || chr(10) || 'c' AS text FROM nation")
def wrapped_words(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", C.wrap_words(F.concat("n_name", F.lit(" aa bbbbbbbbbbbbbbbb c")), 14).alias("text"))


@query("period_after_upload", "SELECT o_orderkey, year(o_orderdate) * 12 + month(o_orderdate) > 1997 * 12 + 6 AS after FROM orders")
def period_after_upload(spark, sf_dir):
    date = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", C.is_after(F.year(date), F.month(date), F.lit(1997), F.lit(6)).alias("after"))


@query("crop_years", "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 2000 + s_suppkey % 90 WHEN 1 THEN 2000 + s_suppkey % 90 + 1 WHEN 2 THEN 2000 ELSE 2010 + s_suppkey % 5 END AS year FROM supplier")
def crop_years(spark, sf_dir):
    key = F.col("s_suppkey")
    first = F.lit(2000) + key % 90
    label = F.when(key % 4 == 0, first.cast("string")).when(key % 4 == 1, F.concat(first.cast("string"), F.lit("/"), F.lpad(((first + 1) % 100).cast("string"), 2, "0"))).when(key % 4 == 2, "1999/00").otherwise(F.concat(F.lit("2009/"), (F.lit(2010) + key % 5).cast("string")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", C.crop_year(label).cast("long").alias("year"))


@query("season_labels", "SELECT o_orderkey, CASE month(o_orderdate) WHEN 1 THEN 'DJF' WHEN 4 THEN 'MAM' WHEN 11 THEN 'OND' ELSE 'other' END AS season, CASE month(o_orderdate) WHEN 4 THEN 'DJF' WHEN 11 THEN 'JAS' END AS predictor FROM orders")
def season_labels(spark, sf_dir):
    season = C.season_of(F.month("o_orderdate"))
    named = F.when(season.isin("DJF", "MAM", "OND"), season).otherwise("other")
    return table(spark, sf_dir, "orders").select("o_orderkey", named.alias("season"), C.predictor_season(season).alias("predictor"))


@query("rounding_policy", "SELECT l_orderkey, l_linenumber, round(l_linenumber / 8.0, 2) AS sql, round_even(l_linenumber / 8.0, 2) AS even FROM lineitem")
def rounding_policy(spark, sf_dir):
    value = F.col("l_linenumber") / F.lit(8.0)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", C.rounded(value, 2).alias("sql"), C.rounded(value, 2, "even").alias("even"))


@query("tolerant_pairs", "SELECT l_orderkey, l_linenumber, abs(l_tax * 10 - l_discount * 10) < greatest(0.15, 0.4 * abs(l_tax * 10)) AS same FROM lineitem")
def tolerant_pairs(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", C.tolerant_equal(F.col("l_tax") * 10, F.col("l_discount") * 10, 0.15, 0.4).alias("same"))


@query("dominant_classes", "SELECT s_suppkey, CASE WHEN a + b + c = 0 THEN NULL WHEN a >= b AND a >= c THEN 'crop' WHEN b >= c THEN 'grass' ELSE 'tree' END AS class, round(100.0 * a / nullif(a + b + c, 0), 6) AS crop_pct FROM (SELECT s_suppkey, s_suppkey % 3 AS a, s_suppkey % 5 AS b, s_suppkey % 4 AS c FROM supplier)")
def dominant_classes(spark, sf_dir):
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", *((key % n).cast("double").alias(name) for n, name in ((3, "crop"), (5, "grass"), (4, "tree"))))
    shares = {name: F.col(name) for name in ("crop", "grass", "tree")}
    return rows.select("s_suppkey", C.dominant_class(shares).alias("class"), F.round(C.percent_of(F.col("crop"), F.col("crop") + F.col("grass") + F.col("tree")), 6).alias("crop_pct"))


@query("compact_numbers", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || 'K' WHEN 1 THEN p_size || 'M' WHEN 2 THEN p_size || 'B' ELSE CAST(p_size AS VARCHAR) END AS text, CASE p_partkey % 4 WHEN 0 THEN '-$' || p_size || 'K' WHEN 1 THEN '-$' || p_size || 'M' WHEN 2 THEN '-$' || p_size || 'B' ELSE '-$' || p_size END AS usd, p_size * 1000.0 AS digits FROM part")
def compact_numbers(spark, sf_dir):
    key, size = F.col("p_partkey"), F.col("p_size").cast("double")
    value = F.when(key % 4 == 0, size * 1e3).when(key % 4 == 1, size * 1e6).when(key % 4 == 2, size * 1e9).otherwise(size)
    return table(spark, sf_dir, "part").select("p_partkey", C.compact_number(value).alias("text"), C.usd(-value).alias("usd"), C.significant(size * 1000 + F.lit(0.4), 2).alias("digits"))


@query("minmax_scaled", "SELECT c_custkey, round((c_acctbal - lo) / nullif(hi - lo, 0), 8) AS scaled FROM customer JOIN (SELECT c_nationkey, min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer GROUP BY 1) USING (c_nationkey)")
def minmax_scaled(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    ends = rows.groupBy("c_nationkey").agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))
    return rows.join(ends, "c_nationkey").select("c_custkey", F.round(C.min_max(F.col("c_acctbal"), F.col("lo"), F.col("hi")), 8).alias("scaled"))


@query("priority_ranks", "SELECT p_partkey, a || ' × ' || b AS class, CASE a || ' × ' || b WHEN 'High × Low' THEN 1 WHEN 'Low × Low' THEN 2 END AS rank FROM (SELECT p_partkey, CASE WHEN p_size < 25 THEN 'Low' ELSE 'High' END AS a, CASE WHEN p_retailprice < 1200 THEN 'Low' ELSE 'High' END AS b FROM part)")
def priority_ranks(spark, sf_dir):
    key = C.two_way_class(C.class_between(F.col("p_size"), [25], ["Low", "High"]), C.class_between(F.col("p_retailprice"), [1200], ["Low", "High"]))
    return table(spark, sf_dir, "part").select("p_partkey", key.alias("class"), C.priority_of(key, {"High × Low": 1, "Low × Low": 2}).cast("long").alias("rank"))


@query("padded_cells", "SELECT s_suppkey, CAST(s_suppkey AS DOUBLE) AS first, CASE WHEN s_suppkey % 2 = 0 THEN 2.5 END AS second, 4 AS n, CASE WHEN s_suppkey % 2 = 0 THEN 2 ELSE 1 END AS filled FROM supplier")
def padded_cells(spark, sf_dir):
    cells = F.when(F.col("s_suppkey") % 2 == 0, F.array(F.col("s_suppkey").cast("double"), F.lit(2.5))).otherwise(F.array(F.col("s_suppkey").cast("double")))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", C.padded(cells, 4).alias("c"))
    return rows.select("s_suppkey", F.col("c")[0].alias("first"), F.col("c")[1].alias("second"), F.size("c").cast("long").alias("n"), C.filled(F.col("c")).cast("long").alias("filled"))


@query("column_sums", "SELECT s_nationkey, round(sum(s_acctbal), 4) AS a, CAST(sum(CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS b FROM supplier GROUP BY 1")
def column_sums(spark, sf_dir):
    row = F.array(F.col("s_acctbal"), F.when(F.col("s_suppkey") % 2 == 0, 1.0))
    sums = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(C.column_sums(F.collect_list(row), 2).alias("s"))
    return sums.select("s_nationkey", F.round(F.col("s")[0], 4).alias("a"), F.col("s")[1].alias("b"))


@query("length_prefixed", "SELECT n_nationkey, length(n_name) || '|' || n_name || '1|x' AS param FROM nation")
def length_prefixed(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", C.length_prefixed(F.array("n_name", F.lit("x"))).alias("param"))
