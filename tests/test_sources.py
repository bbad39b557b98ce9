import io
import sqlite3
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from agrolith.sources import catalog, containers, files, html, sinks


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_views(spark, tmp_path):
    spark.range(10).withColumn("x", F.col("id") * 2).write.parquet(str(tmp_path / "t"))
    names = catalog.register_views(spark, [{"key": "v1", "path": str(tmp_path / "t"), "select": ["x"], "where": ["id > 5", "id < 8"]}, {"key": " ", "path": "nowhere"}])
    assert names == ["v1"] and rows(spark.table("v1"), "x") == [(12,), (14,)]


def test_catalog(spark):
    c = catalog.Catalog.of(spark, {"a": [{"x": 1}, {"x": 2, "y": "z"}], "b": [1, 2, 3], "d": pa.table({"q": [5]}), "e": {"data": [7]}})
    assert c.row("SELECT count(*) AS n FROM b WHERE value > ?", 1) == {"n": 2}
    assert c.frame("a").columns == ["x", "y"] and c.row("SELECT q FROM d WHERE q < 0") is None
    c.replace("b", [9])
    assert c.row("SELECT value FROM b") == {"value": 9}
    assert ("x", "bigint", True) in c.columns("a")
    with pytest.raises(TypeError):
        catalog.load(spark, 3)


def test_text_shapes(spark, tmp_path):
    (tmp_path / "s.txt").write_text("SEAS YR ANOM\nDJF 1950 -1.5\nXXX 1950 1\nJFM 1950 -99.9\nFMA 1951 abc\nMAM 1951 0.25\n")
    assert rows(files.season_index(spark, str(tmp_path / "s.txt")), "year") == [("DJF", 1950, -1.5), ("MAM", 1951, 0.25)]
    values = "".join(f"{m / 10:6.1f}" for m in range(1, 13))
    (tmp_path / "f.txt").write_text(f"ORIGINAL\n1951{values}\nSTANDARDIZED DATA\nYEAR JAN\n1951{values}\n1952{'-999.9' * 12}\n")
    got = rows(files.fixed_width_months(spark, str(tmp_path / "f.txt")), "year", "month")
    assert len(got) == 12 and got[0] == (1951, 1, 0.1)
    (tmp_path / "m.txt").write_text("1950 1951\n1950 " + " ".join(str(m) for m in range(1, 13)) + "\n1951 " + "-9999 " * 12 + "\nsome prose here\n1999 " + "1 " * 12 + "\n")
    got = rows(files.year_matrix(spark, str(tmp_path / "m.txt")), "month")
    assert got == [(1950, m, float(m)) for m in range(1, 13)]


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x, ""y"""\n2,z\n')
    assert rows(files.read_csv(spark, str(tmp_path / "a.csv")), "a") == [(1, 'x, "y"'), (2, "z")]
    assert files.read_csv(spark, str(tmp_path / "a.csv"), typed=False).dtypes[0] == ("a", "string")
    assert files.read_csv(spark, str(tmp_path / "a.csv"), typed="auto").dtypes[0] == ("a", "double")


def test_encrypted_container(spark, tmp_path):
    key, table = "ab" * 32, pa.table({"x": [1, 2]})
    path = tmp_path / "t.kep"
    path.write_bytes(containers.seal(spark, table, key_hex=key))
    assert rows(containers.read_encrypted(spark, str(path), key_hex=key), "x") == [(1,), (2,)]
    with pytest.raises(Exception):
        containers.read_encrypted(spark, str(path), key_hex="cd" * 32)
    with pytest.raises(ValueError):
        containers.read_encrypted(spark, str(path), password="p")
    path.write_bytes(containers.seal(spark, table, password="p"))
    assert containers.read_encrypted(spark, str(path), password="p").count() == 2
    (tmp_path / "short.kep").write_bytes(b"KEP1")
    with pytest.raises(ValueError, match="short"):
        containers.read_encrypted(spark, str(tmp_path / "short.kep"), key_hex=key)
    with pytest.raises(ValueError, match="name"):
        containers.read_encrypted(spark, str(tmp_path / "x.bin"), key_hex=key)


def test_sqlite_arrow_zip(spark, tmp_path):
    with sqlite3.connect(tmp_path / "d.sqlite") as db:
        db.execute("CREATE TABLE t (a INTEGER, b TEXT, c REAL)")
        db.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, f"s{i}", i / 2) for i in range(10)])
    assert rows(containers.read_sqlite(spark, str(tmp_path / "d.sqlite"), "t"), "a")[3] == (3, "s3", 1.5)
    with pa.OSFile(str(tmp_path / "t.arrow"), "wb") as out, pa.ipc.new_file(out, pa.schema([("q", pa.int64())])) as writer:
        writer.write_table(pa.table({"q": [4]}))
    assert rows(containers.read_arrow(spark, str(tmp_path / "t.arrow"))) == [(4,)]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m.csv", "a\n1\n")
    assert [(r.name, bytes(r.content)) for r in containers.zip_members(spark, str(tmp_path / "z.zip")).collect()] == [("m.csv", b"a\n1\n")]


def workbook() -> bytes:
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="One" sheetId="1"/></sheets></workbook>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>name</t></si><si><r><t>Ta</t></r><r><t>na</t></r></si></sst>")
        cells = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>0</v></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2"><f>1+1</f><v>2</v></c></row><row r="3"><c r="A3" t="e"><v>#N/A</v></c><c r="B3"><v>3.5</v></c></row>'
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{cells}</sheetData></worksheet>")
    return out.getvalue()


def test_xlsx(spark, tmp_path):
    (tmp_path / "b.xlsx").write_bytes(workbook())
    df = containers.read_xlsx(spark, str(tmp_path / "b.xlsx"), "One")
    assert df.columns == ["#", "name", "name_"] and rows(df, "#") == [(2, "Tana", 2.0), (3, "NaN", 3.5)]
    assert containers.cell_range("B2:C") == (1, 1, 2, None)
    assert rows(containers.read_xlsx(spark, str(tmp_path / "b.xlsx"), 0, range="B2:B3", headers=False), "#") == [(2, 2.0), (3, 3.5)]


def test_html(spark):
    page = "<table><tr><th>Season</th><th>El Niño</th><th>La Niña</th></tr><tr><th>DJF</th><td>10</td><td>90</td></tr><tr><td>DJF</td><td>1</td><td>2</td></tr></table>"
    assert html.table_rows(page, ["season", "la ni", "el ni"]) == [("DJF", "90", "10")]
    links = '<a href="/x?a=1&amp;b=2"><b>May &amp; June</b></a> on 2021-05-03'
    pages = spark.createDataFrame([(1, links), (2, None)], "id bigint, html string")
    assert rows(html.exploded(pages, "id", "html", html.link_rows, ["href", "title", "date"])) == [(1, "/x?a=1&b=2", "May & June", "2021-05-03")]


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'q"q', None), ("x\ny", "p", 1)], "a string, b string, c int")
    assert sinks.csv_text(df) == '﻿a,b,c\r\n"a,b","q""q",\r\n"x\r\ny",p,1\r\n'
    assert sinks.csv_text(df.limit(0), bom=False) == ""
    assert sinks.csv_text(df, columns=["b"], bom=False, last_newline=False) == 'b\r\n"q""q"\r\np'
    sinks.write_parquet(df, str(tmp_path / "p"), {"c": "bigint", "a": "string"})
    assert spark.read.parquet(str(tmp_path / "p")).dtypes == [("c", "bigint"), ("a", "string")]
    assert '"rows": 2' in sinks.sidecar(df, title="t")


def test_csv_parts_have_headers(spark, tmp_path):
    sinks.write_csv(spark.range(6).repartition(3), str(tmp_path / "c"))
    parts = [f.read_bytes() for f in (tmp_path / "c").glob("part-*")]
    assert parts and all(p.startswith(b"id\r\n") for p in parts) and sum(p.count(b"\r\n") - 1 for p in parts) == 6
    sinks.write_csv(spark.range(0), str(tmp_path / "e"))
    assert b"".join(f.read_bytes() for f in (tmp_path / "e").glob("part-*")) == b"id\r\n"


def test_seals_differ(spark):
    table = pa.table({"x": [1]})
    one, two = (containers.seal(spark, table, password="p") for _ in range(2))
    assert one[5:21] != two[5:21] and one[21:33] != two[21:33]


def test_large_files_stay_off_the_driver(spark, tmp_path):
    (tmp_path / "big.bin").write_bytes(b"x" * 100)
    with pytest.raises(ValueError, match="100 bytes"):
        containers.content(spark, str(tmp_path / "big.bin"), most=50)


def test_harvest_tries_again_and_keeps_pages(spark, tmp_path):
    from agrolith.sources.harvest import Harvester

    asked, pauses, answers = [], [], iter(["<b>2</b>", "log in", "<b>1</b>"])

    def fetch(page, session):
        asked.append((page, session))
        return next(answers)

    client = Harvester(fetch, str(tmp_path), login=lambda: len(asked), expired=lambda t: t == "log in", echo=lambda t: int(t[3]), sleep=pauses.append)
    assert client.page(1) == client.page(1) == "<b>1</b>"
    assert client.requests == 3 and client.hits == 1 and asked[-1][1] == 2 and pauses[1] > pauses[0]
    with pytest.raises(RuntimeError, match="4 tries"):
        client.page(7)


def test_lists_that_grow_are_loaded_anew(spark):
    held = [1, 2]
    c = catalog.Catalog(spark, {"l": held})
    assert c.frame("l").count() == 2
    held.append(3)
    assert c.frame("l").count() == 3


def test_types_of_texts(spark):
    from agrolith.functions.types import coerce, infer

    df = spark.createDataFrame([("1", "2020-01-02", "x", "1.5", "12345678901234567890")] * 9 + [("z", "5/6/2020", "y", "NaN", "1")], "a string, b string, c string, d string, e string")
    assert infer(df) == {"a": "integer", "b": "date", "c": "string", "d": "number", "e": "number"}
    assert str(df.select(coerce(df.b, "date").alias("b")).distinct().orderBy("b").first().b) == "2020-01-02 00:00:00"
