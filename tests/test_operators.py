import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from agrolith.functions import columns as C
from agrolith.operators import aggregates as A
from agrolith.operators import finance, gates, hierarchy, params, relational, seasonal
from agrolith.plans.analyses import SECANT
from agrolith.streaming.events import Views, growing


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_last_right_row_wins(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    right = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "n")], "rk string, ord int, v string")
    got = relational.left_last_wins(left, right, "k", "rk", ["ord"])
    assert [(r.id, r.data.v if r.data else None) for r in got.orderBy("id").collect()] == [(1, "y"), (2, None), (3, None)]
    with pytest.raises(ValueError):
        relational.left_last_wins(left, right, "nope", "rk", ["ord"])


def test_many_to_one_raises(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    good = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert rows(relational.many_to_one(left, good, "k"), "k") == [("a", 1), ("b", 2)]
    for bad in ([("a", 1)], [("a", 1), ("a", 2), ("b", 3)]):
        with pytest.raises(Exception, match="no match|twice"):
            relational.many_to_one(left, spark.createDataFrame(bad, "k string, v int"), "k").collect()


def test_prefix_of_two_names_stays_null(spark):
    names = spark.createDataFrame([("West",), ("East",), ("Ea",)], "name string")
    known = spark.createDataFrame([("West A",), ("West B",), ("East One",)], "key string")
    assert rows(relational.resolve_names(names, known, {}), "name") == [("Ea", None), ("East", "East One"), ("West", None)]


def test_nearest_and_ties(spark):
    points = spark.createDataFrame([(0.0,), (5.0,), (9.0,), (30.0,)], "v double")
    centres = spark.createDataFrame([(0.0,), (10.0,)], "c double")
    assert rows(relational.nearest(points, centres, "v", "c", 6.0), "v") == [(0.0, 0.0), (5.0, 0.0), (9.0, 10.0), (30.0, None)]


def test_sets(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    new = spark.createDataFrame([(9, "b")], "id int, s string")
    assert rows(relational.replace_slice(old, new, F.col("s") == "a"), "id") == [(2, None), (9, "b")]
    assert rows(relational.upsert(old, spark.createDataFrame([(1, "z")], "id int, s string"), ["id"]), "id") == [(1, "z"), (2, None)]
    assert relational.concat_rows(old, new.drop("s")).columns == ["id", "s"]
    with pytest.raises(Exception, match="two keys"):
        relational.alias_keys(spark.createDataFrame([("a", ["x"]), ("b", ["x"])], "k string, al array<string>"), "k", "al").collect()


def test_rollup_level_with_missing_key(spark):
    df = spark.createDataFrame([("A", "a", 1), ("A", None, 2)], "admin0_name string, admin1_name string, v int").withColumn("admin2_name", F.lit("x"))
    table = hierarchy.rollup_table(df, ["admin0_name", "admin1_name", "admin2_name"], F.sum("v").alias("v"))
    level1 = table.where(params.level_column({"admin0": ["A"]}, grouping="level_id"))
    assert sorted((r.admin1_name or "", r.v) for r in level1.collect()) == [("", 2), ("a", 1)]


def test_mode_tie_is_the_smallest(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", None)], "k string, v string")
    assert rows(A.modes(df, ["k"], "v")) == [("k", "a", 1, 2)]


def test_weighted_mean_and_gaps(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 3.0), ("a", 9.0, None), ("b", 5.0, 0.0)], "k string, v double, w double")
    assert rows(df.groupBy("k").agg(A.weighted_mean(F.col("v"), F.col("w")).alias("m")), "k") == [("a", 2.5), ("b", None)]
    d = spark.createDataFrame([("g", float(x)) for x in (1, 2, 10, 11, 30)], "k string, x double")
    assert [r.cluster for r in A.split_at_gaps(d, ["k"], "x", 3).orderBy("x").collect()] == [0, 0, 1, 1, 2]
    assert [r.x for r in A.largest_cluster(d, ["k"], "x", 5).orderBy("x").collect()] == [1.0, 2.0]


def test_wrapped_rows(spark):
    df = spark.createDataFrame([("p", 1, "Tana", None), ("p", 2, "River", 5.0), ("p", 3, "Lamu", 6.0)], "p string, y int, n string, v double")
    assert [(r.n, r.v) for r in A.merged_wrapped(df, ["p"], ["y"], "n", "v").orderBy("y").collect()] == [("Tana River", 5.0), ("Lamu", 6.0)]


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(float("nan"),), (None,)], "x double").agg(*A.quantile_summary(F.col("x")))
    assert rows(empty) == [(None, None, None, None, 0)]


def test_seasons_cross_years(spark):
    months = [("c", 1999, 12, 1.0), ("c", 2000, 1, 2.0), ("c", 2000, 2, 3.0), ("c", 2000, 11, 4.0), ("c", 2000, 12, 5.0), ("c", 2001, 1, 6.0)]
    df = spark.createDataFrame(months, "k string, y int, m int, v double")
    got = {(r.season_year, r.season): r.season_mean for r in seasonal.seasonal_means(df, ["k"], "y", "m", "v").collect()}
    assert got == {(2000, "DJF"): 2.0, (2000, "NDJ"): 5.0}
    first = {(r.season_year, r.season) for r in seasonal.seasonal_means(df, ["k"], "y", "m", "v", "first").collect()}
    assert first == {(1999, "DJF"), (2000, "NDJ")}


def test_baseline_needs_twenty_years(spark):
    def n(years):
        df = spark.createDataFrame([("c", 1990 + t, float(t)) for t in range(years)], "k string, y int, v double")
        return seasonal.baseline(df, ["k"], "y", "v", 1900, 2100).count()

    assert (n(19), n(20)) == (0, 1)


def test_zero_mean_has_no_anomaly(spark):
    assert one(spark, C.percent_anomaly(F.lit(1.0), F.lit(0.0))) is None


def test_failed_runs(spark):
    df = spark.createDataFrame([("c", y, y not in (2003, 2006)) for y in range(2000, 2008)], "k string, y int, f boolean")
    assert rows(seasonal.failed_runs(df, ["k"], "y", F.col("f")), "run_start") == [("c", 2000, 2002, 3), ("c", 2004, 2005, 2), ("c", 2007, 2007, 1)]


def test_dekads(spark):
    got = [one(spark, C.dekad_month(F.lit(d))) for d in (1, 3, 4, 36, 37)]
    assert got == [1, 1, 2, 12, 1]
    wrapped = one(spark, C.month_segments(F.lit(11), F.lit(2)))
    assert [(s.m_start, s.m_end) for s in wrapped] == [(11, 12), (1, 2)]


@pytest.mark.parametrize(("title", "expected"), [("Bulletin May 2021", (2021, 5, "month-year")), ("2020 march issue", (2020, 3, "year-month")), ("Annual 2019", (2019, None, "year-only")), ("none", (None, None, "unparsed"))])
def test_period(spark, title, expected):
    y, m, b = C.period_of(F.lit(title))
    assert tuple(spark.range(1).select(y, m, b).first()) == expected


def test_text_functions(spark):
    assert one(spark, C.norm(F.lit("  Murang'a-North St. "))) == "muranga north st"
    assert one(spark, C.fill_template(F.lit("a ::: n ::: b"), {"n": F.lit("$1\\x")})) == "a $1\\x b"
    assert one(spark, C.composite_key(F.lit("a"), F.lit(None), F.lit("c"))) == "a||||c"
    assert one(spark, C.numbers_in(F.lit("1,234 and -5.5"))) == [1234.0, -5.5]
    assert [one(spark, C.numeric_cell(F.lit(x))) for x in ("1,200", "–", "n/a", "abc")] == [1200.0, None, None, None]
    assert one(spark, C.wrap_words(F.lit("aa bb cccc d"), 5)) == "aa bb\ncccc\nd"
    assert one(spark, C.folded_contains(F.lit("São Tomé"), "sao")) is True
    assert one(spark, C.strip_tags(F.lit("<b>a</b>&amp;<i>b</i>"))) == "a & b"
    assert one(spark, C.citation(F.lit("A."), F.lit(None), F.lit("B"))) == "A. B."
    assert one(spark, C.compact_number(F.lit(1234567.0))) == "1.2M"
    assert one(spark, C.first_match(F.lit("by Ann"), [r"from (\w+)", r"by (\w+)"])) == "Ann"
    assert one(spark, C.class_between(F.lit(30.0), [30, 90], ["a", "b", "c"])) == "b"
    assert one(spark, C.column_sums(F.array(F.array(F.lit(1.0), F.lit(None).cast("double")), F.array(F.lit(2.0), F.lit(3.0))), 2)) == [3.0, 3.0]


def test_terciles_of_values_that_vary(spark):
    """Of seven years the third and fifth are terciles themselves, also where each computation gives other last bits."""
    noise = F.udf(lambda x: x + random.random() * 1e-6, "double").asNondeterministic()
    df = spark.range(210).select((F.col("id") % 30).alias("k"), (F.floor(F.col("id") / 30) + 2000).alias("y")).withColumn("v", noise(F.col("y").cast("double")))
    got = seasonal.anomalies(df, ["k"], "y", "v", 0, 9999, least=3).groupBy("tercile").count()
    assert dict(map(tuple, got.collect())) == {"Dry": 90, "Near": 60, "Wet": 60}


def test_paragraphs_lose_blanks_only(spark):
    """Not the digits of their own place."""
    assert one(spark, C.paragraphs(F.lit("0100 a0 \n\n  \n33 b 3\n x "))) == ["0100 a0", "33 b 3", "x"]


def test_rates_of_return(spark):
    rates = finance.secant_rates(np.array([[-100.0, 60.0, 60.0], [10.0, 10.0, 0.0]]))
    assert rates[0] == pytest.approx(0.1306623863, abs=1e-6)
    assert np.isnan(rates[1])
    df = spark.createDataFrame([([-100.0, 60.0, 60.0],), ([5.0],), ([1.0, 2.0],)], "f array<double>")
    got = df.select(finance.irr("f"), finance.mirr(F.col("f"), 0.1, 0.1)).collect()
    assert got[0][1] == pytest.approx((126 / 100) ** 0.5 - 1)
    assert got[1][0] is None and got[1][1] is None and got[2][1] is None


def test_rates_of_searches_that_wander():
    """They end where the SQL's search ends: term by term, from the same two guesses."""
    flows = [
        [29167.79999999999, -136630.63, -8819.890000000014, 332794.58, 516947.06000000006, 0.0, 0.0],
        [185205.41999999998, -141657.77, -92737.33, 80646.64000000001, -20051.710000000006, 10121.75, 0.0],
        [146900.15000000002, 41301.26999999999, -36528.66, -121500.0, -93773.86, -58885.880000000005, 140204.3],
        [39289.17000000001, -93422.06, -58602.97, 36476.03, 232185.71000000002, 113428.44, 0.0],
    ]
    con = duckdb.connect()
    con.execute("CREATE TABLE p (o_custkey BIGINT, year BIGINT, fl DOUBLE[])")
    con.executemany("INSERT INTO p VALUES (?, 0, ?)", [(at, own) for at, own in enumerate(flows)])
    want = dict(con.execute("WITH RECURSIVE " + SECANT + "SELECT o_custkey, rate FROM found").fetchall())
    got = finance.secant_rates(np.array(flows))
    for at, rate in enumerate(got):
        assert np.isnan(rate) if want.get(at) is None else rate == pytest.approx(want[at], abs=1e-6)


def test_discounted_sums(spark):
    df = spark.createDataFrame([("p", 0, -100.0), ("p", 1, 110.0)], "k string, y int, f double")
    assert [round(r.npv, 9) for r in finance.npv_series(df, ["k"], "y", "f", 0.1).orderBy("y").collect()] == [-100.0, 0.0]


def test_avoided_loss(spark):
    assert one(spark, finance.avoided_loss(F.lit(0.3), F.lit(0.2))) == pytest.approx(0.06 / math.sqrt(2 * math.pi))
    assert one(spark, finance.avoided_loss(F.lit(0.3), F.lit(0.5), absolute=True)) == pytest.approx(0.3 / math.sqrt(2 * math.pi))
    sampled = [r.avoided for r in finance.avoided_loss_sampled(spark, 0.3, 0.2, runs=3, draws=40_000).collect()]
    assert np.mean(sampled) == pytest.approx(0.0239, rel=0.15)


def test_simulation(spark):
    flows = spark.createDataFrame([(0, 0.0, 100.0, 0.1), (1, 130.0, 0.0, 0.1)], "year int, project_benefit double, cost double, discount_rate double")
    bands = finance.simulation_bands(finance.simulate(flows, (1.0, 1.0, 1.0), (1.0, 1.0, 1.0), simulations=50)).orderBy("year").collect()
    assert bands[1].npv_p50 == pytest.approx(-100 + 130 / 1.1)
    assert bands[1].p_bcr_above_one == 1.0 and bands[0].p_npv_positive == 0.0


def test_gates(spark):
    report = spark.createDataFrame([(0, 100.0, 4, None, 0, 98.0, False), (0, 103.0, 9, 1.0, 9, 100.0, False), (1, 50.0, 1, None, 0, None, True)], "unattributed int, max_share_pct double, counties int, dual_ok double, shared int, additivity_pct double, verified boolean")
    assert [r.served for r in gates.serve_gate(report).collect()] == [True, False, True]
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, s string")
    assert rows(gates.duplicate_keys(df, ["id"])) == [(1, 2)]
    same, other = gates.fingerprint(df).first(), gates.fingerprint(df.distinct()).first()
    assert same.content != other.content and (same.rows, other.rows) == (3, 2)
    flagged = gates.suspects(spark.createDataFrame([("k", 2020, 100.0, 1.0), ("k", 2021, 5.0, 2.0)], "k string, y int, v double, o double"), ["k"], "y", "v", ["o"])
    assert [r.suspect_reason for r in flagged.orderBy("y").collect()] == [None, "under_entry"]
    prices = spark.createDataFrame([("m", 1, 10.0, "kg", "c"), ("m", 1, 11.0, "kg", "c"), ("m", 1, 99.0, "bag", None)], "m string, d int, p double, u string, c string")
    flags = gates.qc_flags(prices, "m", "d", "p", "u", "c", ["kg"], 100, ["m", "d", "p"])
    assert [r.qc_flag for r in flags.orderBy("p").collect()] == ["", "", "bad_county;outlier;unexpected_unit"]


def test_views(spark):
    views = Views()
    views.define("b", ["a"], lambda a: a.where("id > 1"))
    views.define("a", [], lambda: spark.range(4))
    assert views.get("b").count() == 2
    views.define("a", [], lambda: spark.range(10), replace=True)
    assert views.get("b").count() == 8
    with pytest.raises(ValueError):
        views.define("a", [], lambda: None)
    views.define("x", ["y"], lambda y: y)
    views.define("y", ["x"], lambda x: x)
    with pytest.raises(ValueError, match="circular"):
        views.get("x")


def test_growing_results(spark):
    *_, last = growing(spark.range(10))
    assert last.done and len(last.rows) == 10 and last.error is None and last.schema.names == ["id"]
    *_, failed = growing(spark.range(10).select(F.when(F.col("id") == 9, F.raise_error(F.lit("bad"))).otherwise(F.col("id"))))
    assert failed.done and "bad" in str(failed.error)


def test_simulations_run_at_the_operators_defaults():
    import inspect

    defaults = lambda f: {n: p.default for n, p in inspect.signature(f).parameters.items()}
    assert defaults(finance.simulate)["simulations"] == 2000 and defaults(finance.avoided_loss_uncertainty)["draws"] == 200_000
    assert "rate" in defaults(finance.npv_series) and defaults(finance.npv_series)["rate"] is inspect.Parameter.empty


def test_nearest_keeps_repeated_points(spark, monkeypatch):
    points = spark.createDataFrame([(5.0, "a"), (5.0, "a"), (30.0, "b")], "v double, k string")
    centres = spark.createDataFrame([(0.0,), (10.0,), (4.0,), (None,)], "c double")
    expected = [(5.0, "a", 4.0), (5.0, "a", 4.0), (30.0, "b", None)]
    assert rows(relational.nearest(points, centres, "v", "c", 6.0), "v") == expected
    monkeypatch.setattr(relational, "FEW", 1)
    assert rows(relational.nearest(points, centres, "v", "c", 6.0), "v") == expected


def test_places_over_ranges(spark):
    df = spark.createDataFrame([(x % 7, x) for x in range(200)], "a int, b int")
    got = rows(relational.placed(df, "n", F.desc("a"), F.asc("b")), "n")
    assert [(r[0], r[1]) for r in got] == sorted(((x % 7, x) for x in range(200)), key=lambda r: (-r[0], r[1])) and [r[2] for r in got] == [*range(1, 201)]


def test_streams_and_values(spark, tmp_path):
    from agrolith.streaming import events as E

    assert E.value_at(spark.range(5), "id", 2, "id") == 2 and E.value_at(spark.range(5), "id", 9, "id") is None
    views = Views()
    held = E.Mutable(views, "base", spark.range(3))
    views.define("n", ["base"], lambda base: base.agg(F.count(F.lit(1)).alias("n")))
    assert views.get("n").first().n == 3
    held.set(spark.range(8))
    assert views.get("n").first().n == 8
    seen = []
    query = E.ticks(spark, 50).writeStream.foreachBatch(E.Queue(lambda batch, number: seen.append(batch.count()))).option("checkpointLocation", str(tmp_path)).start()
    query.processAllAvailable()
    query.stop()
    assert seen
    with E.Cancellable(spark) as job:
        assert job.tag in spark.sparkContext.getJobTags()
        job.cancel()
    assert job.tag not in spark.sparkContext.getJobTags()


def test_repeated_batches_count_once(spark, tmp_path, monkeypatch):
    from agrolith.streaming import events as E

    spark.range(20).write.parquet(str(tmp_path / "in.parquet"))
    real = E.run_available(spark, str(tmp_path / "in.parquet"), lambda rows: rows, "append")
    path = real.inputFiles()[0].rsplit("/", 2)[0]
    spark.range(20).write.mode("overwrite").parquet(f"{path}/0")  # the batch comes a second time
    assert spark.read.option("recursiveFileLookup", True).parquet(path).count() == 20


def test_refresh_without_change(spark):
    from agrolith.streaming.events import refreshed

    old = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    after, changed = refreshed(old, spark.createDataFrame([(2, None), (3, "c"), (1, "b")], "k int, v string"), ["k"])
    assert rows(after, "k") == [(1, "b"), (2, None), (3, "c")] and rows(changed, "k") == [(1, "b", "revised"), (3, "c", "added")]


def test_wrapped_rows_of_several_lines(spark):
    df = spark.createDataFrame([(1, "A", None), (2, "B", None), (3, "C", 1.0), (4, "D", 2.0), (5, "E", None)], "o int, n string, v double").withColumn("k", F.lit(0))
    assert [(r.n, r.v) for r in A.merged_wrapped(df, ["k"], "o", "n", "v").orderBy("o").collect()] == [("A B C", 1.0), ("D", 2.0)]


def test_latest_keeps_whole_batches(spark):
    from agrolith.streaming.events import Latest

    latest = Latest()
    assert latest.frame(spark) is None
    latest(spark.range(5), 0)
    latest(spark.range(25_000), 1)
    got = latest.frame(spark)
    assert latest.number == 1 and got.count() == 25_000 and got.agg({"id": "sum"}).first()[0] == 25_000 * 24_999 // 2
