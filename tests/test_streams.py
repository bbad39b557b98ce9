"""Conflation in state, harvests that go on, records in splits, and rates against plain versions."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from agrolith.operators import finance, neighbours
from agrolith.sources import paged, records
from agrolith.streaming.conflation import Conflation


def newest(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "")
    out = {}
    for row in rows:
        if row[0] not in out or key(row) > key(out[row[0]]):
            out[row[0]] = row
    return out


def test_conflation(spark, tmp_path):
    """Three runs with late rows, repeats, null keys, orders and values; the second and third go on from the state."""
    rng = random.Random(4)
    source, schema = str(tmp_path / "in"), "k string, o int, v string"
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    seen, changed = [], {}
    spark.createDataFrame([], schema).write.parquet(source)
    for turn in range(3):
        rows = [(rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, *range(8 * turn, 8 * turn + 12)]), rng.choice(["x", "y", None])) for _ in range(60)]
        rows += [(f"new{turn}", 1, "z")] * 3
        before = newest(seen)
        seen += rows
        for key, row in newest(seen).items():
            changed[key] = changed.get(key, 0) + (key not in before or before[key][2] != row[2])
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(source)
        held = Conflation(spark, source, spark.read.parquet(source).schema, ["k"], ["o"], ["v"], log, state)
        held.advance()
    got = {r.k: (r.v, r.changes) for r in held.snapshot().collect()}
    assert got == {key: (row[2], changed[key]) for key, row in newest(seen).items()}
    states = held.history().orderBy("batch").collect()
    assert {r.k for r in states if r.state == "added"} == set(got) and len({(r.k, r.batch) for r in states}) == len(states)
    held.advance()
    assert held.history().count() == len(states)  # nothing new, nothing changed


def numbers(count, broken=(), wrong=()):
    """A client of a class that workers, which don't have this module, get by value."""

    class Numbers(paged.Client):
        def pages(self):
            return count

        def page(self, number):
            if number in broken:
                raise ConnectionError("no answer")
            return f"{number + (number in wrong)}:text"

        def echo(self, text, number):
            return int(text.split(":")[0])

    return Numbers()


def test_harvest_goes_on(spark):
    """Failing pages stop a harvest at its cursor; others go on with what is missing, and with pages that come later."""
    options = {"each": 2, "tries": 2, "pause": 0.01}
    first = paged.Harvest(spark, numbers(10, broken=(7,)), 3, **options)
    with pytest.raises(Exception, match="could not be had"):
        first.advance()
    assert first.cursor() == 6
    second = paged.Harvest(spark, numbers(10), 3, first.out, first.state, **options)
    second.advance()
    third = paged.Harvest(spark, numbers(13, wrong=(12,)), 3, first.out, first.state, **options)
    with pytest.raises(Exception, match="instead of 12|could not be had"):
        third.advance()
    paged.Harvest(spark, numbers(13), 3, first.out, first.state, **options).advance()
    assert sorted(map(tuple, first.rows().collect())) == [(n, f"{n}:text") for n in range(13)]


def test_states_are_written_to_few_cells(spark):
    """Two a pivot at most, whatever their bounds."""
    f, rng = ["x", "y", "z"], np.random.default_rng(5)
    rows = [(q, *map(float, rng.uniform(0, 100, 3)), float(rng.uniform(0.001, 40))) for q in range(300)]
    queries = spark.createDataFrame(rows, "_q long, x double, y double, z double, _reach double")
    box = F.struct(*(F.lit(v).alias(f"_{side}{c}") for c in f for side, v in (("lo", 0.0), ("hi", 100.0))), F.lit(100.0).alias("_span"))
    counts = neighbours.looked_into(queries.withColumn("_box", box), f).groupBy("_q", "_level").count().where("_level > 0").collect()
    assert max(r["count"] for r in counts) <= 8


def test_harvest_is_one_stream(spark, monkeypatch):
    """Of as many batches as its pages need."""
    started, start = [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **k: started.append(1) or start(self, *a, **k))
    harvest = paged.Harvest(spark, numbers(20), 3, each=2)
    harvest.advance()
    assert len(started) == 1
    assert sorted(map(tuple, harvest.rows().collect())) == [(n, f"{n}:text") for n in range(20)]
    batches = [p.name for p in Path(harvest.out).iterdir() if p.name.isdigit()]
    assert sorted(map(int, batches)) == list(range(7))


def test_batches_of_a_harvest_stay_few(spark):
    """However many pages there are; a harvest that failed goes on in larger batches if pages came meanwhile, and each page is there once."""
    options = {"each": 2, "tries": 1, "pause": 0.01}
    first = paged.Harvest(spark, numbers(100, broken=(57,)), 3, **options)
    with pytest.raises(Exception, match="could not be had"):
        first.advance()
    assert first.cursor() == 55
    second = paged.Harvest(spark, numbers(180), 3, first.out, first.state, **options)
    second.advance()
    assert sorted(map(tuple, second.rows().collect())) == [(n, f"{n}:text") for n in range(180)]
    batches = [p.name for p in Path(second.out).iterdir() if p.name.isdigit()]
    assert sorted(map(int, batches)) == list(range(11 + 1 + 14))  # of 5 pages, the one that failed, and of 9


def test_harvest_of_nothing(spark):
    harvest = paged.Harvest(spark, numbers(0))
    harvest.advance()
    assert harvest.rows().count() == 0 and harvest.cursor() == 0


def record(year, values, width=6):
    return f"{year:4d}" + "".join(f"{v:{width}.1f}" for v in values)


@pytest.fixture
def text(tmp_path):
    years = [year for year in range(1950, 2020) for _ in range(3)]
    lines = [record(year, [year % 100 + m / 10 if m != 5 else -999.9 for m in range(12)]) for year in years]
    (tmp_path / "a.txt").write_text("prose\nmore STANDARDIZED prose\nAnomaly (standardized)\n" + "\n".join(lines))  # no end of the last line
    (tmp_path / "none.txt").write_text("nothing of use\n" + "\n".join(lines))
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "_hidden").write_text("STANDARDIZED\n" + "\n".join(lines))
    return tmp_path, [(year, m + 1, round(year % 100 + m / 10, 1)) for year in years for m in range(12) if m != 5]


def read(spark, path, where, **options):
    rows = records.read_records(spark, str(path), **options).where(where)
    return rows, sorted((r.year, r.month, round(r.value, 1)) for r in rows.collect())


@pytest.mark.parametrize("where", ["true", "year > 1999", "year >= 1980 AND year < 1983", "year = 1951", "year IN (1950, 2019)", "year BETWEEN 3000 AND 3001", "year > 1990 AND month = 3", "year IN (1960, 1970) AND year <> 1960"])
@pytest.mark.parametrize("options", [{"split": "400"}, {"split": "400", "sorted": "true"}, {}])
def test_records(spark, text, where, options):
    path, rows = text
    test = re.sub(r"BETWEEN (\d+) AND (\d+)", r">= \1 and year <= \2", where).replace("true", "True").replace("AND", "and").replace("IN", "in").replace("<>", "!=")
    test = re.sub(r"(?<![<>!=])=(?!=)", "==", test)
    want = sorted(r for r in rows if eval(test, {"year": r[0], "month": r[1]}))
    assert read(spark, path, where, **options)[1] == want


def test_filters_skip_splits(spark, text):
    path, _ = text
    tasks = lambda where, **o: records.read_records(spark, str(path), split=400, **o).where(where).rdd.getNumPartitions()
    assert tasks("true") == tasks("year > 2017") == 42
    assert tasks("year > 2017", sorted="true") == 2 and tasks("year = 1950", sorted="true") == 1


def test_uneven_records(spark, tmp_path):
    lines = [record(2000 + at, [float(at)] * 12) + " " * (at % 2) for at in range(9)] + ["prose", ""]
    (tmp_path / "a.txt").write_text("STANDARDIZED\n" + "\n".join(lines))
    assert len(read(spark, tmp_path, "true", split=100)[1]) == 9 * 12
    even = [record(2000, [1.0] * 12)] * 40
    even[33:35] = [even[0] + "xx", even[0][:-2]]
    (tmp_path / "a.txt").write_text("STANDARDIZED\n" + "\n".join(even))
    with pytest.raises(Exception, match="different lengths"):
        read(spark, tmp_path, "true", split=200)


def plain_rate(flows):
    value = lambda r: sum(x / (1 + r) ** t for t, x in enumerate(flows))
    a, b = 0.1, 0.15
    for _ in range(100):
        fa, fb = value(a), value(b)
        if abs(fb - fa) < 1e-10:
            return None
        c = b - fb * (b - a) / (fb - fa)
        if abs(c - b) < 1e-6:
            return c
        a, b = b, c
    return None


@pytest.mark.parametrize("cells", [1, 1_000_000])
def test_prefix_rates(spark, monkeypatch, cells):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for key in range(20):
        flows = [-100.0, *rng.uniform(-20, 60, rng.integers(0, 14)).round(2)]
        for year, flow in enumerate(flows):
            rows.append((key, 2000 + year, float(flow)))
            want[key, 2000 + year] = plain_rate([float(x) for x in flows[: year + 1]]) if year else None
    df = spark.createDataFrame(rows, "k int, year int, flow double").repartition(3)
    monkeypatch.setattr(finance, "CELLS", cells)
    found = finance.cumulative_rates(df, ["k"], "year", "flow", 0.1, 0.12)
    assert found.columns == ["k", "year", "flow", "irr", "mirr"]
    for row in found.collect():
        expected = want[row.k, row.year]
        assert row.irr is None if expected is None else row.irr == pytest.approx(expected, abs=1e-7)
    # the arrays of a whole key give its last prefix
    whole = df.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("year", "flow"))), lambda x: x["flow"]).alias("f"))
    last = {r.k: r.r for r in whole.select("k", finance.irr("f").alias("r")).collect()}
    assert all((last[k] is None) == (want[k, max(y for q, y in want if q == k)] is None) for k in last)


def test_too_many_flows(spark, monkeypatch):
    monkeypatch.setattr(finance, "MOST_FLOWS", 5)
    df = spark.range(6).select(F.lit(1).alias("k"), "id", (F.col("id") - 3.0).alias("flow"))
    with pytest.raises(Exception, match="more than 5 flows"):
        finance.cumulative_rates(df, ["k"], "id", "flow", 0.1, 0.1).collect()


def plain_nearest(rows, k):
    out = set()
    for key, year, *own in rows:
        near = sorted((sum((a - b) ** 2 for a, b in zip(own, other, strict=True)) ** 0.5, y) for q, y, *other in rows if q == key and y != year)
        out |= {(key, year, y, round(d, 9), place + 1) for place, (d, y) in enumerate(near[:k])}
    return out


@pytest.mark.parametrize(("features", "block"), [(1, 8), (2, 512), (3, 16), (5, 64)])
def test_nearest(spark, monkeypatch, features, block):
    """Clusters, equal points, outliers, small keys and ties, against all pairs."""
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rng = np.random.default_rng(features)
    rows, names = [], [f"f{i}" for i in range(features)]
    for key, n in (("a", 250), ("b", 40), ("c", 3), ("d", 1)):
        for year in range(n):
            kind = rng.integers(0, 5)
            point = [1.0] * features if kind == 0 else rng.integers(0, 4, features).astype(float) if kind == 1 else rng.normal(0, 1 if kind < 4 else 1000, features)
            rows.append((key, year, *map(float, point)))
    df = spark.createDataFrame(rows, "k string, year int, " + ", ".join(f"{n} double" for n in names)).repartition(4)
    odd = spark.createDataFrame([("a", 999, *[float("nan")] * features), (None, 1, *[0.0] * features), ("b", 998, *[None] * features)], df.schema)
    found = neighbours.nearest_years(df.unionByName(odd), df.unionByName(odd), ["k"], names, 4)
    assert found.columns == ["k", "year", "analogue", "distance", "place"]
    assert {(r.k, r.year, r.analogue, round(r.distance, 9), r.place) for r in found.collect()} == plain_nearest(rows, 4)


def test_few_pairs_are_compared(spark, monkeypatch):
    """A key of 20,000 states makes far fewer pairs than their square, also where a third of them are equal."""
    df = spark.range(20_000).select(F.lit("one").alias("k"), F.col("id").alias("year"), *(F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(s)).alias(f"f{s}") for s in (1, 2, 3)))
    counted = []
    inner = neighbours.candidates

    def spied(*args):
        out = inner(*args)
        counted.append(out.count())
        return out

    monkeypatch.setattr(neighbours, "candidates", spied)
    assert neighbours.nearest_years(df, df, ["k"], ["f1", "f2", "f3"], 5).count() == 100_000
    assert counted[0] < 20_000**2 / 50
