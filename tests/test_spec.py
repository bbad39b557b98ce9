import datetime as dt

import pytest
from pyspark.sql import functions as F

from agrolith.functions.types import coerce, infer, inferred
from agrolith.operators.params import Bindings, level_sql
from agrolith.operators.spec import Filter, Sort, TableSpec, evaluate, render_sql, search


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, None, float("nan")), (3, "50%off", None), (4, "b", -2.0)], "id int, s string, x double")


def ids(df):
    return [r.id for r in df.collect()]


@pytest.mark.parametrize(
    ("entry", "nulls", "expected"),
    [
        (Filter("ne", "s", ["a"]), "sql", {3, 4}),
        (Filter("ne", "s", ["a"]), "js", {2, 3, 4}),
        (Filter("nin", "s", ["a", "b"]), "sql", {3}),
        (Filter("nin", "s", ["a", "b"]), "js", {2, 3}),
        (Filter("in", "s", []), "sql", set()),
        (Filter("c", "s", ["%"]), "sql", {3}),
        (Filter("v", "x"), "sql", {1, 4}),
        (Filter("nv", "x"), "sql", {2, 3}),
        (Filter("n", "s"), "sql", {2}),
        (Filter("lt", "x", [0.5]), "js", {3, 4}),
    ],
)
def test_filters(rows, entry, nulls, expected):
    assert set(ids(evaluate(rows, TableSpec(filter=[entry], nulls=nulls)))) == expected


def test_bad_filters(rows):
    with pytest.raises(ValueError):
        evaluate(rows, TableSpec(filter=[Filter("eq", "s", [])]))
    with pytest.raises(ValueError):
        evaluate(rows, TableSpec(filter=[Filter("like", "s", ["a"])]))
    with pytest.raises(ValueError):
        evaluate(rows, TableSpec(select=[]))
    with pytest.raises(ValueError):
        render_sql("", TableSpec())


def test_null_and_nan_sort_last_both_ways(rows):
    assert ids(evaluate(rows, TableSpec(sort=[Sort("x"), Sort("id")]))) == [4, 1, 2, 3]
    assert ids(evaluate(rows, TableSpec(sort=[Sort("x", "desc"), Sort("id")]))) == [1, 4, 2, 3]


def test_order_of_steps(rows):
    spec = TableSpec(derive={"y": "key * 10"}, filter=[Filter("gt", "id", [1])], sort=[Sort("id", "desc")], slice=(1, 3), select=["id", "y"], names={"id": "key"})
    assert [tuple(r) for r in evaluate(rows, spec).collect()] == [(3, 30), (2, 20)]


def test_rendered_sql_gives_the_same_rows(spark, rows):
    rows.createOrReplaceTempView("spec_rows")
    spec = TableSpec(filter=[Filter("in", "s", ["a", "b"]), Filter("nn", "x")], sort=[Sort("id", "desc")], slice=(0, 1), select=["id"], names={"id": "k"})
    sql, args = render_sql("spec_rows", spec)
    assert [tuple(r) for r in spark.sql(sql, args=args).collect()] == [tuple(r) for r in evaluate(rows, spec).collect()] == [(4,)]
    empty, args = render_sql("spec_rows", TableSpec(filter=[Filter("in", "s", [])]))
    assert spark.sql(empty, args=args).count() == 0


def test_search(rows):
    assert ids(search(rows, "50")) == [3]
    assert ids(search(rows, "off")) == [3]
    assert ids(search(rows, "ff")) == []


def test_bindings():
    bind = Bindings()
    assert bind.value(1) == "?" and bind.list([2, 3]) == "?, ?" and bind.list([]) == "NULL"
    params = bind.params
    params.append(9)
    assert bind.params == [1, 2, 3]
    with pytest.raises(TypeError):
        bind.list("abc")


def test_level_predicate():
    assert level_sql({}, Bindings()) == "admin1_name IS NULL AND admin2_name IS NULL"
    bind = Bindings()
    text = level_sql({"admin0": ["A", " "], "admin1": "B"}, bind, iso3=["KEN"])
    assert text == "iso3 IN (?) AND admin0_name IN (?) AND admin1_name IN (?) AND admin1_name IS NOT NULL AND admin2_name IS NOT NULL"
    assert bind.params == ["KEN", "A", "B"]


def test_inference_needs_ninety_percent(spark):
    def kind(good, bad):
        return infer(spark.createDataFrame([("1",)] * good + [("x",)] * bad, "a string"))["a"]

    assert kind(9, 1) == "integer"
    assert kind(89, 11) == "string"
    assert infer(spark.createDataFrame([(None,), ("",)], "a string"))["a"] == "string"
    assert infer(spark.createDataFrame([("1.5",), ("2",)], "a string"))["a"] == "number"
    assert infer(spark.createDataFrame([("true",), ("False",)], "a string"))["a"] == "boolean"
    assert infer(spark.createDataFrame([("2020-01-02",), ("1/2/2020",)], "a string"))["a"] == "date"


def test_coercion(spark):
    df = spark.createDataFrame([("1", "true", "2020-01-02"), ("x", "0", "nonsense"), (None, None, None), ("1.5", " FALSE ", "1/2/2020")], "n string, b string, d string")
    got = df.select(coerce(F.col("n"), "number").alias("n"), coerce(F.col("b"), "boolean").alias("b"), coerce(F.col("d"), "date").alias("d"), coerce(F.col("n"), "bigint").alias("i")).collect()
    assert [r.n for r in got] == [1.0, None, None, 1.5]
    assert [r.b for r in got] == [True, False, None, False]
    assert [r.d for r in got] == [dt.datetime(2020, 1, 2), None, None, dt.datetime(2020, 1, 2)]
    assert [r.i for r in got] == [1, None, None, None]
    assert inferred(spark.createDataFrame([("1",), ("2",)], "a string")).schema["a"].dataType.simpleString() == "double"


def test_js_comparisons_of_texts(spark):
    df = spark.createDataFrame([("a", 1), (None, None), ("z", 5)], "t string, n int")
    got = lambda entry: [r.t for r in evaluate(df, TableSpec(filter=[entry], nulls="js")).collect()]
    assert got(Filter("lt", "t", ["m"])) == ["a"] and got(Filter("gte", "t", ["m"])) == ["z"]
    assert got(Filter("lt", "n", [2])) == ["a", None]


def test_row_function_errors(spark):
    from agrolith.functions.rowwise import RowFunction

    df = spark.createDataFrame([(1, 0), (4, 2)], "a int, b int")
    out = evaluate(df, TableSpec(derive={"q": RowFunction(lambda r: r["a"] / r["b"], "double"), "w": RowFunction(lambda r: "q" in r)}, errors="err")).collect()
    assert [(r.q, r.w) for r in out] == [(None, False), (2.0, False)] and "ZeroDivision" in out[0].err["q"] and out[1].err == {}
