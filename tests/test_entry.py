import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = [name for name in entry.queries() if not name.startswith("op") and name != "pipeline"]


def normal(frame):
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if pd.isna(v) else round(v, 4) if isinstance(v, float) else v for v in row) for row in frame.astype(object).itertuples(index=False)]
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).columns == ["admin0_name", "admin1_name", "admin2_name", "level_id", "revenue", "n_orders"]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, oracle, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert normal(got) == normal(oracle.sql(entry.oracle_sql()[name]).df())
