"""Every query with SQL beside it gives the same rows as DuckDB on the same tables."""

import math

import duckdb
import pandas as pd
import pytest

from tidewise.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return connection


def plain(df: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 5) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    df = df[sorted(df.columns)]
    return sorted((tuple(value(v) for v in row) for row in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, oracle, name):
    got, want = QUERIES[name](spark, DIR).toPandas(), oracle.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_every_query_has_sql_but_the_simulation():
    assert set(QUERIES) - set(SQL) == {"q_policy_simulation"}


def test_simulation_repeats(spark):
    one, two = (QUERIES["q_policy_simulation"](spark, DIR).orderBy("seed").collect() for _ in range(2))
    assert one == two and len(one) == 25 and all(r.gained >= 0 and 0 <= r.waste <= 1 for r in one)


def test_backfill_of_customers_without_orders(spark, tmp_path):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE customer AS SELECT * FROM (VALUES (1), (2), (3), (4)) t(c_custkey)")
    connection.execute("CREATE TABLE orders AS SELECT * FROM (VALUES (1, 1, TIMESTAMP '1998-10-05'), (2, 1, TIMESTAMP '1999-03-01'), (3, 2, TIMESTAMP '1992-07-01'), (4, 4, NULL)) t(o_orderkey, o_custkey, o_orderdate)")
    for t in ("customer", "orders"):
        connection.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    got = QUERIES["q_backfill_decision"](spark, str(tmp_path)).toPandas()
    assert plain(got) == plain(connection.execute(SQL["q_backfill_decision"]).df())
    assert {(r.c_custkey, r.decision, r.months) for r in got.itertuples()} == {(1, "extend", 3), (2, "none", 78), (3, "new", 1), (4, "new", 1)}
