"""Every registered query beside its SQL at the smallest scale, and what its plan may not contain."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry
from bidloom.registry.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().toString()
    for banned in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct"):
        assert banned not in plan
    got = normal(df.columns, df.collect())
    if name not in ORACLES:
        assert got[1]
        return
    result = duck.execute(ORACLES[name])
    assert got == normal([d[0] for d in result.description], result.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "order_status", "product_id", "revenue"]
    rows = df.collect()
    assert rows == sorted(rows, key=lambda r: (r[0], -r[3], r[1], r[2])) and isinstance(rows[0][0], dt.date)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
