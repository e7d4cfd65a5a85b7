"""The registered queries beside their SQL, and what native plans may not contain."""

import duckdb
import pytest

from bidloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
NATIVE = [q for q in QUERIES if q.split("_")[0] in ("op1", "op6", "op7", "op8")]


def normal(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    result = con.execute(ORACLES[name])
    assert normal(df.columns, df.collect()) == normal([d[0] for d in result.description], result.fetchall())


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    for banned in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert banned not in plan
