"""Every registered query against its DuckDB SQL on the sf0.001 tables:
same columns, same rows (order-insensitive, exact values)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from emberledger.plans.acceptance import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        return "nan" if isinstance(x, float) and math.isnan(x) else repr(x + 0.0 if isinstance(x, float) else x)

    return sorted("|".join(v(r[i]) for i in order) for r in rs)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, got) == _canon(ocols, want)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["activity", "input_year", "n_records", "n_unmatched", "total_amount", "total_mtco2e"]
    assert df.count() > 0
