"""Every registered query of the library against its DuckDB SQL."""

import math
import os

import duckdb
import pytest

from lexweave.plans.registry import ORACLES, QUERIES

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(([plain(r[i]) for i in order] for r in rows), key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    con = duck.execute(ORACLES[name])
    want = sorted_rows([d[0] for d in con.description], con.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) and len(got[1]) > 0
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_run(spark, name):
    assert QUERIES[name](spark, SF).columns
