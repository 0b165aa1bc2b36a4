"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in os.listdir(SF):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{file}'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", [n for module in entry.BASE_MODULES for n in module.QUERIES])
def test_query(spark, tables, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    sql = tables.execute(entry.oracle_sql()[name])
    names = [d[0] for d in sql.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    expected = [tuple(row[i] for i in place) for row in sql.fetchall()]
    assert got
    assert ordered(got) == ordered(expected)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["page_id", "url", "title", "summary"]
    assert df.count() == 50
