"""Every registered query against its DuckDB oracle on the smallest data."""

import os

import pytest

import __spark_entry__ as entry
from churnwise import catalog
from scripts.oracle_check import digest, duck

SF = "/root/testdata/sf0.001"
KEYS = sorted(catalog.QUERIES)
TYPES = {"int": "int", "bigint": "bigint", "double": "double", "string": "string", "date": "date",
         "timestamp": "ts", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
         "DATE": "date", "TIMESTAMP": "ts", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sql = catalog.ORACLE.get(key)
    df = catalog.QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        assert df.columns
        return
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in cols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(cols, drows)[0]
    # same type per column (Spark simple type vs DuckDB type)
    spark_types = {f.name.lower(): TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {r[0].lower(): TYPES.get(r[1].split("(")[0], r[1]) for r in con.execute("DESCRIBE " + sql).fetchall()}
    assert spark_types == duck_types


def test_every_query_has_an_oracle():
    missing = set(catalog.QUERIES) - set(catalog.ORACLE)
    assert not missing, missing


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns == entry.entry(spark).columns
