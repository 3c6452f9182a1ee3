"""Every registered query with SQL against its oracle on the smallest tables."""

import duckdb
import pytest

from churnwise.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def _value(x):
    if isinstance(x, float):
        return round(x, 6)
    return str(x) if hasattr(x, "isoformat") else x


def test_one_query_for_each_operator():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    want = sorted([tuple(_value(r[names.index(c)]) for c in sorted(names)) for r in result.fetchall()], key=str)
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    got = sorted([tuple(_value(r[c]) for c in sorted(names)) for r in df.collect()], key=str)
    assert got == want
