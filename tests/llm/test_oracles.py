"""The queries that have SQL against it."""

from __future__ import annotations

import duckdb
import pytest

from tableferry.llm.oracles import ORACLES
from tableferry.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    folder = "/root/testdata/sf0.01"
    sql = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        sql.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    df = QUERIES[name](spark, folder)
    want = sql.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    named = df.select(*want.columns)
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean"}
    assert [t for _, t in named.dtypes] == [kinds[str(t)] for t in want.types]
    assert sorted(map(tuple, named.collect()), key=repr) == sorted(want.fetchall(), key=repr)
