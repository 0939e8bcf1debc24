"""Every registered query against its SQL on the same files."""

from __future__ import annotations

import duckdb
import pytest
from helpers import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tableferry.plans.oracles import ORACLES
from tableferry.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def as_sorted(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in found), key=lambda r: tuple(map(repr, r)))


# Spark and the oracle must agree on the family of each type, not on its width.
def family(name):
    name = name.lower()
    for kind, words in {
        "whole": ("int", "bigint", "integer", "hugeint", "smallint", "tinyint"),
        "real": ("double", "float"),
        "text": ("string", "varchar"),
        "time": ("timestamp_ntz", "timestamp", "timestamp_ns", "timestamp_us"),
    }.items():
        if name in words:
            return kind
    return name


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    ours = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields}
    theirs = {n: family(str(t)) for n, t in zip(expected.columns, expected.types)}
    assert ours == theirs
    got = as_sorted(df.columns, [tuple(r) for r in df.collect()])
    want = as_sorted(expected.columns, expected.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_binary_cells_of_one_row_group_are_dealt_out(spark, tmp_path):
    keys = [*range(1, 2000), None, -3, 5, 5]
    df = spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint")
    df.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    found = QUERIES["geo_ewkb"](spark, str(tmp_path))
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    rows = found.collect()
    assert sorted(r.o_orderkey for r in rows if r.o_orderkey is not None) == sorted(k for k in keys if k is not None)
    odd = [r for r in rows if r.o_orderkey is None or r.o_orderkey < 0]
    assert len(odd) == 2 and all((r.shape, r.srid, r.first_x, r.is_valid) == (None, None, None, True) for r in odd)
    fives = [tuple(r) for r in rows if r.o_orderkey == 5]
    assert fives == [(5, "MULTIPOLYGON", 3857, 2, 2, 0.0, 1.5, True)] * 3


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
