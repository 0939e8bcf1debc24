"""Contiguous ids for any partitioning, ties, copies and table state."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tableferry as tf
from tableferry.operators.ids import append_numbered


def ids_of(df):
    return sorted(r.id for r in df.select("id").collect())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(0, 40), parts=st.integers(1, 12), start=st.integers(1, 1000))
def test_ids_are_contiguous(spark, n, parts, start):
    df = spark.range(0, n, 1, parts).withColumnRenamed("id", "k")
    assert ids_of(tf.assign_ids(df, start=start)) == list(range(start, start + n))
    by_key = tf.assign_ids(df, F.col("k").desc(), start=start)
    assert [r.k for r in by_key.orderBy("id").collect()] == list(range(n - 1, -1, -1))


def test_frame_order_is_kept_without_a_key(spark):
    df = spark.range(0, 1000, 1, 7).select((999 - F.col("id")).alias("k"))
    assert [r.k for r in tf.assign_ids(df).orderBy("id").collect()] == list(range(999, -1, -1))


def test_a_hot_key_is_spread_over_partitions(spark):
    hot = spark.range(0, 30_000, 1, 6).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    rest = spark.range(0, 30_000, 1, 6).select((F.col("id") % 1000).cast("int").alias("k"), F.lit("x").alias("v"))
    from tableferry.operators.ids import _order_columns, _range_sorted

    df = hot.unionAll(rest)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = (
            _range_sorted(df, _order_columns("k"), False)
            .groupBy(F.spark_partition_id())
            .count()
            .collect()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(c for _, c in sizes) < 20_000  # half of the rows share a key and a value
    numbered = tf.assign_ids(df, "k")
    assert ids_of(numbered) == list(range(1, 60_001))
    assert numbered.orderBy("id").select("k").collect() == df.orderBy("k").select("k").collect()


def test_a_repeated_task_deals_the_same_salts(spark):
    from tableferry.operators.ids import _salted

    rows = [(i % 3, "copy") for i in range(50)] + [(i, "own") for i in range(50)]

    def salts(data):
        df = spark.createDataFrame(data, "k int, v string").coalesce(1)
        return sorted(map(tuple, _salted(df, [F.col("k")]).collect()))

    assert salts(rows) == salts(rows[::-1])


def test_nulls_and_maps(spark):
    df = spark.sql("SELECT * FROM VALUES (1, map('a', 1)), (NULL, map('b', 2)), (0, NULL) AS t(k, m)")
    got = tf.assign_ids(df, "k").orderBy("id").collect()
    assert [r.k for r in got] == [None, 0, 1]


def test_position_and_clash(spark):
    df = spark.createDataFrame([(1, "x")], ["k", "v"])
    assert tf.assign_ids(df, position=1).columns == ["k", "id", "v"]
    with pytest.raises(ValueError, match="already"):
        tf.assign_ids(df.withColumnRenamed("k", "ID"))


def test_find_id_column():
    assert tf.find_id_column(["a", "Id", "id"]) == "Id"
    assert tf.find_id_column(["a", "idx"]) is None


def test_append_continues_and_keeps_the_position(spark, database):
    table = f"{database}.t"
    tf.save_table(spark.createDataFrame([("a", 5, 1)], "k string, ID bigint, v bigint"), table)
    first, count = append_numbered(spark.createDataFrame([("b", 2), ("c", 3)], "k string, v bigint"), table, "k")
    assert (first, count) == (6, 2)
    assert [tuple(r) for r in spark.table(table).orderBy("ID").collect()] == [
        ("a", 5, 1), ("b", 6, 2), ("c", 7, 3),
    ]
    assert tf.next_id(spark, table, "ID") == 8


def test_append_to_an_empty_table_starts_at_one(spark, database):
    table = f"{database}.t"
    tf.create_empty(spark, table, "(k bigint, share real, label text)")
    assert tf.table_max(spark, table) is None and tf.next_id(spark, table) == 1
    append_numbered(spark.createDataFrame([(9, "x")], "k bigint, label string"), table)
    assert [tuple(r) for r in spark.table(table).collect()] == [(1, 9, None, "x")]


def test_old_rows_can_have_an_order_of_their_own(spark, database):
    table = f"{database}.t"
    tf.save_table(spark.createDataFrame([(1, "b"), (2, "a")], "k bigint, v string"), table)
    new = spark.createDataFrame([(4, "x"), (3, "y")], "k bigint, v string")
    append_numbered(new, table, "k", old_order_by="v")
    assert [tuple(r) for r in spark.table(table).orderBy("id").collect()] == [
        (2, "a", 1), (1, "b", 2), (3, "y", 3), (4, "x", 4),
    ]


def test_partly_null_ids_stay_and_are_reported(spark, database):
    table = f"{database}.t"
    tf.save_table(spark.createDataFrame([(3, "a"), (None, "b")], "id bigint, v string"), table)
    append_numbered(spark.createDataFrame([("c",)], "v string"), table)
    assert sorted((r.id or 0, r.v) for r in spark.table(table).collect()) == [
        (0, "b"), (3, "a"), (4, "c"),
    ]
    assert [tuple(r) for r in tf.key_violations(spark.table(table), ["id"]).collect()] == [(None, 1)]


def test_key_violations_over_two_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c")], "k int, v string")
    found = sorted(map(str, tf.key_violations(df, ["k", "v"]).collect()))
    assert found == ["Row(k=1, v='a', n=2)", "Row(k=None, v='c', n=1)"]


def test_staged_rows_are_removed_after_an_upload(spark, database):
    import glob

    from tableferry.session import work_dir

    def staged():
        return len(glob.glob(f"{work_dir(spark)}/tableferry-rows-*"))

    before = staged()
    tf.upload(spark.range(10).withColumnRenamed("id", "k"), f"{database}.t")
    tf.upload(spark.range(10).withColumnRenamed("id", "k"), f"{database}.t")
    assert staged() == before


def test_the_noted_id_is_only_a_starting_place(spark, database):
    name = f"{database}.t"
    df = spark.range(10).withColumnRenamed("id", "k")
    tf.upload(df, name)
    tf.delete_where(spark, name, "id > 6")
    assert tf.next_id(spark, name) == 7  # the noted id lies beyond all rows
    tf.run_statement(spark, f"INSERT INTO {name} VALUES (100, 1)")
    assert tf.next_id(spark, name) == 101  # a row came from elsewhere
    assert tf.upload(df, name).first_id == 101
    properties = dict(map(tuple, spark.sql(f"SHOW TBLPROPERTIES {name}").collect()))
    assert properties["next_id"] == "111"
    plan = spark.table(name).where("id >= 110")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,110)" in plan
