"""Keys across appends, maxima from footers, and ids without a copy."""

from __future__ import annotations

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import tableferry as tf
from tableferry.operators.ids import footer_max
from tableferry.operators.keys import probable_keys, summary_name


@pytest.fixture
def keyed(spark, database):
    name = f"{database}.keyed"
    found = spark.range(2000).select((F.col("id") * 3).alias("a"), F.concat(F.lit("k"), "id").alias("b"))
    tf.save_table(found, name)
    return name


def test_only_hits_are_looked_up(spark, keyed):
    tf.build_key_summary(spark, keyed, ["a", "b"])
    batch = spark.range(1000, 3000).select((F.col("id") * 3).alias("a"), F.concat(F.lit("k"), "id").alias("b"))
    hits = probable_keys(batch, keyed, ["a", "b"])
    found = hits.count()
    assert hits.where("a < 6000").count() == 1000  # none of those that are there is missed
    assert found < 1000 + 150
    violations = tf.appended_violations(batch, keyed, ["a", "b"])
    assert violations.count() == 1000 and rows(violations.select("n", "n_stored").distinct()) == [(1, 1)]


def test_append_unique(spark, keyed):
    make = lambda found: spark.createDataFrame(found, "a bigint, b string")
    assert tf.append_unique(make([(1, "x"), (2, "y")]), keyed, ["a", "b"]) is None
    refused = tf.append_unique(make([(1, "x"), (7, "z"), (7, "z"), (8, None), (9, "w")]), keyed, ["a", "b"])
    assert rows(refused) == [(1, "x", 1, 1), (7, "z", 2, 0), (8, None, 1, 0)]
    assert spark.table(keyed).count() == 2002
    assert tf.append_unique(make([(9, "w")]), keyed, ["a", "b"]) is None
    assert tf.append_unique(make([]), keyed, ["a", "b"]) is None
    assert spark.table(keyed).count() == 2003
    assert rows(tf.key_violations(spark.table(keyed), ["a", "b"])) == []


def test_other_appends_are_noticed(spark, keyed):
    tf.build_key_summary(spark, keyed, ["a"])
    tf.save_table(spark.createDataFrame([(-5, "other")], "a bigint, b string"), keyed)
    refused = tf.append_unique(spark.createDataFrame([(-5, "again")], "a bigint, b string"), keyed, ["a"])
    assert rows(refused) == [(-5, 1, 1)]


def test_empty_tables(spark, database):
    name = f"{database}.none"
    tf.save_table(spark.createDataFrame([], "a bigint"), name)
    assert tf.append_unique(spark.range(5).toDF("a"), name, ["a"]) is None
    assert tf.append_unique(spark.range(4, 6).toDF("a"), name, ["a"]).count() == 1
    assert spark.catalog.tableExists(summary_name(name))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.text("aé\x00", max_size=2)), max_size=12),
    st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.text("aé\x00", max_size=2)), max_size=12),
)
def test_no_key_is_missed(spark, database, old, new):
    name = f"{database}.t{abs(hash((tuple(old), tuple(new))))}"
    tf.save_table(spark.createDataFrame(old, "a int, b string"), name, mode="replace")
    found = tf.appended_violations(spark.createDataFrame(new, "a int, b string"), name, ["a", "b"])
    want = {
        k: (new.count(k), old.count(k)) for k in new if k[0] is None or new.count(k) > 1 or k in old
    }
    got = {(r.a, r.b): (r.n, r.n_stored) for r in found.collect()}
    # a key with a NULL is a violation whatever is stored, so it is not looked up
    assert {k: v if k[0] is not None else v[0] for k, v in want.items()} == {
        k: v if k[0] is not None else v[0] for k, v in got.items()
    }


# -- the largest id -----------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_maximum_comes_from_footers(spark, database):
    name = f"{database}.t"
    tf.upload(spark.range(1000).toDF("k").repartition(5), name)
    from tableferry.sinks.tables import table_location

    table = spark.table(name)
    df = footer_max(spark, table_location(spark, name), table.schema)
    assert "PushedAggregation: [MAX(id)]" in plan(df) and df.first()[0] == 1000
    assert tf.table_max(spark, name) == 1000 and tf.next_id(spark, name) == 1001
    tf.delete_where(spark, name, "id > 990")
    assert tf.table_max(spark, name) == 990


@pytest.mark.parametrize("found", [[], [(None,)], [(None,), (3,), (-4,)], [(-9,)]])
def test_nulls_and_empty_tables_agree(spark, database, found):
    name = f"{database}.t"
    df = spark.createDataFrame(found, "id bigint")
    tf.save_table(df.repartition(2) if found else df, name)
    want = max((r[0] for r in found if r[0] is not None), default=None)
    assert tf.table_max(spark, name) == want
    tf.add_column(spark, name, "more", "bigint")
    assert tf.table_max(spark, name, "more") is None


# -- ids by file --------------------------------------------------------------


def test_ids_by_file_need_no_copy(spark, tmp_path):
    path = f"{tmp_path}/rows"
    spark.range(1000).toDF("k").repartitionByRange(7, "k").sortWithinPartitions("k").write.parquet(path)
    df = spark.read.parquet(path).withColumn("twice", F.col("k") * 2)
    numbered = tf.number_rows(df, by_file=True, start=5, position=1)
    assert numbered.path is None and numbered.rows == 1000
    shown = plan(numbered.frame)
    assert "ShuffleExchange" not in shown and "Exchange hashpartitioning" not in shown
    assert "Exchange rangepartitioning" not in shown and "Sort" not in shown.replace("SortMerge", "")
    assert numbered.frame.columns == ["k", "id", "twice"]
    assert all(r.id == r.k + 5 and r.twice == 2 * r.k for r in numbered.frame.collect())


def test_frames_that_are_not_whole_files_are_refused(spark, tmp_path):
    path = f"{tmp_path}/rows"
    spark.range(100).write.parquet(path)
    read = spark.read.parquet(path).toDF("k")
    with pytest.raises(ValueError):
        tf.number_rows(read.where("k <> 50"), by_file=True)
    with pytest.raises((ValueError, AnalysisException)):
        tf.number_rows(read.unionAll(read), by_file=True)
    with pytest.raises(ValueError):
        tf.number_rows(read, "k", by_file=True)


def test_old_rows_without_order_are_numbered_as_they_stand(spark, database):
    name = f"{database}.t"
    spark.range(300).toDF("k").repartitionByRange(6, "k").sortWithinPartitions("k").write.saveAsTable(name)
    first, count = tf.append_numbered(spark.range(300, 310).toDF("k").coalesce(1), name)
    assert (first, count) == (301, 10)
    assert all(r.id == r.k + 1 for r in spark.table(name).collect())
