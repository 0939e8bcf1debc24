"""Changes by file, and the one step in which a table takes its new content."""

from __future__ import annotations

import os
import threading
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

import tableferry as tf
from tableferry.sinks import by_file, tables
from tableferry.sinks.tables import rewrite_table, table_location


def files(spark, name):
    """The data files of a table with their time stamps."""
    folder = Path(table_location(spark, name).removeprefix("file:"))
    return {f.name: f.stat().st_mtime_ns for f in folder.iterdir() if f.name.startswith("part-")}


@pytest.fixture
def many(spark, database):
    """100 rows in ten files by k."""
    name = f"{database}.many"
    found = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    found.repartitionByRange(10, "k").sortWithinPartitions("k").write.saveAsTable(name)
    assert len(files(spark, name)) == 10
    return name


def test_delete_leaves_other_files_alone(spark, many):
    before = files(spark, many)
    tf.delete_where(spark, many, "k between 20 and 24 or k = 55")
    after = files(spark, many)
    assert set(after) == set(before)
    assert sum(after[f] != before[f] for f in before) == 2
    assert [r.k for r in spark.table(many).orderBy("k").collect()] == [
        k for k in range(100) if k not in (20, 21, 22, 23, 24, 55)
    ]


def test_update_leaves_other_files_alone(spark, many):
    before = files(spark, many)
    tf.update_where(spark, many, {"v": "v + 100"}, "k = 31")
    after = files(spark, many)
    assert sum(after[f] != before[f] for f in before) == 1
    assert rows(spark.table(many).where("v > 90")) == [(31, 103)]
    assert spark.table(many).count() == 100


def test_a_file_without_rows_goes(spark, many):
    tf.delete_where(spark, many, "k < 30")
    assert len(files(spark, many)) == 7
    tf.delete_where(spark, many, "true")
    assert files(spark, many) == {} and spark.table(many).isEmpty()


def test_nothing_affected_writes_nothing(spark, many):
    before = files(spark, many)
    tf.delete_where(spark, many, "k > 1000 or cast(null as boolean)")
    assert files(spark, many) == before


def test_rows_of_a_file_keep_their_order(spark, many):
    tf.update_where(spark, many, {"v": "0"}, "k % 2 = 0")
    told = spark.table(many).select("k", "_metadata.file_path", "_metadata.row_index").collect()
    for path in {r.file_path for r in told}:
        held = [r.k for r in sorted((r for r in told if r.file_path == path), key=lambda r: r.row_index)]
        assert held == sorted(held)


def test_odd_names_and_nulls(spark, database):
    name = f"{database}.odd"
    df = spark.createDataFrame([(1, None, "x"), (2, "b", None), (None, "c", "z")], "`a.b` int, `__file x` string, _metadata string")
    tf.save_table(df.repartition(3), name)
    tf.delete_where(spark, name, "`a.b` = 1")
    assert rows(spark.table(name)) == [(2, "b", None), (None, "c", "z")]


def test_a_failed_job_changes_no_file(spark, many):
    before = files(spark, many)
    with pytest.raises(Exception, match="bad"):
        tf.update_where(spark, many, {"v": "if(k = 45, raise_error('bad'), v)"}, "k > 40")
    assert files(spark, many) == before and spark.table(many).count() == 100
    folder = Path(table_location(spark, many).removeprefix("file:"))
    assert not [f for f in os.listdir(folder) if f.startswith("_new")]


def test_a_failed_replacement_names_what_is_left(spark, many, monkeypatch):
    done = []

    def replace(spark, folder, path, put=by_file._replace):
        if done:
            raise OSError("no more")
        done.append(path)
        put(spark, folder, path)

    monkeypatch.setattr(by_file, "_replace", replace)
    with pytest.raises(OSError) as caught:
        tf.delete_where(spark, many, "k in (5, 95)")
    assert "_new-" in caught.value.__notes__[0]
    monkeypatch.undo()
    tf.delete_where(spark, many, "k in (5, 95)")  # the same again ends it
    assert spark.table(many).count() == 98


def test_buckets_are_not_broken(spark, database):
    name = f"{database}.bucketed"
    spark.range(40).withColumn("v", F.lit(1)).write.bucketBy(4, "id").saveAsTable(name)
    tf.update_where(spark, name, {"id": "id + 1000"}, "id < 10")
    joined = spark.table(name).join(spark.table(name).select("id"), "id")
    assert joined.count() == 40 and tables.table_layout(spark, name).buckets == 4
    tf.delete_where(spark, name, "id >= 1000")
    assert spark.table(name).where("id = 20").count() == 1 and spark.table(name).count() == 30


# -- the switch ---------------------------------------------------------------


@pytest.mark.parametrize("change", ["replace", "update", "grow", "number"])
def test_a_reader_never_misses_the_table(spark, database, change, monkeypatch):
    """Between any two statements the table is there, with all old or all new rows."""
    name = f"{database}.t"
    tf.save_table(spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string"), name)
    seen = []

    def watched(sql, *args, run=spark.sql, **named):
        seen.append(sorted(r.k for r in run(f"SELECT k FROM {name}").collect()))
        return run(sql, *args, **named)

    monkeypatch.setattr(spark, "sql", watched)
    table = spark.table(name)
    if change == "replace":
        tf.save_table(table.withColumn("k", F.col("k") + 10), name, mode="replace")
    elif change == "update":
        rewrite_table(table.withColumn("k", F.col("k") + 10), name)
    elif change == "grow":
        rewrite_table(table.withColumn("k", F.col("k") + 10).withColumn("w", F.lit(1)), name)
    else:
        tf.upload(spark.createDataFrame([(11, "c")], "k bigint, v string"), name)
    monkeypatch.undo()
    spark.catalog.refreshTable(name)
    new = sorted(r.k for r in spark.table(name).collect())
    assert new == ([1, 2, 11] if change == "number" else [11, 12])
    assert all(found in ([1, 2], new) for found in seen) and [1, 2] in seen


@pytest.mark.parametrize("step", ["CREATE", "ADD COLUMNS", "SET LOCATION"])
def test_a_failure_at_any_step_leaves_the_old_rows(spark, database, step, monkeypatch):
    name = f"{database}.t"
    tf.save_table(spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string"), name)
    grown = spark.table(name).withColumn("w", F.lit(1))
    if step == "CREATE":
        grown = grown.withColumn("w", F.expr("if(k = 2, raise_error('stop'), 1)"))

    def failing(sql, *args, run=spark.sql, **named):
        if step in sql:
            raise RuntimeError("stop")
        return run(sql, *args, **named)

    monkeypatch.setattr(spark, "sql", failing)
    with pytest.raises(Exception, match="stop"):
        rewrite_table(grown, name)
    monkeypatch.undo()
    assert [tuple(r)[:2] for r in rows(spark.table(name))] == [(1, "a"), (2, "b")]
    folder = Path(table_location(spark, name).removeprefix("file:")).parent
    assert [f for f in os.listdir(folder) if f.startswith("t_")] == []


def test_the_old_folder_goes_and_the_table_can_be_dropped(spark, database):
    name = f"{database}.t"
    tf.save_table(spark.range(5), name)
    first = table_location(spark, name)
    rewrite_table(spark.table(name).withColumn("id", F.col("id") * 2), name)
    second = table_location(spark, name)
    rewrite_table(spark.table(name).withColumn("id", F.col("id") + 1), name)
    assert rows(spark.table(name)) == [(1,), (3,), (5,), (7,), (9,)]
    for gone in (first, second):
        assert not os.path.exists(gone.removeprefix("file:"))
    last = table_location(spark, name)
    tf.save_table(spark.range(3), name)  # an append goes to the new folder
    assert spark.table(name).count() == 8
    spark.sql(f"DROP TABLE {name}")
    assert not os.path.exists(last.removeprefix("file:"))
    tf.save_table(spark.range(2), name)
    assert spark.table(name).count() == 2


def test_a_dropped_column_keeps_the_other_rows(spark, database):
    name = f"{database}.t"
    tf.save_table(spark.createDataFrame([(1, "a")], "k bigint, v string"), name)
    tf.drop_column(spark, name, "v")
    assert spark.table(name).columns == ["k"] and rows(spark.table(name)) == [(1,)]


# -- geometry -----------------------------------------------------------------


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = run()
        return found, len(spark.sparkContext._jsc.sc().statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


def test_geometry_is_checked_in_the_pass_that_writes_it(spark, database):
    """Adding a checked geometry takes no more jobs than writing any column does."""
    name, other = f"{database}.places", f"{database}.others"
    found = [(i, f"POINT ({i} {i})") for i in range(50)]
    for table in (name, other):
        tf.save_table(spark.createDataFrame(found, "k int, wkt string"), table)
    result, checked = jobs_of(spark, "checked", lambda: tf.add_geometry_column(spark, name, "wkt"))
    plain = spark.table(other).withColumn("geometry", F.upper("wkt"))
    _, written = jobs_of(spark, "written", lambda: rewrite_table(plain, other))
    assert result.invalid == 0 and checked == written
    assert spark.table(name).where("geometry.coords[0][0].x = k").count() == 50


def test_one_bad_row_refuses_the_column(spark, database):
    name = f"{database}.places"
    tf.save_table(spark.createDataFrame([(1, "POINT (1 1)"), (2, "POINT (1")], "k int, wkt string"), name)
    before = files(spark, name)
    result = tf.add_geometry_column(spark, name, "wkt")
    assert result.invalid == 1 and [r.k for r in result.errors.collect()] == [2]
    assert spark.table(name).columns == ["k", "wkt"] and files(spark, name) == before
    assert result.frame.columns == ["k", "wkt"]


# -- ids of several writers ---------------------------------------------------


def test_two_writers_share_no_id(spark, database):
    name = f"{database}.shared"
    tf.upload(spark.range(10).toDF("k"), name, order_by="k", unique_order=True)
    failed = []

    def write(base):
        try:
            for part in range(3):
                df = spark.range(base + part * 20, base + part * 20 + 20).toDF("k")
                tf.append_numbered(df, name, "k", unique_order=True, reserve=lambda n: tf.reserve_ids(spark, name, n))
        except Exception as error:
            failed.append(error)

    writers = [threading.Thread(target=write, args=(base,)) for base in (1000, 2000)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert not failed
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(1, 131))


def test_an_abandoned_block_is_a_gap(spark, database):
    name = f"{database}.gap"
    tf.upload(spark.range(3).toDF("k"), name)
    assert tf.reserve_ids(spark, name, 5) == 4
    assert tf.reserve_ids(spark, name, 2) == 9
    tf.append_numbered(spark.range(2).toDF("k"), name, reserve=lambda n: tf.reserve_ids(spark, name, n))
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 3, 11, 12]
