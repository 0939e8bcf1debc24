"""Batches that are written again."""

from __future__ import annotations

import pytest
from helpers import rows
from pyspark.sql import functions as F

import tableferry as tf


def test_a_batch_is_there_once(spark, database):
    name = f"{database}.t"
    first, second = spark.range(5).toDF("k"), spark.range(5, 9).toDF("k")
    assert tf.append_once(first, name, "a")
    assert not tf.append_once(first, name, "a")
    assert tf.append_once(second, name, "it's b")
    assert not tf.append_once(second, name, "it's b")
    assert rows(spark.table(name).groupBy("batch").count()) == [("a", 5), ("it's b", 4)]


def test_what_a_killed_run_left_is_replaced(spark, database):
    """Some files of the batch are in place and others are not."""
    name = f"{database}.t"
    tf.append_once(spark.range(10).toDF("k"), name, "old")
    whole = spark.range(100, 140).toDF("k")
    tf.save_table(whole.where("k < 113").withColumn("batch", F.lit("new")), name)
    assert tf.append_once(whole, name, "new")
    assert not tf.append_once(whole, name, "new")
    assert sorted(r.k for r in spark.table(name).collect()) == [*range(10), *range(100, 140)]


def test_a_job_that_fails_and_is_repeated(spark, database):
    name = f"{database}.t"
    tf.append_once(spark.range(3).toDF("k"), name, "old")
    failing = spark.range(10, 20).select(F.expr("if(id = 17, raise_error('killed'), id)").cast("long").alias("k"))
    with pytest.raises(Exception, match="killed"):
        tf.append_once(failing, name, "new")
    assert spark.table(name).count() == 3
    assert tf.append_once(spark.range(10, 20).toDF("k"), name, "new")
    assert spark.table(name).count() == 13


def test_ids_and_a_table_without_the_column(spark, database):
    name = f"{database}.t"
    tf.upload(spark.range(4).toDF("k"), name, order_by="k", unique_order=True)
    more = spark.range(4, 7).toDF("k")
    assert tf.append_once(more, name, "x", order_by="k", unique_order=True)
    assert not tf.append_once(more, name, "x", order_by="k", unique_order=True)
    assert sorted((r.id, r.k) for r in spark.table(name).collect()) == [(k + 1, k) for k in range(7)]
    with pytest.raises(ValueError):
        tf.append_once(more.withColumn("Batch", F.lit(1)), name, "y")
