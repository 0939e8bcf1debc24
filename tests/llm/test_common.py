from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tableferry.llm.common import finished, join_hot, row_key, stage, staged
from tableferry.llm.line_dedup import drop_shared_lines
from tableferry.llm.queries import QUERIES
from tableferry.session import work_dir


def folders(spark):
    folder = work_dir(spark)
    return {f for f in os.listdir(folder) if f.startswith("tableferry-")} if os.path.isdir(folder) else set()


def test_ids_do_not_run_into_texts(spark):
    pairs = [("a\nb", "c"), ("a", "b\nc"), ("a\nb\nc", ""), ("", "a\nb\nc"), ("1:a", "b"), ("1", ":ab"), (None, "a")]
    df = spark.createDataFrame(pairs, "doc_id string, text string")
    assert df.select(row_key(F.col("doc_id"), F.col("text")).alias("k")).distinct().count() == len(pairs)
    kept = drop_shared_lines(df.where("doc_id in ('a\\nb', 'a')"), min_documents=2).collect()
    assert {(r.doc_id, r.text) for r in kept} == {("a\nb", ""), ("a", "b")}


def test_staged_keeps_the_last_and_errors_keep_nothing(spark):
    before = folders(spark)
    with staged(spark):
        stage(spark.range(3), "one")
        with staged(spark):
            stage(spark.range(4), "two")
            inner = stage(spark.range(5), "three")
        assert inner.count() == 5 and len(folders(spark) - before) == 2
        last = stage(inner, "four")
    assert len(folders(spark) - before) == 1 and last.count() == 5
    with pytest.raises(ValueError), staged(spark):
        stage(spark.range(3), "five")
        raise ValueError
    assert len(folders(spark) - before) == 1


def test_what_stages_nothing_stays_lazy(spark):
    before = folders(spark)
    assert finished(spark, lambda: spark.range(7), "lazy").count() == 7
    assert folders(spark) == before


@pytest.mark.parametrize("name", sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])))
def test_queries_leave_nothing_but_their_result(spark, small, name):
    before = folders(spark)
    QUERIES[name](spark, small).count()
    assert len(folders(spark) - before) <= 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_hot_keys(spark, how):
    """One key holds a third of the rows; others are missing on either side, some are NULL."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, F.col("id") % 4000).alias("k"), "id"
    )
    side = rows.where("k is not null and k % 5 <> 1").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    want = rows.join(side.drop("n"), "k", how)
    found = join_hot(rows, side, "k", "n", how)
    assert found.columns == want.columns
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
