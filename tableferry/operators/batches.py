"""Appends that may be run again: a batch is in the table once, however often it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.functions.text import quoted
from tableferry.operators.ids import OrderBy, append_numbered, find_id_column
from tableferry.operators.statements import add_column, delete_where
from tableferry.sinks.tables import save_table, sql_literal
from tableferry.sources.relation import sql_name, table_exists

BATCH = "batch"


def append_once(
    df: DataFrame,
    table: str,
    batch: str,
    batch_column: str = BATCH,
    order_by: OrderBy = None,
    match: str = "name",
    unique_order: bool = False,
) -> bool:
    """Append the rows of a batch unless they are there. Returns whether it wrote.

    The name of the batch is stored with its rows, in a column that is added if need
    be. A run that was cut off while its files were put in place has left part of the
    rows: they are deleted, which rewrites the files that hold them, and the batch is
    written whole. ``batch`` stands for the same rows in every run. A table with an
    id column gets new ids after all others.
    """
    spark = df.sparkSession
    if batch_column.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the frame has a column {batch_column} already")
    named = df.withColumn(batch_column, F.lit(batch))
    if not table_exists(spark, table):
        save_table(named, table, mode="fail")
        return True
    if batch_column not in spark.table(sql_name(table)).columns:
        add_column(spark, table, batch_column, "string")
    # row groups of other batches are skipped by their statistics
    stored = spark.table(sql_name(table)).where(quoted(batch_column) == batch).count()
    if stored:
        if stored == df.count():
            return False
        delete_where(spark, table, f"`{batch_column}` = {sql_literal(batch)}")
    if find_id_column(spark.table(sql_name(table)).columns) and not find_id_column(df.columns):
        append_numbered(named, table, order_by, match, unique_order)
    else:
        save_table(named, table, match=match)
    return True
