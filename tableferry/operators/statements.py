"""Statements that change a table.

A catalog whose tables take row-level DML runs the statement itself. Plain file
tables do not, so for them the files or partitions with affected rows are written
again, or else the table.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.errors import AnalysisException, UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.text import quoted
from tableferry.sinks.by_file import rewrite_files
from tableferry.sinks.tables import overwrite_partitions, rewrite_table, table_layout
from tableferry.sources.relation import run_query, sql_name


def run_statement(
    spark: SparkSession, sql: str, args: Mapping[str, object] | None = None
) -> DataFrame:
    """Run one statement, whatever it is."""
    return run_query(spark, sql, args)


def _catalog_takes(spark: SparkSession, sql: str) -> bool:
    try:
        spark.sql(sql)
    except (AnalysisException, UnsupportedOperationException) as error:
        if error.getCondition() == "UNSUPPORTED_FEATURE.TABLE_OPERATION":
            return False
        raise
    return True


def _rewrite(
    spark: SparkSession,
    name: str,
    predicate: str,
    change: Callable[[DataFrame], DataFrame],
    moved: Collection[str] = (),
) -> None:
    """Apply a change to the rows of a file table for which the predicate holds.

    Only the files that hold such rows are written again, or the partitions if the
    table has any, unless the change moves rows between partitions or buckets.
    Files that do not number their rows, which are all but Parquet, are written as a
    whole table.
    """
    df = spark.table(sql_name(name))
    layout = table_layout(spark, name)
    if {*layout.partitions, *layout.bucket_columns} & set(moved):
        rewrite_table(change(df), name)
    elif layout.partitions:
        affected = df.where(F.expr(predicate)).select(*map(quoted, layout.partitions)).distinct()
        overwrite_partitions(df, change, affected, name)
    elif layout.provider == "parquet":
        rewrite_files(spark, name, predicate, change)
    else:
        rewrite_table(change(df), name)


def delete_where(spark: SparkSession, name: str, predicate: str) -> None:
    """Delete the rows the predicate holds for; rows where it is NULL stay."""
    if not _catalog_takes(spark, f"DELETE FROM {sql_name(name)} WHERE {predicate}"):
        kept = ~F.coalesce(F.expr(predicate), F.lit(False))
        _rewrite(spark, name, predicate, lambda df: df.where(kept))


def update_where(
    spark: SparkSession, name: str, values: Mapping[str, str], predicate: str = "true"
) -> None:
    """Set columns to SQL expressions, all read from the row as it was."""
    table = sql_name(name)
    assignments = ", ".join(f"`{c}` = {v}" for c, v in values.items())
    if _catalog_takes(spark, f"UPDATE {table} SET {assignments} WHERE {predicate}"):
        return
    types = {f.name: f.dataType for f in spark.table(table).schema.fields}
    changed = {
        c: F.when(F.expr(predicate), F.expr(v).cast(types[c])).otherwise(quoted(c))
        for c, v in values.items()
    }
    _rewrite(spark, name, predicate, lambda df: df.withColumns(changed), moved=values)


def add_column(spark: SparkSession, name: str, column: str, data_type: str) -> None:
    """Add a column at the end; the rows that are there hold NULL."""
    spark.sql(f"ALTER TABLE {sql_name(name)} ADD COLUMNS (`{column}` {data_type})")


def drop_column(spark: SparkSession, name: str, column: str) -> None:
    """Drop a column."""
    table = sql_name(name)
    if column not in spark.table(table).columns:
        raise ValueError(f"the table has no column {column}")
    if not _catalog_takes(spark, f"ALTER TABLE {table} DROP COLUMN `{column}`"):
        rewrite_table(spark.table(table).drop(column), name)
