"""Geometry columns on frames and tables: all rows or none."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.geometry import GEOMETRY, SRID, is_valid, parse_wkt
from tableferry.functions.text import quoted
from tableferry.sinks.tables import rewrite_table
from tableferry.sources.relation import sql_name, table_exists


@dataclass(frozen=True)
class GeometryResult:
    """The frame to go on with, and the rows whose WKT was refused."""

    frame: DataFrame
    errors: DataFrame
    invalid: int


def _require_column(df: DataFrame, wkt_column: str) -> None:
    if not wkt_column:
        raise ValueError("name the column that holds WKT")
    if wkt_column not in df.columns:
        raise ValueError(f"there is no column {wkt_column}")


def add_geometry(
    df: DataFrame, wkt_column: str, geo_type: str = "POINT", srid: int = SRID
) -> GeometryResult:
    """Add a ``geometry`` column from WKT, or leave the frame as it is.

    One bad row refuses the whole column, and a geometry column that was there
    stays untouched. The check reads only the WKT column.
    """
    _require_column(df, wkt_column)
    parsed = parse_wkt(quoted(wkt_column), srid)
    errors = df.where(~is_valid(parsed, geo_type))
    invalid = errors.count()
    return GeometryResult(df if invalid else df.withColumn(GEOMETRY, parsed), errors, invalid)


def add_geometry_column(
    spark: SparkSession, name: str, wkt_column: str, geo_type: str = "POINT", srid: int = SRID
) -> GeometryResult:
    """Fill a table's ``geometry`` column from its WKT column, adding it if need be.

    The WKT is read once: the new rows are written and their bad ones counted in the
    same pass, and only if there are none do they become the table.
    """
    if not table_exists(spark, name):
        raise ValueError(f"there is no table {name}")
    table = spark.table(sql_name(name))
    _require_column(table, wkt_column)
    parsed = parse_wkt(quoted(wkt_column), srid)
    seen = Observation()
    bad = F.count_if(~is_valid(quoted(GEOMETRY), geo_type)).alias("bad")
    filled = table.withColumn(GEOMETRY, parsed).observe(seen, bad)
    # the count comes from the pass that writes the column, before the table changes
    rewrite_table(filled, name, accept=lambda: seen.get["bad"] == 0)
    errors = table.where(~is_valid(parsed, geo_type))
    return GeometryResult(spark.table(sql_name(name)), errors, seen.get["bad"])


def null_geometry(df: DataFrame, table: DataFrame) -> DataFrame:
    """Give the frame an empty geometry if the table has one and the frame has not."""
    types = {f.name: f.dataType for f in table.schema.fields}
    if GEOMETRY not in types or GEOMETRY in df.columns:
        return df
    return df.withColumn(GEOMETRY, F.lit(None).cast(types[GEOMETRY]))
