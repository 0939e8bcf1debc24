"""Uploads: clean, number, check and write a frame in one go."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.geometry import GEOMETRY, is_valid, parse_wkt, to_wkt
from tableferry.functions.names import clean_name, clean_names, distinct_names
from tableferry.functions.text import empty_as_null as blank_to_null
from tableferry.functions.text import escape_quotes, map_text_columns, quoted
from tableferry.functions.types import apply_type_map
from tableferry.operators.geocolumn import add_geometry, add_geometry_column, null_geometry
from tableferry.operators.ids import (
    OrderBy,
    append_numbered,
    find_id_column,
    note_next_id,
    number_rows,
)
from tableferry.session import remove_path, removing_staged
from tableferry.sinks.tables import (
    in_order,
    literal_rows,
    save_mode,
    save_table,
    staged_in_order,
    staged_rows,
)
from tableferry.sources.files import read_csv, read_json
from tableferry.sources.relation import TableSource, sql_name, table_exists
from tableferry.sources.workbooks import read_excel


_PLACE = "__place"


@dataclass(frozen=True)
class Report:
    """What an upload did. ``bad_geometry`` holds the rows whose WKT was refused."""

    table: str
    written: bool
    first_id: int | None = None
    next_id: int | None = None
    bad_geometry: DataFrame | None = None


def _cleaned_order(df: DataFrame, cleaned: DataFrame, order_by: OrderBy) -> OrderBy:
    if order_by is None or isinstance(order_by, Column):
        return order_by
    new_names = dict(zip(df.columns, cleaned.columns))
    listed = [order_by] if isinstance(order_by, str) else order_by
    return [new_names.get(c, c) if isinstance(c, str) else c for c in listed]


def upload(
    df: DataFrame,
    table: str,
    mode: str = "append",
    add_id: bool = True,
    order_by: OrderBy = None,
    unique_order: bool = False,
    escape: bool = False,
    clean: bool = True,
    empty_as_null: bool = True,
    wkt_column: str = "",
    geo_type: str = "POINT",
    match: str = "name",
    replace_id: bool = False,
    by_file: bool = False,
) -> Report:
    """Write a frame to a catalog table with ids, clean names and geometry.

    The save mode is decided against the table as it was before the call. A new
    or replaced table gets ids from 1; an append continues them. A bad geometry
    refuses the geometry column, not the rows. With ``by_file``, for a frame that
    reads whole Parquet files, a new table's ids follow the files without a copy.
    """
    spark = df.sparkSession
    mode = save_mode(mode)
    exists = table_exists(spark, table)
    if exists and mode == "fail":
        raise ValueError(f"table {table} exists already")
    if exists and mode == "ignore":
        return Report(table, written=False)

    frame, wkt = df, wkt_column
    if clean:
        frame = clean_names(df)
        wkt = dict(zip(df.columns, frame.columns)).get(wkt_column, wkt_column)
        order_by = _cleaned_order(df, frame, order_by)
    taken = find_id_column(frame.columns)
    if add_id and taken is not None:
        if not replace_id:
            raise ValueError(f"the frame has a column {taken}; pass replace_id=True to renumber")
        frame = frame.drop(taken)
    if escape:
        frame = escape_quotes(frame)
    if empty_as_null:
        frame = blank_to_null(frame)

    appending = exists and mode == "append"
    table_has_geometry = appending and GEOMETRY in spark.table(sql_name(table)).columns
    if table_has_geometry and not wkt_column:
        frame = null_geometry(frame, spark.table(sql_name(table)))
    # A new table's rows are stored with their ids first, so the check of the WKT
    # reads the stored rows and not the source again.
    numbered = None
    if add_id and not appending:
        numbered = number_rows(frame, order_by, unique_order=unique_order, by_file=by_file)
        frame = numbered.frame
    bad_geometry = None
    staged = None
    if wkt_column and (table_has_geometry or not appending):
        if numbered is None:  # the check and the table must see the same rows
            frame, staged = staged_in_order(frame) if order_by is None else staged_rows(frame)
        checked = add_geometry(frame, wkt, geo_type)
        frame, bad_geometry = checked.frame, checked.errors if checked.invalid else None
        if table_has_geometry:
            frame = null_geometry(frame, spark.table(sql_name(table)))

    first = following = None
    if numbered is not None:
        save_table(frame, table, mode)
        first, following = 1, numbered.rows + 1
        note_next_id(spark, table, following)
        if bad_geometry is None:
            numbered.remove_staged()
    elif add_id:
        first, rows = append_numbered(frame, table, order_by, match, unique_order)
        following = first + rows
    else:
        save_table(frame, table, mode, match)

    if staged and bad_geometry is None:
        remove_path(spark, staged)

    if wkt_column and appending and not table_has_geometry:
        result = add_geometry_column(spark, table, wkt, geo_type)
        bad_geometry = result.errors if result.invalid else None
    return Report(table, True, first, following, bad_geometry)


def upload_typed(
    df: DataFrame,
    table: str,
    geometry_column: str = "",
    check: bool = True,
    order_by: OrderBy = None,
    unique_order: bool = False,
) -> Report:
    """Append to a table of bigint, real, text and geometry columns with an id.

    Text loses back-slashes and square brackets; with ``check`` a double quote
    becomes a single one. One bad geometry refuses the upload.
    """
    spark, staged = df.sparkSession, None
    names = distinct_names(clean_name(c, lower=False) for c in df.columns)
    frame = df.toDF(*names)
    geometry = dict(zip(df.columns, names)).get(geometry_column, geometry_column)
    order = _cleaned_order(df, frame, order_by)
    if geometry_column:
        if geometry not in names:
            raise ValueError(f"there is no column {geometry_column}")
        # parsed once, then checked and written from there
        parsed = frame.withColumn(geometry, parse_wkt(quoted(geometry)))
        frame, staged = staged_in_order(parsed) if order_by is None else staged_rows(parsed)
        if not frame.where(~is_valid(quoted(geometry))).isEmpty():
            remove_path(spark, staged)
            raise ValueError(f"column {geometry_column} holds malformed WKT")
    typed = apply_type_map(frame, keep=(geometry,))

    def plain(cell: Column) -> Column:
        # translate() maps by place: '"' to "'", the others to nothing
        return F.translate(cell, '"\\[]', "'" if check else "")

    report = upload(
        map_text_columns(typed, plain),
        table,
        order_by=order,
        unique_order=unique_order,
        clean=False,
        empty_as_null=False,
    )
    if staged:
        remove_path(spark, staged)
    return report


def upload_lite(df: DataFrame, table: str, mode: str = "append", clean: bool = False) -> bool:
    """Write a frame without an id, with cleaned names if asked."""
    return save_table(clean_names(df) if clean else df, table, mode)


def upload_geo(
    df: DataFrame,
    table: str,
    mode: str = "append",
    geometry_column: str = GEOMETRY,
    source: TableSource | None = None,
) -> bool:
    """Write a frame with a geometry column.

    A catalog table stores the struct. A database gets EWKT text, which its
    geometry type reads when the URL sets ``stringtype=unspecified``.
    """
    if geometry_column not in df.columns:
        raise ValueError(f"there is no column {geometry_column}")
    if source is not None:
        text = to_wkt(quoted(geometry_column), with_srid=True)
        df = df.withColumn(geometry_column, text)
    return save_table(df, table, mode, source=source)


def insert_values(
    spark: SparkSession,
    table: str,
    columns: str | Sequence[str],
    values: str | Sequence[Sequence[object]],
) -> None:
    """Insert literal rows; columns not named hold NULL and an id is assigned."""
    rows = literal_rows(spark, columns, values)
    has_id = find_id_column(spark.table(sql_name(table)).columns) is not None
    if has_id and find_id_column(rows.columns) is None:
        append_numbered(rows, table)
    else:
        save_table(rows, table)


def load_csv(
    spark: SparkSession,
    path: str,
    table: str,
    mode: str = "fail",
    reader: Mapping[str, object] | None = None,
    **options,
) -> Report:
    """Read CSV and upload it. ``reader`` goes to ``read_csv``, the other options to ``upload``.

    A schema, or ``line_breaks=False`` where no cell holds one, saves passes over the text.
    """
    with removing_staged(spark):
        placed = read_csv(spark, path, place=_PLACE, **(reader or {}))
        return _upload_placed(placed, table, mode, options)


def load_json(
    spark: SparkSession, path: str, table: str, mode: str = "fail", layout: str = "auto", **options
) -> Report:
    """Read JSON with inferred types and upload it."""
    with removing_staged(spark):
        placed = read_json(spark, path, layout, place=_PLACE)
        return _upload_placed(placed, table, mode, options)


def _upload_placed(placed: DataFrame, table: str, mode: str, options: dict) -> Report:
    """Upload the records of files; without another order they are numbered as they stand there."""
    if options.get("add_id", True) and options.get("order_by") is None:
        placed = in_order(placed, _PLACE)
    return upload(placed.drop(_PLACE), table, mode, **options)


def load_excel(spark: SparkSession, path: str, table: str, mode: str = "fail", **options) -> Report:
    """Read a folder of workbooks with inferred types and upload it."""
    with removing_staged(spark):
        return upload(read_excel(spark, path), table, mode, **options)
