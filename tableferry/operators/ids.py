"""Contiguous row ids, their continuation across appends, and key checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.text import quoted
from tableferry.session import fresh_path, remove_path
from tableferry.sinks.tables import match_columns, rewrite_table, table_layout, table_location
from tableferry.sources.relation import TableSource, in_session_catalog, sql_name

ID = "id"
OrderBy = Sequence[str | Column] | str | Column | None

_NEXT_ID = "next_id"  # table property
_ROW, _TIE, _SALT, _PATH = "__row", "__tie", "__salt", "__path"
_PART_BITS = 33  # monotonically_increasing_id: partition above, row in partition below


@dataclass(frozen=True)
class Numbered:
    """A numbered frame that reads its rows from ``path``, or from where they came if that is None."""

    frame: DataFrame
    rows: int
    path: str | None = None

    def remove_staged(self) -> None:
        """Delete the copy of the rows, if there is one; the frame cannot be read after that."""
        if self.path:
            remove_path(self.frame.sparkSession, self.path)


def _order_columns(order_by: OrderBy) -> list[Column]:
    if order_by is None:
        return []
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    return [quoted(c) if isinstance(c, str) else c for c in order_by]


def _hashable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _hashable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_hashable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def _salted(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add a hash of the row, and a salt that tells equal copies of a row apart.

    The salt is the row's place after a sort inside its partition, so a repeated
    task deals the same salts to the same rows.
    """
    row = [quoted(f.name) for f in df.schema.fields if _hashable(f.dataType)]
    return (
        df.withColumn(_TIE, F.xxhash64(F.lit(0), *row))
        .sortWithinPartitions(_TIE, *order)
        .withColumn(_SALT, F.monotonically_increasing_id())
    )


def _range_sorted(df: DataFrame, order: list[Column], unique_order: bool) -> DataFrame:
    """Sort globally by range partitions, each of which fits in a task.

    Equal keys would all land in one partition, so the hash and the salt of the
    row follow the key.
    """
    if unique_order:
        return df.repartitionByRange(*order).sortWithinPartitions(*order)
    keys = [*order, F.col(_TIE), F.col(_SALT)]
    salted = _salted(df, order).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return salted.drop(_TIE, _SALT)


def number_rows(
    df: DataFrame,
    order_by: OrderBy = None,
    start: int | Callable[[int], int] = 1,
    id_column: str = ID,
    position: int = 0,
    unique_order: bool = False,
    by_file: bool = False,
) -> Numbered:
    """Number the rows ``start``, ``start + 1``, ... without gaps.

    ``start`` may be a function, which is then asked with the number of rows.

    The rows are stored once in the shared folder together with their place in
    the partition that wrote them. The counts per partition then give each
    partition its offset. No task sees more than its own partition, and the
    driver sees one count per partition. Without ``order_by`` the rows keep the
    frame's order and nothing is shuffled. Pass ``unique_order=True`` when the
    order has no ties; it saves the work that keeps ties apart.

    With ``by_file`` the frame is a read of whole Parquet files, and the rows are
    numbered as they stand in them, file after file by name. A row's place in its
    file and the number of rows of the files before are its id, so that nothing is
    copied or shuffled. Frames that lack rows of a file or repeat them are refused.
    """
    spark = df.sparkSession
    if id_column.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the frame has a column {id_column} already")
    order = _order_columns(order_by)
    if by_file:
        if order:
            raise ValueError("rows are numbered by file or by an order, not by both")
        return _numbered_by_file(df, start, id_column, position)
    ordered = _range_sorted(df, order, unique_order) if order else df
    path = fresh_path(spark, "rows")
    stored = ordered.withColumn(_ROW, F.monotonically_increasing_id())
    stored.write.parquet(path)
    stored = spark.read.schema(stored.schema).parquet(path)

    part = F.shiftright(_ROW, _PART_BITS)
    counts = stored.groupBy(part.alias("part")).count().collect()
    offsets, total = _offsets(sorted(counts), start)
    # One row per partition that wrote rows, so the broadcast is bounded by the task count.
    firsts = spark.createDataFrame(offsets, f"{_TIE} bigint, {_SALT} bigint")
    in_part = F.col(_ROW).bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    joined = stored.join(F.broadcast(firsts), part == F.col(_TIE))
    return Numbered(_with_id(joined, df.columns, F.col(_SALT) + in_part, id_column, position), total, path)


def _offsets(
    counts: list[tuple], start: int | Callable[[int], int]
) -> tuple[list[tuple], int]:
    """The first id of each part that has so many rows, and the rows of all."""
    total = sum(count for _, count in counts)
    following, offsets = start(total) if callable(start) else start, []
    for part, count in counts:
        offsets.append((part, following))
        following += count
    return offsets, total


def _with_id(
    joined: DataFrame, columns: list[str], number: Column, id_column: str, position: int
) -> DataFrame:
    before, after = ([quoted(c) for c in part] for part in (columns[:position], columns[position:]))
    return joined.select(*before, number.alias(id_column), *after)


def _numbered_by_file(df: DataFrame, start: int | Callable[[int], int], id_column: str, position: int) -> Numbered:
    told = df.metadataColumn("_metadata")
    path, row = told["file_path"], told["row_index"]
    counts = df.groupBy(path.alias(_PATH)).agg(F.count(F.lit(1)), F.max(row) + 1).collect()
    if any(rows != last for _, rows, last in counts):
        raise ValueError("the frame does not hold each row of its files once")
    offsets, total = _offsets(sorted((name, rows) for name, rows, _ in counts), start)
    # One row per file, all of which the driver has listed for the scan.
    firsts = df.sparkSession.createDataFrame(offsets, f"{_PATH} string, {_SALT} bigint")
    placed = df.withColumns({_ROW: row, _TIE: path})
    joined = placed.join(F.broadcast(firsts), F.col(_TIE) == F.col(_PATH))
    return Numbered(_with_id(joined, df.columns, F.col(_SALT) + F.col(_ROW), id_column, position), total)


def assign_ids(df: DataFrame, order_by: OrderBy = None, start: int = 1, **options) -> DataFrame:
    """The frame of ``number_rows``."""
    return number_rows(df, order_by, start, **options).frame


def find_id_column(names: Iterable[str]) -> str | None:
    """The first column called id, in any case."""
    return next((n for n in names if n.lower() == ID), None)


def max_value(df: DataFrame, column: str) -> DataFrame:
    """One row, ``max_id``; NULL for an empty frame. Reads only this column."""
    return df.agg(F.max(quoted(column)).alias("max_id"))


def _noted_next_id(spark: SparkSession, name: str) -> int | None:
    if not in_session_catalog(spark, name):
        return None
    shown = spark.sql(f"SHOW TBLPROPERTIES {sql_name(name)}").where(F.col("key") == _NEXT_ID).first()
    return int(shown["value"]) if shown else None


def note_next_id(spark: SparkSession, name: str, following: int) -> None:
    """Keep the next id with the table, as a place from which to look for the largest one."""
    if in_session_catalog(spark, name):
        spark.sql(f"ALTER TABLE {sql_name(name)} SET TBLPROPERTIES ('{_NEXT_ID}' = '{following}')")


def footer_max(spark: SparkSession, path: str, schema: T.StructType, column: str = ID) -> DataFrame:
    """One row, ``max_id``, from the footers of Parquet files; no column is read.

    It fails where a footer does not tell the maximum, as for a row group of NULLs.
    """
    own = spark.newSession()  # the settings hold for this read only
    sources = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in sources if s != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return max_value(own.read.schema(schema).parquet(path), column)


def _told_by_footers(
    spark: SparkSession, path: str, schema: T.StructType, column: str
) -> int | None:
    try:
        return footer_max(spark, path, schema, column).first()[0]
    except (PySparkException, Py4JJavaError):
        # a row group of NULLs, or a file without the column: reading it tells the rest
        return None


def table_max(
    spark: SparkSession, name: str, column: str = ID, source: TableSource | None = None
) -> int | None:
    """The largest id of a table; over JDBC the database computes it.

    Of a Parquet table it is read from the footers of its files, if these tell it.
    Elsewhere the id noted by the last upload is a place to start from: ids from
    there on are looked up first, which skips all row groups that hold smaller ones.
    If those rows are gone, the whole column is read.
    """
    if source is not None:
        query = f"(SELECT max({column}) AS max_id FROM {name}) tmp"
        options = source.jdbc_options(dbtable=query)
        return spark.read.format("jdbc").options(**options).load().first()[0]
    table = spark.table(sql_name(name))
    if in_session_catalog(spark, name):
        layout = table_layout(spark, name)
        if layout.provider == "parquet" and not layout.partitions:
            told = _told_by_footers(spark, table_location(spark, name), table.schema, column)
            if told is not None:
                return told
    noted = _noted_next_id(spark, name)
    if noted is not None:
        recent = max_value(table.where(quoted(column) >= noted - 1), column).first()[0]
        if recent is not None:
            return recent
    return max_value(table, column).first()[0]


def next_id(
    spark: SparkSession, name: str, column: str = ID, source: TableSource | None = None
) -> int:
    """The id that the next appended row gets."""
    return (table_max(spark, name, column, source) or 0) + 1


def append_numbered(
    df: DataFrame,
    name: str,
    order_by: OrderBy = None,
    match: str = "name",
    unique_order: bool = False,
    old_order_by: OrderBy = None,
    reserve: Callable[[int], int] | None = None,
) -> tuple[int, int]:
    """Append rows to a table, continuing its ids. Returns (first new id, new rows).

    * ids present: the new rows follow the largest one; NULL ids stay NULL.
    * an id column that is NULL throughout: the old rows are numbered first.
    * no id column: one is added at the end, and the old rows are numbered first.

    The old rows are numbered by ``old_order_by``, or ``order_by`` if it is not
    given, or else as they stand in the files of the table. ``reserve`` gives the
    first new id for a number of rows; pass ``reserve_ids`` of a table that several
    writers append to.
    """
    spark = df.sparkSession
    table = spark.table(sql_name(name))
    id_column = find_id_column(table.columns)
    if id_column is None:
        return _append_with_backfill(
            df, table, name, ID, len(table.columns), order_by, old_order_by, match, unique_order
        )
    position = table.columns.index(id_column)
    data = table.drop(id_column)
    highest = table_max(spark, name, id_column)
    if highest is None and not table.isEmpty():
        return _append_with_backfill(
            df, data, name, id_column, position, order_by, old_order_by, match, unique_order
        )
    taken = []

    def first_id(count: int) -> int:
        taken.append(reserve(count) if reserve else (highest or 0) + 1)
        return taken[0]

    new = number_rows(
        match_columns(df, data, match), order_by, first_id, id_column, position, unique_order
    )
    first = taken[0]
    match_columns(new.frame, table).write.insertInto(sql_name(name))
    new.remove_staged()
    note_next_id(spark, name, first + new.rows)
    return first, new.rows


def _append_with_backfill(
    df, data, name, id_column, position, order_by, old_order_by, match, unique_order
) -> tuple[int, int]:
    spark = df.sparkSession
    arranged = match_columns(df, data, match)
    old_order = order_by if old_order_by is None else old_order_by
    in_files = old_order is None and in_session_catalog(spark, name)
    in_files = in_files and table_layout(spark, name).provider == "parquet"
    old = number_rows(data, old_order, 1, id_column, position, unique_order, by_file=in_files)
    new = number_rows(arranged, order_by, old.rows + 1, id_column, position, unique_order)
    rewrite_table(old.frame.unionByName(new.frame), name)
    old.remove_staged()
    new.remove_staged()
    note_next_id(spark, name, old.rows + 1 + new.rows)
    return old.rows + 1, new.rows


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat or hold a NULL, with their row count ``n``.

    Counts are combined before the shuffle, so a hot key costs one row per task.
    """
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | quoted(key).isNull()
    counted = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") > 1) | any_null)
