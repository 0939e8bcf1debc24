"""Write frames to tables with explicit save modes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import islice
from operator import and_, or_

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.geometry import GEOMETRY_DDL
from tableferry.functions.text import quoted
from tableferry.session import delete_folder, fresh_path, remove_path
from tableferry.sources.relation import (
    TableSource,
    in_session_catalog,
    sql_name,
    table_exists,
)

MODES = ("append", "replace", "overwrite", "fail", "error", "errorifexists", "ignore")


def save_mode(mode: str) -> str:
    """Fold the spellings of a mode into append, replace, fail or ignore."""
    if mode not in MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {', '.join(MODES)}")
    return {"overwrite": "replace", "error": "fail", "errorifexists": "fail"}.get(mode, mode)


def match_columns(df: DataFrame, table: DataFrame, match: str = "name") -> DataFrame:
    """Line a frame up with a table's columns, by name or by position.

    By name, columns the frame lacks become NULL and columns the table lacks
    are refused. By position, the counts must agree.
    """
    fields = table.schema.fields
    if match == "position":
        if len(df.columns) != len(fields):
            raise ValueError(f"{len(df.columns)} columns do not fit a table of {len(fields)}")
        return df.toDF(*table.columns)
    if match != "name":
        raise ValueError("match columns by 'name' or by 'position'")
    have = {c.lower(): c for c in df.columns}
    unknown = sorted(set(have) - {f.name.lower() for f in fields})
    if unknown:
        raise ValueError(f"the table has no column {', '.join(unknown)}")
    return df.select(
        [
            quoted(have[f.name.lower()]).alias(f.name)
            if f.name.lower() in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "append",
    match: str = "name",
    source: TableSource | None = None,
    **options: object,
) -> bool:
    """Write a frame to a table. Returns False when *ignore* left it alone.

    Options go to the writer; over JDBC the useful ones are ``numPartitions`` (how
    many connections write at once), ``batchsize`` and ``truncate`` (a replaced
    table keeps its definition).
    """
    mode = save_mode(mode)
    if source is not None:
        jdbc_mode = {"replace": "overwrite", "fail": "errorifexists"}.get(mode, mode)
        jdbc = source.jdbc_options(dbtable=name, **options)
        df.write.format("jdbc").options(**jdbc).mode(jdbc_mode).save()
        return True
    spark = df.sparkSession
    if not table_exists(spark, name):
        Layout().save(df, name, **options)
        return True
    if mode == "fail":
        raise ValueError(f"table {name} exists already")
    if mode == "ignore":
        return False
    if mode == "replace":
        own = table_layout(spark, name)
        if own.partitions or not _only_grows(df, spark.table(sql_name(name))):
            kept = own.partitions if set(own.partitions) <= set(df.columns) else ()
            rewrite_table(df, name, Layout(partitions=kept))
        else:
            rewrite_table(df, name)
        return True
    match_columns(df, spark.table(sql_name(name)), match).write.insertInto(sql_name(name))
    return True


def _sibling(name: str, label: str) -> str:
    *parents, last = name.replace("`", "").split(".")
    return ".".join([*parents, f"{last}__{label}_{uuid.uuid4().hex[:12]}"])


def _rename(spark: SparkSession, name: str, new_name: str) -> None:
    target = ".".join(new_name.split(".")[-2:])
    spark.sql(f"ALTER TABLE {sql_name(name)} RENAME TO {sql_name(target)}")


def rewrite_table(
    df: DataFrame,
    name: str,
    layout: Layout | None = None,
    accept: Callable[[], bool] = lambda: True,
) -> None:
    """Replace a table's content by a frame that may read the table itself.

    The new content is written whole first, so a failed job leaves the old table
    as it was. An unpartitioned table then points to the folder of the new content,
    in one step. Only if columns go or change, for which the catalog has no such
    step, is the new table renamed into place. In a partitioned table the partitions
    are overwritten and those without rows dropped; if columns go or change it is
    dropped and saved again, from the staged rows. A table with a location is
    overwritten there, which takes the columns that it has. The layout stays unless
    another one is given. ``accept`` is asked once the new content is written; if it
    says no, the table stays as it was.
    """
    spark = df.sparkSession
    name = name.replace("`", "")
    own = table_layout(spark, name)
    layout = layout or own
    table = spark.table(sql_name(name))
    if own.location:
        if df.columns != table.columns:
            raise ValueError(f"the columns of {name} cannot change, as it has a location of its own")
        rows, path = staged_rows(df)
        if accept():
            rows.write.insertInto(sql_name(name), overwrite=True)
        remove_path(spark, path)
    elif own.partitions or layout.partitions:
        rows, path = staged_rows(df)
        kinds = dict(rows.dtypes)
        if not accept():
            pass
        elif layout.partitions == own.partitions and all(kinds.get(c) == t for c, t in table.dtypes):
            affected = table.select(*map(quoted, own.partitions)).distinct()
            for column in (c for c in rows.columns if c not in table.columns):
                spark.sql(f"ALTER TABLE {sql_name(name)} ADD COLUMNS (`{column}` {kinds[column]})")
            columns = spark.table(sql_name(name)).columns
            _replace_partitions(rows.select(*map(quoted, columns)), affected, name, path)
        else:
            spark.sql(f"DROP TABLE {sql_name(name)}")
            try:
                layout.save(rows, name)
            except Exception as error:
                error.add_note(f"the rows of {name} are in {path}")
                raise
        remove_path(spark, path)
    elif layout == own and in_session_catalog(spark, name) and _only_grows(df, table):
        _switch(df, name, own, accept)
    else:
        staged, old = _sibling(name, "new"), _sibling(name, "old")
        layout.save(df, staged)
        if not accept():
            spark.sql(f"DROP TABLE {sql_name(staged)}")
            return
        _rename(spark, name, old)
        try:
            _rename(spark, staged, name)
        except Exception:
            _rename(spark, old, name)
            raise
        spark.sql(f"DROP TABLE {sql_name(old)}")


def _only_grows(df: DataFrame, table: DataFrame) -> bool:
    """Whether the frame has the columns of the table, in order, and maybe more after them."""
    return df.dtypes[: len(table.columns)] == table.dtypes


def _switch(df: DataFrame, name: str, layout: Layout, accept: Callable[[], bool]) -> None:
    """Write the frame to a new folder beside the table's, and let the table point there.

    The table is there at every moment. New columns are added before the switch and
    hold NULL until then. A failure at any step leaves the old rows.
    """
    spark = df.sparkSession
    old = table_location(spark, name)
    *_, last = name.split(".")
    new = f"{old.rsplit('/', 1)[0]}/{last}__{uuid.uuid4().hex[:12]}"
    sibling = _sibling(name, "new")
    try:
        layout.save(df, sibling, path=new)  # a table with a path keeps its files when dropped
        kinds = spark.table(sql_name(sibling)).dtypes
        spark.sql(f"DROP TABLE {sql_name(sibling)}")
        if not accept():
            delete_folder(spark, new)
            return
        for column, kind in kinds[len(spark.table(sql_name(name)).columns) :]:
            spark.sql(f"ALTER TABLE {sql_name(name)} ADD COLUMNS (`{column}` {kind})")
        spark.sql(f"ALTER TABLE {sql_name(name)} SET LOCATION {sql_literal(new)}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {sql_name(sibling)}")
        delete_folder(spark, new)
        raise
    spark.catalog.refreshTable(sql_name(name))
    delete_folder(spark, old)


def staged_rows(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows as stored in the shared folder, and where."""
    path = fresh_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def in_order(df: DataFrame, column: str) -> DataFrame:
    """The frame in the order of a column, so that what numbers its rows as they come follows it."""
    return df.repartitionByRange(quoted(column)).sortWithinPartitions(quoted(column))


def staged_in_order(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows as stored, in the order of the frame; stored files come back in another one."""
    rows, path = staged_rows(df.withColumn("__order", F.monotonically_increasing_id()))
    return in_order(rows, "__order").drop("__order"), path


def _in_partitions(df: DataFrame, partitions: DataFrame, how: str) -> DataFrame:
    """The rows of the frame that lie in the partitions, or not; NULL is a partition too."""
    columns = partitions.columns
    same = reduce(and_, (df[c].eqNullSafe(partitions[c]) for c in columns))
    if how == "left_anti":
        return df.join(partitions, same, how)
    # Plain equality lets Spark skip the other partitions' files.
    some_null = reduce(or_, (quoted(c).isNull() for c in columns))
    full = df.where(~some_null).join(partitions.where(~some_null), columns, how)
    full = full.select(*map(quoted, df.columns))  # the join puts its columns first
    nulls = partitions.where(some_null)
    if nulls.isEmpty():
        return full
    same = reduce(and_, (df[c].eqNullSafe(nulls[c]) for c in columns))
    return full.unionByName(df.where(some_null).join(nulls, same, how))


def overwrite_partitions(
    df: DataFrame,
    change: Callable[[DataFrame], DataFrame],
    affected: DataFrame,
    name: str,
) -> None:
    """Change the rows of a table in its affected partitions, however many there are.

    ``affected`` has a row for each. The other partitions are not written. A
    partition that is left without rows is dropped.
    """
    spark = df.sparkSession
    affected, affected_path = staged_rows(affected)
    if affected.isEmpty():
        remove_path(spark, affected_path)
        return
    rows, path = staged_rows(change(_in_partitions(df, affected, "left_semi")))
    _replace_partitions(rows, affected, name, path)
    remove_path(spark, path)
    remove_path(spark, affected_path)


def _replace_partitions(rows: DataFrame, affected: DataFrame, name: str, path: str) -> None:
    """Write stored rows over their partitions, and drop affected ones that have no rows."""
    spark = rows.sparkSession
    # Known before anything is written, and only by what is left to drop.
    left = rows.select(*affected.columns).distinct()
    emptied, emptied_path = staged_rows(_in_partitions(affected, left, "left_anti"))
    # A session of its own, as the setting would hold for all who share this one.
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        stored = own.read.schema(spark.read.parquet(path).schema).parquet(path)
        # Rows of a partition together, as each task writes a file for each one it meets.
        dealt = stored.select(*map(quoted, rows.columns)).hint("rebalance", *affected.columns)
        dealt.write.insertInto(sql_name(name), overwrite=True)
    except Exception as error:
        error.add_note(f"the new rows of the changed partitions of {name} are in {path}")
        raise
    spark.catalog.refreshTable(sql_name(name))
    # Only the catalog can drop a partition; it is told of some at a time.
    gone = emptied.toLocalIterator()
    while specs := [_partition_spec(row) for row in islice(gone, 100)]:
        spark.sql(f"ALTER TABLE {sql_name(name)} DROP IF EXISTS {', '.join(specs)}")
    remove_path(spark, emptied_path)


def _partition_spec(row: Row) -> str:
    values = (f"`{c}` = {'NULL' if v is None else sql_literal(str(v))}" for c, v in row.asDict().items())
    return f"PARTITION ({', '.join(values)})"


# Properties that the catalog sets by itself.
_OWN_PROPERTIES = (
    "collation", "comment", "external", "is_managed_location", "location", "owner", "provider",
    "table_type", "transient_lastDdlTime",
)


@dataclass(frozen=True)
class Layout:
    """How a table is stored, apart from its columns."""

    provider: str | None = None
    partitions: tuple[str, ...] = ()
    buckets: int = 0
    bucket_columns: tuple[str, ...] = ()
    sort_columns: tuple[str, ...] = ()
    properties: tuple[tuple[str, str], ...] = ()
    comment: str | None = None
    location: str | None = None  # only where the table does not belong to the catalog

    def save(self, df: DataFrame, name: str, **options: object) -> None:
        if not in_session_catalog(df.sparkSession, name):
            df.writeTo(sql_name(name)).options(**options).create()
            return
        writer = df.write.options(**options)
        writer = writer.format(self.provider) if self.provider else writer
        partitions = [c for c in self.partitions if c in df.columns]
        if partitions:
            writer = writer.partitionBy(*partitions)
        if self.buckets and set(self.bucket_columns) <= set(df.columns):
            writer = writer.bucketBy(self.buckets, *self.bucket_columns)
            if self.sort_columns and set(self.sort_columns) <= set(df.columns):
                writer = writer.sortBy(*self.sort_columns)
        writer.saveAsTable(sql_name(name))
        if self.comment:
            df.sparkSession.sql(f"COMMENT ON TABLE {sql_name(name)} IS {sql_literal(self.comment)}")
        if self.properties:
            listed = ", ".join(f"{sql_literal(k)} = {sql_literal(v)}" for k, v in self.properties)
            df.sparkSession.sql(f"ALTER TABLE {sql_name(name)} SET TBLPROPERTIES ({listed})")


def sql_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table besides its columns."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {sql_name(name)}")
    wanted = ["Provider", "Num Buckets", "Sort Columns", "Comment", "Type", "Location"]
    # after the columns, some of which may have such names
    rows = [tuple(r)[:2] for r in described.collect()]
    return dict(r for r in rows[rows.index(("# Detailed Table Information", "")) :] if r[0] in wanted)


def table_location(spark: SparkSession, name: str) -> str:
    """The folder of a table in the catalog."""
    return str(_details(spark, name)["Location"])


def table_layout(spark: SparkSession, name: str) -> Layout:
    """The layout of a table in the catalog."""
    details = _details(spark, name)
    columns = spark.catalog.listColumns(sql_name(name))
    properties = spark.sql(f"SHOW TBLPROPERTIES {sql_name(name)}").collect()
    return Layout(
        details.get("Provider"),
        tuple(c.name for c in columns if c.isPartition),
        int(details.get("Num Buckets", 0)),
        tuple(c.name for c in columns if c.isBucket),
        tuple(re.findall("`([^`]+)`", details.get("Sort Columns", ""))),
        tuple((k, v) for k, v in properties if k not in _OWN_PROPERTIES),
        details.get("Comment"),
        details.get("Location") if details.get("Type") == "EXTERNAL" else None,
    )


def column_ddl(columns: str) -> str:
    """Spell a column list for Spark: no outer brackets, ``text`` as ``string``."""
    ddl = columns.strip()
    if ddl.startswith("(") and ddl.endswith(")"):
        ddl = ddl[1:-1].strip()
    # Type words of the usual column lists that Spark spells otherwise.
    words = {"text": "string", "double precision": "double", "geometry": GEOMETRY_DDL}
    for word, spelled in words.items():
        ddl = re.sub(rf"(\w\s+){word}(?=\s*(?:,|$|not\b))", rf"\g<1>{spelled}", ddl, flags=re.I)
    return ddl


def create_empty(spark: SparkSession, name: str, columns: str) -> None:
    """Create a table with a leading ``id`` column, unless it exists."""
    using = " USING parquet" if in_session_catalog(spark, name) else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {sql_name(name)} (id BIGINT, {column_ddl(columns)}){using}"
    )


def literal_rows(
    spark: SparkSession, columns: str | Sequence[str], values: str | Sequence[Sequence[object]]
) -> DataFrame:
    """A frame of literal rows, given as tuples or as the text of a VALUES list."""
    names = [c.strip() for c in (columns.split(",") if isinstance(columns, str) else columns)]
    if isinstance(values, str):
        listed = ", ".join(f"`{n}`" for n in names)
        return spark.sql(f"SELECT * FROM VALUES {values.strip().rstrip(';')} AS v({listed})")
    return spark.createDataFrame([tuple(row) for row in values], names)
