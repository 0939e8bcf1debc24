"""Read tables, queries and filtered tables as lazy DataFrames."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.ewkb import parse_geometry
from tableferry.functions.geometry import GEOMETRY
from tableferry.functions.text import quoted
from tableferry.session import fresh_path, note_staged


@dataclass(frozen=True)
class TableSource:
    """A database reached over JDBC. The driver jar is the caller's to supply.

    Credentials go into ``options``, never into the URL. ``bucket`` is SQL that deals a
    column out to 0, 1, ... of so many parts; the one given is PostgreSQL's.
    """

    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    bucket: str = "abs(mod(hashtext(CAST({column} AS text)), {parts}))"

    def jdbc_options(self, **more: object) -> dict[str, str]:
        defaults = {"preferTimestampNTZ": "true", "fetchsize": "10000", "batchsize": "10000"}
        extra = {k: str(v) for k, v in more.items() if v is not None}
        return {**defaults, **self.options, "url": self.url, **extra}


def postgresql(address: str, **options: str) -> TableSource:
    """A PostgreSQL database at ``host:port/name``; give user and password as options."""
    host, _, name = address.partition("/")
    driver = {"driver": "org.postgresql.Driver"}
    return TableSource(f"jdbc:postgresql://{host}/{quote(name)}", {**driver, **options})


def in_session_catalog(spark: SparkSession, name: str) -> bool:
    """Whether a name means a table of Spark's own catalog."""
    parts = name.replace("`", "").split(".")
    catalog = parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()
    return catalog == "spark_catalog"


def sql_name(name: str) -> str:
    """Quote each part of a table name; a name with back-ticks passes as it is."""
    if "`" in name:
        return name
    return ".".join(f"`{part}`" for part in name.split("."))


def classify(cmd: str) -> tuple[str, str]:
    """Tell a whole query from the tail of one by its leading keyword."""
    text = cmd.strip().rstrip(";").rstrip()
    if not text:
        return "table", ""
    if re.match(r"(select|with)\b|\(", text, re.IGNORECASE):
        return "query", text
    if re.match(r"where\b", text, re.IGNORECASE):
        return "tail", text
    raise ValueError(f"expected a SELECT or a WHERE clause, got: {text[:60]!r}")


def read_relation(
    spark: SparkSession,
    name: str,
    cmd: str = "",
    source: TableSource | None = None,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    split: str = "even",
) -> DataFrame:
    """Read a table, a whole query, or a table cut by a WHERE tail.

    Over JDBC the text runs in the database; with ``partition_column`` the scan is
    split into ``num_partitions`` tasks. ``split`` says how: "even" takes ranges of
    equal width between the column's bounds, which are asked from the database first;
    "depth" takes ranges of about as many rows each, whose bounds the database finds
    in one sort; "hash" takes buckets of a hash that the database computes, for
    columns without a useful order, see ``TableSource.bucket``. Ranges cover each row
    once, NULLs and values that repeat included; so do buckets.
    """
    kind, text = classify(cmd)
    if source is None:
        if kind == "table":
            return spark.table(sql_name(name))
        return spark.sql(text if kind == "query" else f"SELECT * FROM {sql_name(name)} {text}")
    relation = {
        "table": name,
        "query": f"({text}) tmp",
        "tail": f"(SELECT * FROM {name} {text}) tmp",
    }[kind]
    options = source.jdbc_options(dbtable=relation)
    if partition_column is not None and split != "even":
        parts = num_partitions or spark.sparkContext.defaultParallelism
        if split == "depth":
            predicates = depth_predicates(partition_column, _depth_bounds(spark, source, relation, partition_column, parts))
        elif split == "hash":
            predicates = bucket_predicates(source.bucket, partition_column, parts)
        else:
            raise ValueError("split a scan by 'even', 'depth' or 'hash'")
        return spark.read.jdbc(source.url, relation, predicates=predicates, properties=_properties(source))
    if partition_column is not None:
        options |= _partition_options(spark, source, relation, partition_column, num_partitions)
    return spark.read.format("jdbc").options(**options).load()


def _properties(source: TableSource) -> dict[str, str]:
    return {k: v for k, v in source.jdbc_options().items() if k != "url"}


def depth_query(relation: str, column: str, parts: int) -> str:
    """SQL for the first value of each of so many runs of rows in the order of a column."""
    dealt = f"SELECT {column} AS v, ntile({parts}) OVER (ORDER BY {column}) AS part FROM {relation}"
    return f"(SELECT part, min(v) AS low FROM ({dealt} WHERE {column} IS NOT NULL) dealt GROUP BY part) bounds"


def _depth_bounds(
    spark: SparkSession, source: TableSource, relation: str, column: str, parts: int
) -> list[object]:
    asked = source.jdbc_options(dbtable=depth_query(relation, column, parts))
    return [r["low"] for r in spark.read.format("jdbc").options(**asked).load().collect()]


def _sql_value(value: object) -> str:
    plain = isinstance(value, (int, float, Decimal)) and not isinstance(value, bool)
    return str(value) if plain else "'" + str(value).replace("'", "''") + "'"


def depth_predicates(column: str, lows: list[object]) -> list[str]:
    """Conditions that cut a column at these values: each row meets one of them, NULLs the first.

    Runs that begin with the same value become one, as equal values stay together.
    """
    cuts = [_sql_value(low) for low in sorted(set(lows))[1:]]
    ends = [f"{column} < {cut}" for cut in cuts]
    starts = [f"{column} >= {cut}" for cut in cuts]
    if not cuts:
        return ["1 = 1"]
    middle = [f"{a} AND {b}" for a, b in zip(starts, ends[1:])]
    return [f"{ends[0]} OR {column} IS NULL", *middle, starts[-1]]


def bucket_predicates(bucket: str, column: str, parts: int) -> list[str]:
    """Conditions for the buckets of a hash, where NULLs are in the first."""
    number = bucket.format(column=column, parts=parts)
    first = f"{number} = 0 OR {column} IS NULL"
    return [first, *(f"{number} = {i}" for i in range(1, parts))]


def _partition_options(
    spark: SparkSession, source: TableSource, relation: str, column: str, num: int | None
) -> dict[str, str]:
    bounds = f"(SELECT min({column}) AS low, max({column}) AS high FROM {relation}) bounds"
    row = spark.read.format("jdbc").options(**source.jdbc_options(dbtable=bounds)).load().first()
    if row[0] is None:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": str(row[0]),
        "upperBound": str(row[1]),
        "numPartitions": str(num or spark.sparkContext.defaultParallelism),
    }


def filter_frame(df: DataFrame, tail: str) -> DataFrame:
    """Apply a WHERE tail, with whatever ORDER BY or LIMIT follows, to a frame."""
    kind, text = classify(tail)
    if kind != "tail":
        raise ValueError("expected a WHERE clause")
    view = f"ferry_{uuid.uuid4().hex}"
    df.createTempView(view)
    try:
        return df.sparkSession.sql(f"SELECT * FROM {view} {text}")
    finally:
        df.sparkSession.catalog.dropTempView(view)


def run_query(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """Run any SELECT over the registered tables; values bind through ``args``.

    ``.columns`` are the titles and ``.collect()`` the rows.
    """
    return spark.sql(sql.strip().rstrip(";"), args=dict(args or {}))


def materialize(df: DataFrame) -> DataFrame:
    """Run the plan now and go on from the stored rows, which outlive executors."""
    path = fresh_path(df.sparkSession, "frame")
    note_staged(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_geometry(
    spark: SparkSession,
    sql: str,
    geometry_column: str = GEOMETRY,
    source: TableSource | None = None,
) -> DataFrame:
    """Run a query and read its one geometry column from WKT or binary.

    A database sends hexadecimal binary of its own accord, and WKT if the query asks
    for it, as with ``ST_AsText(geom) AS geometry``. A column of bytes is binary too.
    """
    df = read_relation(spark, "", sql, source)
    cell = quoted(geometry_column)
    if isinstance(df.schema[geometry_column].dataType, T.BinaryType):
        cell = F.hex(cell)
    return df.withColumn(geometry_column, parse_geometry(cell))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(sql_name(name))


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """One row per table: table_name, is_temporary. Views count unless a database is named."""
    where = f" IN {sql_name(database)}" if database else ""
    listed = spark.sql(f"SHOW TABLES{where}").select(
        F.col("tableName").alias("table_name"), F.col("isTemporary").alias("is_temporary")
    )
    return listed.where("NOT is_temporary") if database else listed


def list_columns(spark: SparkSession, name: str) -> DataFrame:
    """The columns of a table in order: position, column_name, data_type."""
    fields = spark.table(sql_name(name)).schema.fields
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields, start=1)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")


def register_jdbc_catalog(spark: SparkSession, alias: str, source: TableSource) -> None:
    """Make a database's tables known as ``alias.schema.table``.

    Listing, DDL and aggregate push-down (such as MAX) then go to the database.
    """
    prefix = f"spark.sql.catalog.{alias}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    spark.conf.set(f"{prefix}.pushDownAggregate", "true")
    for key, value in source.jdbc_options().items():
        spark.conf.set(f"{prefix}.{key}", value)
