"""CSV and JSON files as DataFrames with inferred types."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.names import distinct_names
from tableferry.functions.text import NA_TOKENS, na_as_null, quoted
from tableferry.functions.types import cast_text, convert_dates, infer_types, text_types
from tableferry.session import fresh_path, note_staged
from tableferry.sources.pieces import (
    BLOCK,
    FILE,
    POS,
    TEXT,
    csv_records,
    json_cells,
    json_records,
    spans_lines,
)
from tableferry.sources.relation import materialize

_BAD, _EXTRA = "__bad", "__extra"
PLACE = "__place"


def _csv_options(sep: str) -> dict[str, object]:
    return {"sep": sep, "quote": '"', "escape": '"'}


def csv_titles(spark: SparkSession, path: str | list[str], sep: str = ",") -> list[str | None]:
    """The first record of the first file, as it stands."""
    first = spark.read.csv(path, header=False, multiLine=True, **_csv_options(sep)).first()
    if first is None:
        raise ValueError(f"no header in {path}")
    return list(first)


def name_columns(titles: Iterable[str | None]) -> list[str]:
    """Names from titles; blank ones become ``unnamed_<place>``, repeated ones get a number."""
    return distinct_names(t if t else f"unnamed_{i}" for i, t in enumerate(titles))


def _text_ddl(names: list[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def _no_longer_than(names: list[str], sep: str) -> Column:
    """True, or an error for a record with more cells than there are titles.

    Only records of an odd length carry ``_BAD``, so the rest skip the check.
    The message names the first cell, as Spark refuses to read ``_BAD`` alone.
    """
    wider = _text_ddl([f"c{i}" for i in range(len(names))] + [_EXTRA])
    extra = F.from_csv(_BAD, wider, _csv_options(sep))[_EXTRA]
    record = F.coalesce(quoted(names[0]), F.lit(""))
    message = F.concat(F.lit("more cells than titles in the record that starts with "), record)
    return F.when(F.col(_BAD).isNotNull() & extra.isNotNull(), F.raise_error(message)).otherwise(
        F.lit(True)
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    schema: T.StructType | str | None = None,
    infer: bool = True,
    na_tokens: Iterable[str] = NA_TOKENS,
    line_breaks: bool = True,
    place: str | None = None,
) -> DataFrame:
    """Read CSV files that start with a header record.

    Columns without a schema are read as text, missing-value texts become NULL
    and each column gets the narrowest type that holds it. A record with more
    cells than the header raises; one with fewer is filled up with NULL. Files
    of one folder must have the same header.

    Files are split between tasks. Where a cell holds a line break, or a title had
    to be changed, the files are cut into lines that are joined again in parallel;
    that takes more passes. Pass ``line_breaks=False`` if cells are known to hold
    none; it saves a scan. ``place`` names a column that is added and tells
    the record's place: file, block, and number in the block, in this order.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    titles = schema.names if schema is not None else csv_titles(spark, path, sep)
    names = name_columns(titles)
    columns = _text_ddl([*names, _BAD])
    options = {**_csv_options(sep), "columnNameOfCorruptRecord": _BAD}

    changed = schema is None and names != titles
    if changed or line_breaks and spans_lines(spark, path, sep):
        records = csv_records(spark, path, sep)
        parsed = F.from_csv(TEXT, columns, {**options, "multiLine": "true"})
        df = records.select(parsed.alias("r"), _place(FILE, BLOCK, POS)).select("r.*", PLACE)
    else:
        # Spark checks each file's header against the names.
        df = spark.read.schema(columns).csv(path, header=True, enforceSchema=False, **options)
        found = _place("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
        df = df.select("*", found)
    df = df.where(_no_longer_than(names, sep)).drop(_BAD)
    df = na_as_null(df, na_tokens)
    if schema is not None:
        kept = [quoted(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        df = df.select(*kept, PLACE)
    elif infer:
        df = infer_types(df)
    return df.withColumnRenamed(PLACE, place) if place else df.drop(PLACE)


def _place(file: str, block: str, number: str | Column) -> Column:
    return F.struct(
        F.col(file).alias("file"),
        F.col(block).alias("block"),
        (F.col(number) if isinstance(number, str) else number).alias("number"),
    ).alias(PLACE)


def _layout(spark: SparkSession, path: str | list[str]) -> str:
    """What the first file holds: an array, or lines of objects, or one object of columns."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    lines = lines.where(F.trim("value") != "")
    head = lines.first()
    if head is None:
        return "lines"
    first = head.value.lstrip("\ufeff \t\r\n")
    if first.startswith("["):
        return "records"
    try:
        cells = json.loads(first)
    except ValueError:  # an object over several lines
        return "columns"
    several = lines.where(F.col("file") == head.file).limit(2).count() > 1
    wide = isinstance(cells, dict) and all(isinstance(c, dict) for c in cells.values())
    return "columns" if wide and not several else "lines"


def read_json(
    spark: SparkSession, path: str | list[str], layout: str = "auto", place: str | None = None
) -> DataFrame:
    """Read JSON files of one layout.

    * ``records``: an array of objects.
    * ``columns``: an object of columns, each an object from row label to cell.
    * ``lines``: one object per line.

    ``auto`` looks at the beginning of the first file. Arrays and objects of
    columns are cut into pieces that are read in parallel; whatever stands after
    the end of the first one in a file is an error. Texts get the narrowest type
    that holds a column, and columns with a date's name become timestamps if all
    of their cells allow it. ``place`` names a column that is added and orders the
    rows as they stand in the files.
    """
    if layout == "auto":
        layout = _layout(spark, path)
    readers = {
        "lines": _read_json_lines,
        "records": _read_json_records,
        "columns": _read_json_columns,
    }
    if layout not in readers:
        raise ValueError("layout must be auto, records, columns or lines")
    df = convert_dates(infer_types(readers[layout](spark, path)))
    return df.withColumnRenamed(PLACE, place) if place else df.drop(PLACE)


def _read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    found = spark.read.json(path, mode="FAILFAST")
    place = _place("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return found.select("*", place)


def _read_json_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Each object becomes a line together with its place, for Spark to find the types."""
    placed = F.struct(
        F.col(FILE).alias("file"), F.col(BLOCK).alias("block"), F.col(POS).alias("number")
    )
    head = F.concat(F.lit('{"place":'), F.to_json(placed), F.lit(',"row":'))
    lines = fresh_path(spark, "lines")
    note_staged(lines)
    records = json_records(spark, path)
    records.select(F.concat(head, "value", F.lit("}")).alias("value")).write.text(lines)
    found = spark.read.json(lines, mode="FAILFAST")
    if "row" not in found.columns or not isinstance(found.schema["row"].dataType, T.StructType):
        return found.limit(0).select(F.struct().alias(PLACE))
    # inferred fields come in order of their names
    return found.select("row.*", F.struct("place.file", "place.block", "place.number").alias(PLACE))


def _read_json_columns(spark: SparkSession, path: str | list[str]) -> DataFrame:
    cells = materialize(json_cells(spark, path))
    # One row per column of the table; a schema has to be known to the driver.
    titles = cells.groupBy("title").agg(F.min("column_no").alias("n")).orderBy("n", "title").collect()
    names = [row["title"] for row in titles]
    wide = cells.groupBy("file", "label").agg(
        *[F.max(F.when(F.col("title") == n, F.col("cell"))).alias(n) for n in names]
    )
    types = text_types(wide.drop("file", "label"))
    number = F.col("label").try_cast("bigint")
    place = F.struct("file", number.isNull().alias("named"), number.alias("number"), "label")
    placed = wide.select(*map(quoted, names), place.alias(PLACE))
    return cast_text(placed, types).orderBy(PLACE)
