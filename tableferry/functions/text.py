"""Cell cleaning as column expressions; all of it stays inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts that stand for a missing value in CSV and Excel files.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def quoted(name: str) -> Column:
    """A column by its exact name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def map_text_columns(df: DataFrame, change) -> DataFrame:
    """Apply ``change`` to each text column and leave the others alone."""
    return df.select(
        [
            change(quoted(f.name)).alias(f.name) if _is_text(f) else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def escape_quotes(df: DataFrame) -> DataFrame:
    """Double single quotes, then turn each double quote into two single ones."""

    def escape(cell: Column) -> Column:
        doubled = F.replace(cell, F.lit("'"), F.lit("''"))
        return F.replace(doubled, F.lit('"'), F.lit("''"))

    return map_text_columns(df, escape)


def strip_unsafe(df: DataFrame) -> DataFrame:
    """Drop back-slashes, double quotes and square brackets from text columns."""
    return map_text_columns(df, lambda cell: F.translate(cell, '\\"[]', ""))


def empty_as_null(df: DataFrame) -> DataFrame:
    """Turn empty text into NULL."""
    return map_text_columns(df, lambda cell: F.nullif(cell, F.lit("")))


def na_as_null(df: DataFrame, tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """Turn the usual missing-value texts into NULL."""
    tokens = list(tokens)
    return map_text_columns(df, lambda cell: F.when(~cell.isin(tokens), cell))


def stringify(cell: Column, data_type: T.DataType) -> Column:
    """The text form of any cell; NULL stays NULL and booleans read True/False."""
    if isinstance(data_type, T.StringType):
        return cell
    text = cell.cast("string")
    return F.initcap(text) if isinstance(data_type, T.BooleanType) else text
