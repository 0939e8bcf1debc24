"""Delimited text as an exchange format: pipe-separated, with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tableferry.sources.files import read_csv


def write_delimited(df: DataFrame, path: str, sep: str = "|", mode: str = "errorifexists") -> None:
    """Write text parts with a header; NULL and empty text both become an empty cell."""
    df.write.mode(mode).csv(
        path,
        sep=sep,
        header=True,
        quote='"',
        escape='"',
        nullValue="",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "|"
) -> DataFrame:
    """Read the parts back with a known schema; an empty cell becomes NULL."""
    return read_csv(spark, path, sep, schema, na_tokens=("",))
