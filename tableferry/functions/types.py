"""Type inference over text, and the narrow type map of the typed load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.text import quoted, stringify

_WHOLE, _REAL, _FLAG, _TEXT = 0, 1, 2, 3


# Matching first keeps the casts from raising and catching an error per cell. It
# also keeps out what only Java reads as a number, such as 1d or 0x1.
_WHOLE_TEXT = r"^\s*[+-]?[0-9]+\s*$"
_REAL_TEXT = (
    r"^\s*[+-]?(?:[0-9]+\.?[0-9]*(?:[eE][+-]?[0-9]+)?|\.[0-9]+(?:[eE][+-]?[0-9]+)?"
    r"|(?i:inf|infinity))\s*$"
)
# The texts that read as a truth value.
_FLAG_TEXTS = ("True", "TRUE", "true", "False", "FALSE", "false")


def _cell_kind(cell: Column) -> Column:
    # A whole number beyond 64 bits stays text, so that no digit is lost.
    fits = F.length(F.trim(cell)) < 19
    whole = F.when(fits | cell.try_cast("bigint").isNotNull(), _WHOLE).otherwise(_TEXT)
    return (
        F.when(cell.isNull(), F.lit(None).cast("int"))
        .when(cell.rlike(_WHOLE_TEXT), whole)
        .when(cell.rlike(_REAL_TEXT), _REAL)
        .when(cell.isin(*_FLAG_TEXTS), _FLAG)
        .otherwise(_TEXT)
    )


def _column_type(low: int | None, high: int | None) -> str:
    if low is None or high is None:
        return "double"  # nothing but missing values
    if high == _WHOLE:
        return "bigint"
    if high == _REAL:
        return "double"
    if low == high == _FLAG:
        return "boolean"
    return "string"


def text_types(df: DataFrame) -> dict[str, str]:
    """The narrowest type that holds each text column, from one aggregate pass."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return {}
    kinds = df.select([_cell_kind(quoted(n)).alias(f"k{i}") for i, n in enumerate(names)])
    bounds = [
        bound(f"k{i}").alias(f"{label}{i}")
        for i in range(len(names))
        for label, bound in (("low", F.min), ("high", F.max))
    ]
    row = kinds.agg(*bounds).first()
    return {n: _column_type(row[f"low{i}"], row[f"high{i}"]) for i, n in enumerate(names)}


def cast_text(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named text columns; other columns pass unchanged."""
    return df.select(
        [
            quoted(c).try_cast(types[c]).alias(c) if types.get(c, "string") != "string" else quoted(c)
            for c in df.columns
        ]
    )


def infer_types(df: DataFrame) -> DataFrame:
    """Give every text column the narrowest of bigint, double, boolean, string."""
    return cast_text(df, text_types(df))


def apply_type_map(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """64-bit integers stay, doubles narrow to real, all else becomes text.

    Columns in ``keep`` (geometry) pass unchanged.
    """

    def mapped(field: T.StructField) -> Column:
        cell = quoted(field.name)
        if field.name in keep or isinstance(field.dataType, T.LongType):
            return cell
        if isinstance(field.dataType, T.DoubleType):
            return cell.cast("float").alias(field.name)
        return stringify(cell, field.dataType).alias(field.name)

    return df.select([mapped(f) for f in df.schema.fields])


# The names that make a JSON column a date, and the least epoch taken for one.
_DATE_ENDS, _DATE_STARTS, _DATE_NAMES = ("_at", "_time"), ("timestamp",), ("modified", "date")
_LEAST_EPOCH = 31_536_000
# Microseconds per epoch unit, and the largest number read in that unit: seconds come first.
_EPOCH_UNITS = ((1_000_000, 9_223_372_036), (1_000, 9_223_372_036_854), (1, 9_223_372_036_854_775))
_ZONE = r"(?:[zZ]|[0-9][+-][0-9]{2}:?[0-9]{2})\s*$"


def _names_a_date(name: str) -> bool:
    low = name.lower()
    return low.endswith(_DATE_ENDS) or low.startswith(_DATE_STARTS) or low in _DATE_NAMES


def _epoch(cell: Column, highest: int) -> Column:
    scale = next((s for s, limit in _EPOCH_UNITS if highest <= limit), None)
    micros = cell * scale if scale else F.floor(cell / 1000)
    return F.timestamp_add("MICROSECOND", micros, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def convert_dates(df: DataFrame) -> DataFrame:
    """Turn columns with a date's name into timestamps if every cell allows it.

    Texts must all read as timestamps, with a zone in all of them or in none;
    whole numbers must all be epochs after 1970.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields if _names_a_date(f.name)}
    texts = [n for n, t in kinds.items() if isinstance(t, T.StringType)]
    numbers = [n for n, t in kinds.items() if isinstance(t, T.LongType)]
    if not texts and not numbers:
        return df
    checks = [F.lit(0).alias("none")]
    for i, name in enumerate(texts):
        cell = quoted(name)
        reads = F.when(cell.isNotNull(), cell.try_cast("timestamp").isNotNull())
        checks += [F.every(reads).alias(f"reads{i}")]
        checks += [F.every(cell.rlike(_ZONE)).alias(f"all{i}"), F.some(cell.rlike(_ZONE)).alias(f"any{i}")]
    for i, name in enumerate(numbers):
        checks += [F.min(quoted(name)).alias(f"low{i}"), F.max(quoted(name)).alias(f"high{i}")]
    row = df.agg(*checks).first()
    changed = {}
    for i, name in enumerate(texts):
        if row[f"reads{i}"] and row[f"all{i}"] == row[f"any{i}"]:
            kind = "timestamp" if row[f"all{i}"] else "timestamp_ntz"
            changed[name] = quoted(name).cast(kind)
    for i, name in enumerate(numbers):
        if row[f"low{i}"] is not None and row[f"low{i}"] > _LEAST_EPOCH:
            changed[name] = _epoch(quoted(name), row[f"high{i}"])
    return df.select([changed[c].alias(c) if c in changed else quoted(c) for c in df.columns])
