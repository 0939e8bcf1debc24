"""Column-name cleaning and flag words."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

# Marks that cleaning removes from a name, besides white space.
ASCII_MARKS = "+.-:?!/,$%^*()\"'[]~@#&"
WIDE_MARKS = "—！，。？、￥…（）"

# The words a configuration may use for "yes".
TRUE_WORDS = ("True", "TRUE", "true", "T", "YES", "yes", "Yes", "OK", "ok", "Ok")


def clean_name(name: str, lower: bool = True) -> str:
    """Turn spaces into underscores and drop marks and other white space."""
    unwanted = ASCII_MARKS + WIDE_MARKS
    kept = "".join(
        ch
        for ch in str(name).replace(" ", "_")
        if ch not in unwanted and not ch.isspace()
    )
    return kept.lower() if lower else kept


def distinct_names(names: Iterable[str]) -> list[str]:
    """Suffix ``_2``, ``_3``, ... to names that repeat (Spark ignores case)."""
    names = list(names)
    given = {name.lower() for name in names}
    used: set[str] = set()
    result = []
    for name in names:
        candidate, n = name, 1
        while candidate.lower() in used or (n > 1 and candidate.lower() in given):
            n += 1
            candidate = f"{name}_{n}"
        used.add(candidate.lower())
        result.append(candidate)
    return result


def clean_names(df: DataFrame, lower: bool = True) -> DataFrame:
    """Clean every column name. Touches the schema only; runs no job."""
    return df.toDF(*distinct_names(clean_name(c, lower) for c in df.columns))


def as_flag(value: object) -> bool:
    """Read a yes/no setting from a configuration map."""
    return value in TRUE_WORDS if isinstance(value, str) else value == True  # noqa: E712
