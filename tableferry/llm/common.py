"""Column expressions and staging that several operators share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.session import fresh_path, remove_path

# The characters of [\x20\x09-\x0D].
WHITE = " \t\n\x0b\f\r"

# Folders staged since the innermost ``staged`` began, in this thread.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)

# A key with more than this share of all rows is dealt apart from the others.
HOT_SHARE = 1000


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name in taken:
        name += "_"
    return name


def named(df: DataFrame, column: str) -> Column:
    """A column of the frame by its literal name, dots and all."""
    return df[f"`{column.replace('`', '``')}`"]


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits that tell (doc_id, text) apart; a missing text counts as empty.

    Rows with equal keys get equal results, so any of them may stand for all.
    """
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    size = F.octet_length(name).cast("string")  # else an id could reach into the text
    return F.unhex(F.md5(F.concat(size, F.lit(":"), name, F.coalesce(text, F.lit("")))))


def words(text: Column) -> Column:
    """The runs of characters other than ``WHITE``, in order; none for a missing text."""
    plain = F.coalesce(text, F.lit(""))
    for mark in WHITE[1:]:
        plain = F.replace(plain, F.lit(mark), F.lit(" "))
    return F.array_remove(F.split(plain, " ", -1), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other character."""
    plain = F.octet_length(text) == F.char_length(text)
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(mapped)


def count_of(text: Column, marks: str) -> Column:
    """How often any of the given ASCII characters occurs."""
    total = F.lit(0)
    for mark in marks:
        without = F.replace(text, F.lit(mark), F.lit(""))
        total = total + (F.octet_length(text) - F.octet_length(without))
    return total.cast("long")


def bit_sums(h: Column) -> list[Column]:
    """Aggregates that count, over 64-bit hashes, how often each bit is set.

    Sum ``k`` holds the count of bit k in its low half and of bit k + 32 in its
    high half, so 32 sums do for 64 bits.
    """
    pair = F.lit(0x0000000100000001)
    return [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(pair)).alias(f"s{k}") for k in range(32)]


def majority_bits(n: Column) -> Column:
    """The fingerprint from ``bit_sums`` over ``n`` hashes: bits set in over half of them."""
    found = F.lit(0).cast("long")
    for k in range(32):
        low = F.col(f"s{k}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"s{k}"), 32)
        for count, bit in ((low, k), (high, k + 32)):
            one = F.shiftleft(F.lit(1).cast("long"), bit)
            found = found.bitwiseOR(F.when(count * 2 > n, one).otherwise(F.lit(0).cast("long")))
    return found


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and go on from there.

    A lost executor then costs a retry. Inside ``staged`` the folder is deleted
    at the end; outside of it, it stays.
    """
    path = fresh_path(df.sparkSession, label)
    noted = _STAGED.get()
    if noted is not None:
        noted.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(spark: SparkSession) -> Iterator[None]:
    """On leaving, delete what ``stage`` wrote inside, but for the last frame it gave.

    The lazy frames of an operator read what it staged, so write them inside, by
    ``stage`` or otherwise. After an error everything is deleted. The frame that is
    left belongs to the ``staged`` around this one, if there is any.
    """
    outer, noted = _STAGED.get(), []
    token = _STAGED.set(noted)
    try:
        yield
        left = noted[-1:]
    except BaseException:
        left = []
        raise
    finally:
        _STAGED.reset(token)
        for path in noted:
            if path not in left:
                remove_path(spark, path)
        if outer is not None:
            outer += left


def finished(spark: SparkSession, run: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``run`` gives, stored if it staged anything, and nothing else left behind."""
    with staged(spark):
        found = run()
        return stage(found, label) if _STAGED.get() else found


def join_hot(rows: DataFrame, side: DataFrame, on: str, size: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``side``, which has one row for each key, hot keys apart.

    ``size`` of ``side`` says how many rows have the key; it is dropped. Keys with
    more than a thousandth of all rows (``HOT_SHARE``) are at most that many, so
    they are broadcast and their rows stay where they are; the others are dealt by
    a shuffle. ``how`` is inner, left or left_semi. Both frames should be stored.
    """
    total = rows.count()
    hot = F.col(size) * HOT_SHARE > total
    few, rest = side.where(hot).drop(size), side.where(~hot).drop(size)
    warm = rows.join(F.broadcast(few), on, "left_semi" if how == "left_semi" else "inner")
    cold = rows.join(F.broadcast(few.select(on)), on, "left_anti").join(rest, on, how)
    return warm.unionByName(cold)
