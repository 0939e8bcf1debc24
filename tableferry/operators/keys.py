"""Keys that stay unique across appends, checked by a summary of the stored ones.

The summary of a table is a bit set beside it: every stored key sets the bit that its
hash names. A new key whose bit is not set is not in the table; only the others are
looked up in it. With 16 bits for each key some 6 per cent of new keys are looked up
in vain, and the summary takes about 2 bytes a key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.text import quoted
from tableferry.sinks.tables import rewrite_table, save_table, staged_rows
from tableferry.session import remove_path
from tableferry.sources.relation import sql_name, table_exists

_WORD, _BIT, _BITS, _ROWS = "__word", "__bit", "__bits", "__rows"


def summary_name(table: str) -> str:
    """The table that holds the summary of another one's keys."""
    return f"{table.replace('`', '')}__keys"


def _placed(df: DataFrame, keys: Sequence[str], word_bits: int) -> DataFrame:
    """The frame with the word and the bit of each key: high and low bits of its hash."""
    h = F.xxhash64(*map(quoted, keys))
    word = F.shiftrightunsigned(h, 64 - word_bits) if word_bits else F.lit(0).cast("long")
    low = h.bitwiseAND(F.lit(63)).cast("int")
    # a shift by a column
    one = F.call_function("shiftleft", F.lit(1).cast("long"), low)
    return df.withColumns({_WORD: word, _BIT: one})


def _set_bits(df: DataFrame, keys: Sequence[str], word_bits: int) -> DataFrame:
    placed = _placed(df, keys, word_bits)
    return placed.groupBy(_WORD).agg(F.bit_or(_BIT).alias(_BITS))


def _settings(spark: SparkSession, table: str) -> dict[str, str]:
    shown = spark.sql(f"SHOW TBLPROPERTIES {sql_name(summary_name(table))}").collect()
    return {r["key"].removeprefix("ferry."): r["value"] for r in shown if r["key"].startswith("ferry.")}


def _note(spark: SparkSession, table: str, **settings: object) -> None:
    listed = ", ".join(f"'ferry.{k}' = '{v}'" for k, v in settings.items())
    spark.sql(f"ALTER TABLE {sql_name(summary_name(table))} SET TBLPROPERTIES ({listed})")


def build_key_summary(
    spark: SparkSession, table: str, keys: Sequence[str], bits_per_key: int = 16
) -> str:
    """Write the summary of a table's keys, anew if there is one; returns its name.

    It is made for as many keys as the table has, twice over. More keys keep it right
    but make it look up more of them; then build it again.
    """
    stored = spark.table(sql_name(table))
    rows = stored.count()
    word_bits = max(0, math.ceil(math.log2(max(2 * rows * bits_per_key / 64, 1))))
    words = _set_bits(stored, keys, word_bits).repartitionByRange(_WORD).sortWithinPartitions(_WORD)
    name = summary_name(table)
    if table_exists(spark, name):
        rewrite_table(words, name)
    else:
        save_table(words, name)
    _note(spark, table, keys=",".join(keys), word_bits=word_bits, rows=rows)
    return name


def _summary(spark: SparkSession, table: str, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """The words of the summary and their bits of the hash; built if it does not cover the table."""
    if table_exists(spark, summary_name(table)):
        told = _settings(spark, table)
        same = told.get("keys") == ",".join(keys)
        # rows that came past the summary; of Parquet files, the count is in the footers
        if same and spark.table(sql_name(table)).count() <= int(told["rows"]):
            return spark.table(sql_name(summary_name(table))), int(told["word_bits"])
    build_key_summary(spark, table, keys)
    return _summary(spark, table, keys)


def probable_keys(batch: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """The rows of a batch whose keys may be in the table: all that are, and few others."""
    words, word_bits = _summary(batch.sparkSession, table, keys)
    found = _placed(batch, keys, word_bits)
    hit = (found[_WORD] == words[_WORD]) & (found[_BIT].bitwiseAND(words[_BITS]) != 0)
    return found.join(words, hit, "left_semi").drop(_WORD, _BIT)


def appended_violations(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Keys of new rows that hold a NULL, repeat, or are in the table already.

    One row each: the key, ``n`` new rows and ``n_stored`` old ones. The old rows are
    read only if the summary names keys to look up, and then those are joined alone.
    The distinct new keys are stored, and stay while the result may be read.
    """
    columns = [quoted(k) for k in keys]
    any_null: Column = reduce(or_, (c.isNull() for c in columns))
    batch, _ = staged_rows(df.groupBy(*columns).agg(F.count(F.lit(1)).alias(_ROWS)))
    asked, path = staged_rows(probable_keys(batch.where(~any_null), table, keys).drop(_ROWS))
    new = batch.select(*columns, F.col(_ROWS).alias("n"))
    if asked.isEmpty():
        remove_path(df.sparkSession, path)
        stored = new.where(F.lit(False)).select(*columns, F.lit(0).cast("long").alias("n_stored"))
    else:
        old = df.sparkSession.table(sql_name(table)).select(*columns)
        stored = old.join(asked, list(keys), "left_semi").groupBy(*columns).agg(
            F.count(F.lit(1)).alias("n_stored")
        )
    known = F.coalesce("n_stored", F.lit(0)).alias("n_stored")
    joined = new.join(stored, list(keys), "left").select(*columns, "n", known)
    return joined.where(any_null | (F.col("n") > 1) | (F.col("n_stored") > 0))


def append_unique(df: DataFrame, table: str, keys: Sequence[str], match: str = "name") -> DataFrame | None:
    """Append rows if that keeps the key; else give the violations and write nothing.

    The bits are set before the rows are written, so a job that fails in between
    leaves at most bits without rows. Appends that do not come this way are noticed
    by the number of rows, and the summary is built again. One writer at a time.
    """
    spark = df.sparkSession
    violations = appended_violations(df, table, keys)
    if not violations.isEmpty():
        return violations
    rows, path = staged_rows(df)
    _, word_bits = _summary(spark, table, keys)
    _set_bits(rows, keys, word_bits).write.insertInto(sql_name(summary_name(table)))
    covered = int(_settings(spark, table)["rows"]) + rows.count()
    _note(spark, table, rows=covered)
    save_table(rows, table, match=match)
    remove_path(spark, path)
    return None
