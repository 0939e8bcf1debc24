"""Drop lines that many documents share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import WHITE, ascii_lower, free_name, join_hot, named, row_key, stage


def drop_shared_lines(
    docs: DataFrame,
    min_documents: int = 10,
    min_chars: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents without lines whose key occurs in ``min_documents`` or more of them.

    A line's key is the line without white space at its ends and with A-Z in
    lower case; keys under ``min_chars`` code points are never dropped. All lines
    of a shared key go, in every document; the others stay in order, joined by
    line feeds. ``n_lines`` and ``n_dropped`` are added.

    A document is a distinct (doc_id, text), so a repeated row counts once but is
    cleaned each time. A missing text has one empty line and stays missing. A
    document that loses all lines becomes empty. An empty table gives no rows.
    Columns of the same names as the added ones are replaced.

    Only hashes (128 bits) and positions are dealt by line; the texts move once, by
    document. Lines that a thousandth of all lines equal are found by a broadcast
    of their hashes, a thousand at most, so no task gets all of a frequent line.
    """
    key, gone = free_name(docs, "key"), free_name(docs, "gone")
    keyed = docs.drop("n_lines", "n_dropped").withColumn(
        key, row_key(named(docs, doc_id), named(docs, text))
    )
    whole = F.coalesce(named(keyed, text), F.lit(""))
    lines = F.split(whole, "\n", -1)

    cut = F.btrim("line", F.lit(WHITE)).alias("cut")
    exploded = (
        keyed.select(
            F.col(key).alias("key"),
            F.posexplode(F.split(ascii_lower(whole), "\n", -1)).alias("pos", "line"),
        )
        .select("key", "pos", cut)
        .where(F.char_length("cut") >= min_chars)
    )
    hashes = F.struct(F.xxhash64("cut").alias("a"), F.xxhash64(F.lit(1), "cut").alias("b"))
    found = stage(exploded.select("key", "pos", hashes.alias("hash")), "lines")
    # one row for each line of a document however often it stands there, counted where it is read
    counted = found.groupBy("hash", "key").agg(F.count("*").alias("n")).groupBy("hash")
    shared = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("n"))
    shared = stage(shared.where(F.col("docs") >= min_documents).drop("docs"), "shared-lines")
    dropped = (
        join_hot(found, shared, "hash", "n", "left_semi")
        .groupBy(F.col("key").alias(key))
        .agg(F.collect_set("pos").alias(gone))
    )

    joined = keyed.join(dropped, key, "left")
    n_lines = F.size(lines)
    places = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col(gone))
    line_array = free_name(joined, "lines")
    kept = F.transform(places, lambda i: F.get(F.col(line_array), i))
    return (
        joined.withColumn(line_array, lines)
        .withColumns(
            {
                "n_lines": F.size(line_array).cast("long"),
                "n_dropped": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
                text: F.when(F.col(gone).isNull(), named(joined, text)).otherwise(
                    F.array_join(kept, "\n")
                ),
            }
        )
        .drop(key, gone, line_array)
    )
