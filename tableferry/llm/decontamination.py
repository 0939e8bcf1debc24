"""Find benchmark items inside documents: SimHash windows, Hamming index, exact check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import bit_sums, free_name, majority_bits, named, row_key, stage

# Up to so many rows of a hash and a number are sent to all executors, about 50 MB.
BROADCAST_ROWS = 500_000
BLOCKS = 8


def normal_words(text: Column) -> Column:
    """Lower-case runs of letters and digits, with sharp s as the ss that capitals make of it."""
    plain = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("ß"), F.lit("ss"))
    return F.array_remove(F.split(plain, r"[^\p{L}\p{N}]+", -1), "")


def _bounded(df: DataFrame) -> DataFrame:
    """Sent to all executors if it is counted to be small, else dealt out like any other."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _shingles(words: str, width: Column) -> Column:
    """The sorted shingles of a window, each with how many equal ones stand before it.

    So repeated shingles stay apart, and a set operation counts them with their weight.
    """
    at = F.sequence(F.lit(1), F.size(words) - width + 1)
    every = F.sort_array(F.transform(at, lambda i: F.array_join(F.slice(words, i, width), " ")))
    ranked = F.transform(
        F.array(every),
        lambda s: F.transform(s, lambda x, i: F.concat_ws(" ", x, i - F.array_position(s, x))),
    )
    return ranked[0]


def _fingerprints(windows: DataFrame, *by: str) -> DataFrame:
    """The SimHash of each window over its shingles, repeats included."""
    shingle = F.array_join(F.slice("words", F.col("pos") + 1, F.col("width")), " ")
    at = F.posexplode(F.slice("words", F.lit(1), F.size("words") - F.col("width") + 1))
    hashed = windows.select(*by, "words", "width", at.alias("pos", "word")).select(
        *by, F.xxhash64(shingle).alias("h")
    )
    sums = hashed.groupBy(*by).agg(F.count("*").alias("n"), *bit_sums(F.col("h")))
    return sums.select(*by, majority_bits(F.col("n")).alias("print"))


def _block(print_column: str, k: int) -> Column:
    return F.shiftrightunsigned(print_column, 8 * k).bitwiseAND(F.lit(255)).cast("int")


def _blocks(print_column: str) -> Column:
    return F.posexplode(F.array(*[_block(print_column, k) for k in range(BLOCKS)])).alias("block", "bits")


def _windows(docs: DataFrame, items: DataFrame, shingle: int, min_similarity: float) -> DataFrame:
    """Every item-sized window of a document that could be similar enough to an item.

    A window and an item of n words have equally many shingles, m, so a similarity
    of t takes 2tm / (1 + t) common ones. Windows in which fewer shingles occur in
    any item of that size need no fingerprint. Nothing else is left out.
    """
    found = []
    for width in [r[0] for r in items.select("width").distinct().collect()] or [shingle]:
        part = [F.get("words", F.col("pos") + i) for i in range(width)]
        placed = lambda df, *keep: df.select(
            *keep, "words", F.posexplode("words").alias("pos", "word")
        ).where(F.col("pos") <= F.size("words") - width).select(  # noqa: B023
            *keep, F.size("words").alias("total"), "pos", F.xxhash64(*part).alias("h")  # noqa: B023
        )
        known = placed(items.where(F.col("width") == width), "n_words").select("h", "n_words").distinct()
        hits = placed(docs, "key").join(_bounded(known), "h")
        found.append(hits.select("key", "n_words", F.lit(width).alias("width"), "total", "pos"))
    hits = reduce(DataFrame.unionByName, found)

    m = F.col("n_words") - F.col("width") + 1
    need = F.greatest(F.ceil(F.lit(2 * min_similarity / (1 + min_similarity)) * m - 1e-9), F.lit(1)).cast("int")
    grouped = (
        hits.groupBy("key", "n_words", "width")
        .agg(F.sort_array(F.collect_set("pos")).alias("hits"), F.max("total").alias("total"))
        .select("*", m.alias("m"), need.alias("need"))
        .where(F.size("hits") >= F.col("need"))
    )

    # a window belongs to its first hit, so each comes up once
    def span(i: Column) -> Column:
        before = F.when(i > 0, F.get("hits", i - 1) + 1).otherwise(F.lit(0))
        last = F.get("hits", i + F.col("need") - 1)
        low = F.greatest(before, last - F.col("m") + 1, F.lit(0))
        high = F.least(F.get("hits", i), F.col("total") - F.col("n_words"))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    firsts = F.sequence(F.lit(0), F.size("hits") - F.col("need"))
    starts = grouped.select(
        "key", "n_words", "width", F.flatten(F.transform(firsts, span)).alias("starts")
    ).where(F.size("starts") > 0)
    per_doc = stage(
        starts.groupBy("key").agg(F.collect_list(F.struct("n_words", "width", "starts")).alias("sizes")),
        "windows",
    )
    texts = docs.join(_bounded(per_doc.select("key")), "key", "left_semi").dropDuplicates(["key"])
    sized = texts.join(per_doc, "key").select("key", "words", F.explode("sizes").alias("size"))
    windows = sized.select("key", "words", "size", F.explode("size.starts").alias("start"))
    return windows.select(
        "key",
        "size.n_words",
        "size.width",
        "start",
        F.slice("words", F.col("start") + 1, F.col("size.n_words")).alias("words"),
    )


def find_items(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = 5,
    min_similarity: float = 0.8,
    block_bits: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and item that stands in it, with the best window.

    Words are lower-case runs of letters and digits. A window of as many words as
    the item matches if their weighted Jaccard similarity over shingles of
    ``shingle`` words, repeats counted, is ``min_similarity`` or more. An item of
    fewer words is one shingle of all of them.

    Windows and items have SimHash fingerprints of 64 bits, cut into eight blocks.
    If two fingerprints differ in at most 8 ``block_bits`` + 7 bits, some block
    differs in at most ``block_bits``; the index holds each item under all such
    values of each block, so every pair within that radius is a candidate. The
    exact similarity then decides. With the default the radius is 23 bits, where
    a similarity of 0.8 gives a mean distance of 10 and a deviation of 3.

    Returns ``doc_id``, ``item_id``, ``start_word`` (from 0), ``n_words``, ``bits``
    (distance of the fingerprints) and ``similarity``; of equally similar windows
    the first. Missing or empty texts and items have no words and match nothing.
    Repeated documents and items each get their rows; a missing id stays missing.
    An empty table gives no rows. No other column is read.
    """
    items = items.select(
        row_key(named(items, item_id), named(items, item_text)).alias("item"),
        named(items, item_id).alias("item_id"),
        normal_words(named(items, item_text)).alias("words"),
    ).where(F.size("words") > 0)
    n = F.size("words")
    items = stage(items.select("*", n.alias("n_words"), F.least(n, F.lit(shingle)).alias("width")), "items")
    distinct = items.dropDuplicates(["item"])
    keyed = docs.select(
        named(docs, doc_id).alias("doc_id"),
        row_key(named(docs, doc_id), named(docs, text)).alias("key"),
        normal_words(named(docs, text)).alias("words"),
    )
    windows = stage(
        _windows(keyed.select("key", "words"), distinct, shingle, min_similarity), "windows"
    )

    masks = [x for x in range(256) if x.bit_count() <= block_bits]
    index = (
        _fingerprints(distinct, "item")
        .join(distinct.select("item", "n_words"), "item")
        .select("item", "n_words", F.col("print").alias("item_print"), _blocks("print"))
        .select("*", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
        .select("item", "n_words", "item_print", "block", F.col("bits").bitwiseXOR(F.col("mask")).alias("bits"))
    )
    probes = _fingerprints(windows, "key", "n_words", "start").select(
        "key", "n_words", "start", "print", _blocks("print")
    )
    bits = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    # a pair that several blocks find counts at the first of them
    first = F.coalesce(
        *[
            F.when(F.bit_count(_block("print", k).bitwiseXOR(_block("item_print", k))) <= block_bits, F.lit(k))
            for k in range(BLOCKS)
        ]
    )
    candidates = (
        probes.join(index, ["n_words", "block", "bits"])
        .where((first == F.col("block")) & (bits <= BLOCKS * block_bits + BLOCKS - 1))
        .select("key", "n_words", "start", "item", bits.alias("distance"))
    )

    own = windows.select(
        "key", "n_words", "start", _shingles("words", F.col("width")).alias("own")
    )
    theirs = distinct.select("item", _shingles("words", F.col("width")).alias("theirs"))
    common = F.size(F.array_intersect("own", "theirs"))
    similarity = common / (F.size("own") + F.size("theirs") - common)
    best = (
        candidates.join(own, ["key", "n_words", "start"])
        .join(theirs, "item")
        .select("key", "item", "n_words", "start", "distance", similarity.alias("similarity"))
        .where(F.col("similarity") >= min_similarity)
        .groupBy("key", "item")
        .agg(
            F.min_by(
                F.struct("start", "n_words", "distance", "similarity"),
                F.struct(-F.col("similarity"), "start"),
            ).alias("best")
        )
    )
    return (
        keyed.select("doc_id", "key")
        .join(best, "key")
        .join(items.select("item", "item_id"), "item")
        .select(
            "doc_id",
            "item_id",
            F.col("best.start").cast("long").alias("start_word"),
            F.col("best.n_words").cast("long").alias("n_words"),
            F.col("best.distance").alias("bits"),
            F.col("best.similarity").alias("similarity"),
            "key",
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents in which no item stands; columns as in ``docs``.

    Takes the options of ``find_items``, whose rules for missing and empty values hold.
    """
    key = free_name(docs, "key")
    found = find_items(docs, items, **options).select(F.col("key").alias(key)).distinct()
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    keyed = docs.withColumn(key, row_key(named(docs, doc_id), named(docs, text)))
    return keyed.join(found, key, "left_anti").drop(key)
