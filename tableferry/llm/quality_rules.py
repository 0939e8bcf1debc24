"""Rule measures and a hashed n-gram likelihood ratio for every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import WHITE, count_of, free_name, named, row_key, stage, words

SYMBOLS = "#*$%&|<>"
# Up to so many trusted ids are sent to all executors, about 50 MB.
BROADCAST_ROWS = 500_000
# Weights are whole multiples of this, so that sums do not depend on their order.
UNIT = 1 << 20


def _repeated_words(words_column: str, n: int) -> Column:
    """How many words lie in windows of ``n`` words that the text holds twice or more."""
    at = F.sequence(F.lit(0), F.size(words_column) - n)
    windows = F.transform(at, lambda i: F.xxhash64(*[F.get(words_column, i + k) for k in range(n)]))

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = F.transform(
            F.array(ordered),
            lambda s: F.filter(
                s,
                lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
            ),
        )[0]
        places = F.array(F.sort_array(F.transform(twice, lambda x: x["i"])))
        steps = F.transform(
            places,
            lambda p: F.transform(
                p, lambda x, j: F.least(F.coalesce(F.get(p, j + 1) - x, F.lit(n)), F.lit(n))
            ),
        )[0]
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    counted = F.transform(
        F.array(windows),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
    )[0]
    return F.when(F.size(words_column) > n, counted).otherwise(F.lit(0)).cast("long")


def measures(docs: DataFrame, words_column: str, text: str) -> dict[str, Column]:
    """The rule measures of a document as columns; a missing text has none of anything."""
    whole = F.coalesce(named(docs, text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    return {
        "n_words": F.size(words_column).cast("long"),
        "word_chars": F.char_length(whole).cast("long") - count_of(whole, WHITE),
        "n_symbols": count_of(whole, SYMBOLS),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _repeated_words(words_column, 5),
    }


def _buckets(n_buckets: int) -> list[Column]:
    """The buckets of the word at hand and of the pair that begins with it."""
    pair = F.when(F.get("words", F.col("pos") + 1).isNotNull(), F.xxhash64("word", F.get("words", F.col("pos") + 1)))
    return [F.pmod(h, F.lit(n_buckets)) for h in (F.xxhash64("word"), pair)]


def gram_weights(keyed: DataFrame, trusted: DataFrame, n_buckets: int, smooth: float) -> DataFrame:
    """``bucket`` and ``weight``: the log of its share in trusted text over that in all text.

    Shares are of the words and word pairs of all documents, smoothed by
    ``smooth`` in each bucket. There are at most ``n_buckets`` rows.
    """
    ids = trusted.distinct().withColumn("trusted", F.lit(1))
    if trusted.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    flagged = keyed.join(ids, "doc_id", "left")
    grams = flagged.select("trusted", "words", F.posexplode("words").alias("pos", "word")).select(
        "trusted", F.explode(F.array(*_buckets(n_buckets))).alias("bucket")
    )
    counts = (
        grams.where("bucket is not null")
        .groupBy("bucket")
        .agg(F.count("*").alias("n_all"), F.count("trusted").alias("n_trusted"))
    )
    counts = stage(counts, "grams")
    total, chosen = counts.agg(F.sum("n_all"), F.sum("n_trusted")).first()
    if not chosen:  # nothing to compare with
        return counts.select("bucket", F.lit(0).cast("long").alias("weight"))
    share = (F.col("n_trusted") + smooth) / (chosen + smooth * n_buckets)
    every = (F.col("n_all") + smooth) / (total + smooth * n_buckets)
    return counts.select("bucket", F.round(F.log(share / every) * UNIT).cast("long").alias("weight"))


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: float = -0.15,
    n_buckets: int = 1 << 16,
    smooth: float = 1.0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents with rule measures, ``llr``, ``base_failed`` and ``kept``.

    ``n_words`` counts the runs of characters other than [\\x20\\x09-\\x0D],
    ``word_chars`` their code points, ``n_symbols`` the characters #*$%&|<>,
    ``n_dup_lines`` the lines with a word that equal an earlier line, and
    ``n_repeat_words`` the words in windows of five words that the text holds twice
    or more, the first included. ``base_failed``: under ten words, or over a fifth
    of the words repeated.

    ``llr`` is the mean, over the words and word pairs of the text, of the log of
    their share in trusted text over their share in all text; both are hashed into
    ``n_buckets``. ``trusted`` has the doc_ids of trusted documents. A document is
    kept if it did not fail and ``llr`` is at least ``threshold``; no chance is
    involved.

    A missing or empty text has no words, an ``llr`` of zero, and fails. Repeated
    rows get equal results, and each counts in the shares. With no trusted
    document every ``llr`` is zero. An empty table gives no rows. Columns of the
    same names as the added ones are replaced.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    docs = docs.drop(*added, "llr", "base_failed", "kept")
    slim = docs.select(
        named(docs, doc_id).alias("doc_id"),
        row_key(named(docs, doc_id), named(docs, text)).alias("key"),
        words(named(docs, text)).alias("words"),
    )
    ids = trusted.select(F.col(trusted.columns[0]).alias("doc_id")).where("doc_id is not null")
    weights = gram_weights(slim.select("doc_id", "words"), ids, n_buckets, smooth)
    # at most n_buckets rows
    first = F.broadcast(weights.toDF("one", "weight_one"))
    second = F.broadcast(weights.toDF("two", "weight_two"))
    one, two = _buckets(n_buckets)
    scored = (
        slim.select("key", "words", F.posexplode("words").alias("pos", "word"))
        .select("key", one.alias("one"), two.alias("two"))
        .join(first, "one")
        .join(second, "two", "left")
        .groupBy("key")
        .agg(
            F.sum(F.col("weight_one") + F.coalesce("weight_two", F.lit(0).cast("long"))).alias("sum"),
            (F.count("weight_one") + F.count("weight_two")).alias("grams"),
        )
    )

    key, llr, split = (free_name(docs, x) for x in ("key", "llr", "words"))
    scores = scored.select(F.col("key").alias(key), (F.col("sum") / F.col("grams") / UNIT).alias(llr))
    wide = docs.withColumns(
        {
            key: row_key(named(docs, doc_id), named(docs, text)),
            split: words(named(docs, text)),
        }
    )
    judged = wide.withColumns(measures(wide, split, text)).drop(split).join(scores, key, "left")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        judged.withColumns({"llr": F.coalesce(llr, F.lit(0.0)), "base_failed": failed})
        .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
        .drop(key, llr)
    )
