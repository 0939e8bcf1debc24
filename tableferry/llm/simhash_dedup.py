"""Near-duplicates by SimHash: fingerprints, a binary trie self-join, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import (
    ascii_lower,
    bit_sums,
    free_name,
    join_hot,
    majority_bits,
    named,
    row_key,
    stage,
    words,
)

# Fingerprints in a trie node that one task takes on, and bits per level above that.
LEAF_ROWS = 4096
STRIDE = 6
# Node pairs that a task expands at a time.
FRONTIER = 1 << 18


def fingerprints(docs: DataFrame, shingle: int, doc_id: str, text: str) -> DataFrame:
    """``key``, ``doc_id`` and ``fingerprint`` of each row; zero where there is no word."""
    keyed = docs.select(
        row_key(named(docs, doc_id), named(docs, text)).alias("key"),
        words(ascii_lower(named(docs, text))).alias("words"),
    )
    parts = [F.get("words", F.col("pos") + i) for i in range(shingle)]
    # concat_ws leaves out what lies past the end, so a short text is one shingle
    hashed = (
        keyed.select("key", "words", F.posexplode("words").alias("pos", "word"))
        .where(F.col("pos") <= F.greatest(F.size("words") - shingle, F.lit(0)))
        .select("key", F.xxhash64(F.concat_ws(" ", *parts)).alias("h"))
    )
    sums = hashed.groupBy("key").agg(F.count("*").alias("n"), *bit_sums(F.col("h")))
    prints = sums.select("key", majority_bits(F.col("n")).alias("fingerprint"))
    rows = docs.select(
        row_key(named(docs, doc_id), named(docs, text)).alias("key"),
        named(docs, doc_id).alias("doc_id"),
    )
    zero = F.coalesce("fingerprint", F.lit(0).cast("long")).alias("fingerprint")
    return rows.join(prints, "key", "left").select("key", "doc_id", zero)


def _prefix(depth: int) -> Column:
    """The first ``depth`` bits of a fingerprint: the name of its trie node there."""
    return F.shiftrightunsigned("fingerprint", 64 - depth) if depth else F.lit(0).cast("long")


def trie_links(prints: DataFrame, max_bits: int, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Links that connect distinct fingerprints within ``max_bits`` bits of each other.

    Pairs of trie nodes are walked down together from the root. The bits in which
    their paths differ add up, and a pair over the budget is dropped with all
    below it. Pairs of large nodes are expanded by joins, ``STRIDE`` levels at a
    time; once both nodes are small, one task walks the rest bit by bit. It gives
    back a spanning forest of the links it found, so a dense group yields about
    as many links as it has fingerprints.
    """
    spark = prints.sparkSession
    root = prints.limit(1).select(
        F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("err")
    )
    pairs = stage(root, "trie-root")  # else its constants would turn the first joins into products
    depth, large, ready = 0, prints.count() > leaf_rows, []
    while large and depth < 64:
        step = min(STRIDE, 64 - depth)
        depth += step
        nodes = stage(prints.groupBy(_prefix(depth).alias("node")).count(), "trie-nodes")
        below = nodes.withColumn("parent", F.shiftrightunsigned("node", step))
        left = below.toDF("ca", "size_a", "a")
        right = below.toDF("cb", "size_b", "b")
        grown = F.col("err") + F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")).bitwiseAND(F.lit((1 << step) - 1)))
        pairs = (
            pairs.join(left, "a")
            .join(right, "b")
            .where((F.col("a") < F.col("b")) | (F.col("ca") <= F.col("cb")))
            .where(grown <= max_bits)
            .select(
                F.col("ca").alias("a"),
                F.col("cb").alias("b"),
                grown.cast("int").alias("err"),
                (F.greatest("size_a", "size_b") <= leaf_rows).alias("small"),
            )
        )
        pairs = stage(pairs, "trie-pairs")
        over = nodes.where(F.col("count") > leaf_rows).select("node")
        ready.append((depth, pairs.where("small").drop("small"), over))
        pairs = pairs.where("not small").drop("small")
        large = bool(pairs.take(1))
    if not ready:  # the root itself is small
        ready.append((depth, pairs, None))

    found = spark.createDataFrame([], "u long, v long")
    for at, some, over in ready:
        placed = prints.select(_prefix(at).alias("node"), "fingerprint")
        if over is not None:  # no pair here has a large node; Spark broadcasts these if they are few
            placed = placed.join(over, "node", "left_anti")
        nodes = placed.groupBy("node").agg(F.collect_list("fingerprint").alias("prints"))
        sides = some.join(nodes.toDF("a", "left"), "a").join(nodes.toDF("b", "right"), "b")
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        walked = sides.repartition(tasks, "a", "b").select("left", "right", F.lit(at).alias("depth"), "err").mapInPandas(
            lambda parts: _walk_parts(parts, max_bits), "u long, v long"
        )
        found = found.unionByName(walked)
    return found


def _walk_parts(parts: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    for part in parts:
        for left, right, depth, err in part.itertuples(index=False):
            u, v = walk_pair(
                np.asarray(left, np.int64).view(np.uint64),
                np.asarray(right, np.int64).view(np.uint64),
                int(depth),
                int(err),
                max_bits,
            )
            yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})


def walk_pair(
    left: np.ndarray, right: np.ndarray, depth: int, err: int, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Walk two trie nodes at ``depth`` together; the links found, as a spanning forest.

    A node below is a range of the sorted fingerprints, and a frontier of node
    pairs goes down one bit at a time. A pair of single fingerprints is compared
    at once. Large frontiers are cut, which bounds the memory.
    """
    left, right = np.sort(left), np.sort(right)
    same = len(left) == len(right) and bool((left == right).all())
    start = np.array([[0], [len(left)], [0], [len(right)], [err]], np.int64)
    todo, links = [(depth, start)], []
    while todo:
        at, front = todo.pop()
        a0, a1, b0, b1, bits = front
        if same:  # a range against itself or one further right
            front = front[:, (a0 < b0) | ((a0 == b0) & (a1 - a0 > 1))]
            a0, a1, b0, b1, bits = front
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            u, v = left[a0[single]], right[b0[single]]
            near = np.bitwise_count(u ^ v) <= max_bits
            links.append((u[near], v[near]))
            front = front[:, ~single]
            a0, a1, b0, b1, bits = front
        if at == 64 or not front.shape[1]:
            continue
        if front.shape[1] > FRONTIER:
            half = front.shape[1] // 2
            todo += [(at, front[:, :half]), (at, front[:, half:])]
            continue
        am, bm = _split(left, a0, a1, at), _split(right, b0, b1, at)
        straight = [np.stack([a0, am, b0, bm, bits]), np.stack([am, a1, bm, b1, bits])]
        crossed = [np.stack([a0, am, bm, b1, bits + 1]), np.stack([am, a1, b0, bm, bits + 1])]
        if same:  # of a range against itself, one crossed pair says it all
            crossed[1] = crossed[1][:, a0 != b0]
        below = np.concatenate(straight + crossed, axis=1)
        full = (below[1] > below[0]) & (below[3] > below[2]) & (below[4] <= max_bits)
        todo.append((at + 1, below[:, full]))
    if not links:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return _forest(np.concatenate([x[0] for x in links]), np.concatenate([x[1] for x in links]))


def _split(values: np.ndarray, low: np.ndarray, high: np.ndarray, at: int) -> np.ndarray:
    """Where, in each range of equal first ``at`` bits, the next bit turns to one."""
    bit = np.uint64(63 - at)
    first = values[low] >> bit | np.uint64(1)
    return np.clip(np.searchsorted(values, first << bit), low, high)


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint linked to the least one it is connected with."""
    names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(names))
    return names[moved], names[label[moved]]


def components(links: DataFrame) -> DataFrame:
    """``node`` and its ``root``, the least node it is connected with; linked nodes only.

    Large-star and small-star steps in turn: each node points its neighbours to
    the least of them, until every node points at a root. The minima are
    aggregated, so no neighbourhood is gathered in one place.
    """

    edges = stage(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), "m")
        large = stage(moved.where("u <> m").distinct().toDF("u", "v"), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), "m").unionByName(least)
        edges = stage(moved.where("u <> m").distinct().toDF("u", "v"), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    max_bits: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key``, ``doc_id``, ``fingerprint`` and ``component_id`` of every row.

    Words are the runs of characters other than [\\x20\\x09-\\x0D] in the text with A-Z
    in lower case; shingles of ``shingle`` words, repeats included, are joined by
    spaces and hashed with XXH64 (seed 42). A bit of the fingerprint is one if it
    is set in over half the hashes. Fingerprints that differ in at most
    ``max_bits`` bits are linked, and ``component_id`` is the smallest doc_id that
    links lead to.

    A text of fewer words is one shingle; a missing or empty one has fingerprint
    zero, which is linked like any other. Repeated rows give repeated results. A
    component whose doc_ids are all missing has a missing id. An empty table gives
    no rows. Only the two columns are read, so others may have any name.
    """
    rows = stage(fingerprints(docs, shingle, doc_id, text), "prints")
    same = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    prints = stage(same, "distinct-prints")
    roots = components(trie_links(prints.select("fingerprint"), max_bits))
    rooted = prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "copies", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = stage(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = stage(rooted.join(ids, "root").select("fingerprint", "copies", "root", "component_id"), "labels")
    return join_hot(rows, labels, "fingerprint", "copies").select(
        "key", "doc_id", "fingerprint", "component_id", F.col("root").alias("component")
    )


def keep_one(
    docs: DataFrame,
    shingle: int = 3,
    max_bits: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents without near-duplicates: of each component the smallest doc_id stays.

    A missing doc_id comes after all others; among equal ones the text decides. Of
    repeated rows one stays. The columns are those of ``docs``.
    """
    found = near_duplicates(docs, shingle, max_bits, doc_id, text)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    key = free_name(docs, "key")
    chosen = found.groupBy("component").agg(F.min(order).alias("first")).select(
        F.col("first.key").alias(key)
    )
    keyed = docs.withColumn(key, row_key(named(docs, doc_id), named(docs, text)))
    return keyed.join(chosen, key, "left_semi").dropDuplicates([key]).drop(key)
