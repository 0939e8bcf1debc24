"""Ranked lexical search: documents that look the same to the items are scored once.

Restricted to the words of the items, a document is a vector of term frequencies
and a number for its length. Documents that agree in both are one class: they have
the same score for every item, so the class is scored and its members are listed.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm.common import named, stage
from tableferry.llm.pieces import groups

# A byte of a term as it is, A-Z in lower case, any other as a space. Bytes from
# 0x80 are parts of characters, which are all part of terms.
_TERM_BYTES = bytes(
    ord(chr(b).lower()) if b < 0x80 and chr(b) in string.ascii_letters + string.digits
    else b if b >= 0x80 else 0x20
    for b in range(256)
)

# Bytes of the table of items and terms that a task holds, and of the scores of a batch.
BLOCK_BYTES = 32 << 20
# Whole numbers up to here are exact as doubles.
EXACT = 1 << 53


def term_lists(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The terms of all texts in a row, and for each the number of its text."""
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1]
    low, high = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    data = texts.buffers()[2]
    plain = (data.slice(low, high - low).to_pybytes() if data else b"").translate(_TERM_BYTES)
    spaced = pa.StringArray.from_buffers(
        len(texts), pa.py_buffer((offsets - low).astype(np.int32)), pa.py_buffer(plain)
    )
    lists = pc.ascii_split_whitespace(spaced)
    words = lists.flatten()
    row = np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))
    some = np.asarray(pc.binary_length(words)) > 0
    return row[some], words.filter(pa.array(some))


def _vectors(docs: DataFrame, vocabulary: list[str], doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``n`` terms, and those of the vocabulary as ``terms`` with their ``tfs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for batch in batches:
            for part in groups(batch):
                size = part.num_rows
                row, words = term_lists(part.column(1))
                found = pc.index_in(words, value_set=known)
                there = np.asarray(found.is_valid())
                code = row[there] * max(len(known), 1) + np.asarray(found.drop_null(), np.int64)
                code, tfs = np.unique(code, return_counts=True)
                of_row, terms = np.divmod(code, max(len(known), 1))
                ends = np.searchsorted(of_row, np.arange(size + 1)).astype(np.int32)
                columns = [
                    part.column(0),
                    pa.array(np.bincount(row, minlength=size), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(tfs, pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

    given = docs.select(named(docs, doc_id).alias("doc_id"), named(docs, text).alias("text"))
    made = (F.lit(0).cast("long").alias("n"), F.array().cast("array<int>").alias("terms"))
    schema = given.select("doc_id", *made, F.array().cast("array<bigint>").alias("tfs")).schema
    return given.mapInArrow(run, schema)


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, list[str]]]]:
    """The items with their distinct terms, as many at a time as a task's table has room for."""
    block, vocabulary = [], set()
    for item_id, text in items.toLocalIterator():
        terms = pc.unique(term_lists(pa.array([text], pa.string()))[1]).to_pylist()
        more = vocabulary | set(terms)
        if block and (len(block) + 1) * len(more) * 8 > BLOCK_BYTES:
            yield block
            block, more = [], set(terms)
        block.append((item_id, terms))
        vocabulary = more
    if block:
        yield block


def _best(
    classes: Iterator[pa.RecordBatch], weights: np.ndarray, items: list[list[int]], top: int
) -> Iterator[pa.RecordBatch]:
    """For each item the best ``top`` classes of a task: score, smallest doc_id, first members.

    Any other class comes after ``top`` documents, the smallest of each better one.
    """
    # sums of products that stay exact in doubles are left to the matrix product of doubles
    largest = max(map(len, items), default=0) * max(abs(weights).max(initial=0), 1) * 10**6
    kind = np.float64 if largest < EXACT else np.int64
    table = np.zeros((len(weights), len(items)), kind)
    for item, terms in enumerate(items):
        table[terms, item] = 1
    best: list[list[tuple]] = [[] for _ in items]
    floor = np.ones(len(items))  # a score has to be above 0
    step, count = max(1, BLOCK_BYTES // (8 * max(1, len(weights)))), 0
    for batch in classes:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            m, terms, tfs, members = part.columns
            row = np.repeat(np.arange(part.num_rows), np.asarray(pc.list_value_length(terms)))
            of_term = np.asarray(terms.flatten())
            tf = np.asarray(tfs.flatten(), np.int64)
            grade = (10**9 * tf) // (1000 * tf + 20 * np.asarray(m, np.int64)[row])
            worth = np.zeros((part.num_rows, len(weights)), kind)
            worth[row, of_term] = weights[of_term] * grade
            scores = worth @ table
            for item in range(len(items)):
                column = scores[:, item]
                hits = np.flatnonzero(column >= floor[item])
                if len(hits) > top:
                    hits = hits[column[hits] >= np.partition(column[hits], -top)[-top]]
                for i in hits.tolist():
                    listed = members[i].as_py()
                    count += 1
                    best[item].append((-int(column[i]), listed[0] is None, listed[0], count, listed))
                if len(best[item]) >= 2 * top:
                    best[item].sort()
                    del best[item][top:]
                    floor[item] = -best[item][-1][0]
    for found in best:
        found.sort()
        del found[top:]
    kept = [(item, *entry) for item, found in enumerate(best) for entry in found]
    if kept:
        columns = [
            pa.array([k[0] for k in kept], pa.int32()),
            pa.array([-k[1] for k in kept], pa.int64()),
            pa.array([k[5] for k in kept], members.type),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["item", "score", "members"])


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``top`` best documents of each item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Terms are the runs of ASCII letters, digits and all characters from U+0080, with
    A-Z in lower case. N documents have terms, L in all; df of them have a term. It
    weighs w = floor(1000 ln((2N + 2) / (2 df + 1))). A document of n terms has
    m = 50 + (50 n N) div L, and scores the sum of w ((10^9 tf) div (1000 tf + 20 m))
    over the distinct terms of the item. Only scores above 0 count; of equal ones the
    smaller doc_id ranks first, a missing one last.

    Documents are rows, so a repeated row ranks as often as it stands there. Items are
    the distinct (item_id, text). A missing or empty text has no terms; an item
    without terms, and any item if the table of documents is empty, has no rows.
    Other columns are not read, so they may have any name.

    The items are worked on in blocks whose words and scores fit into a task, each
    against all documents. A class keeps its ``top`` smallest doc_ids, as no more of
    them can be listed; each task keeps ``top`` classes of an item.
    """
    spark = docs.sparkSession
    asked = items.select(
        named(items, item_id).alias("item_id"), named(items, item_text).alias("text")
    ).distinct()
    id_type = asked.schema["item_id"].dataType
    totals, found = None, None
    for block in _blocks(asked):
        vocabulary = sorted({t for _, terms in block for t in terms})
        vectors = stage(_vectors(docs, vocabulary, doc_id, text), "vectors")
        if totals is None:
            totals = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        n_docs, n_terms = totals
        held = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weights = np.array(
            [
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(t, 0) + 1)))
                for t in range(len(vocabulary))
            ],
            np.int64,
        )
        place = {term: t for t, term in enumerate(vocabulary)}
        wanted = [[place[t] for t in terms] for _, terms in block]

        length = F.lit(50 * n_docs).cast("decimal(20,0)") * F.col("n").cast("decimal(18,0)")
        bags = (
            vectors.where(F.size("terms") > 0)
            .withColumn("whole", length)
            .withColumn("m", F.lit(50) + F.expr(f"whole div {max(n_terms, 1)}"))
            .select(F.xxhash64("m", "terms", "tfs").alias("bag"), "m", "terms", "tfs", "doc_id")
        )
        # dealt by the hash, told apart by the vectors themselves
        same = ["bag", "m", "terms", "tfs"]
        by_id = Window.partitionBy(*same).orderBy(F.asc_nulls_last("doc_id"))
        first = bags.withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= top)
        listed = F.array_sort(F.collect_list(F.struct("nth", "doc_id")))
        classes = first.groupBy(*same).agg(listed["doc_id"].alias("members"))
        scored = classes.select("m", "terms", "tfs", "members").mapInArrow(
            lambda batches: _best(batches, weights, wanted, top),
            classes.select(F.lit(0).alias("item"), F.lit(0).cast("long").alias("score"), "members").schema,
        )
        names = spark.createDataFrame(
            [(i, item) for i, (item, _) in enumerate(block)],
            asked.select(F.lit(0).alias("item"), "item_id").schema,
        )
        ranked = _ranked(_ranked(scored, top, F.get("members", F.lit(0))), top)
        # at most one row for each item of the block
        part = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        part = stage(part, "ranked")
        found = part if found is None else found.unionByName(part)
    if found is None:
        ids = docs.select(named(docs, doc_id).alias("doc_id")).schema["doc_id"].dataType
        kind = f"item_id {id_type.simpleString()}, rank int, doc_id {ids.simpleString()}, score long"
        return spark.createDataFrame([], kind)
    return found


def _ranked(scored: DataFrame, top: int, first=None) -> DataFrame:
    """The best ``top`` rows of each item; classes by their first member, or else documents."""
    if first is None:
        scored = scored.select("item", "score", F.explode("members").alias("doc_id"))
        first = F.col("doc_id")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last(first))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
