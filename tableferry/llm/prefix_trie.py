"""The prefix trie of conversations, as intervals of their sorted sequences.

The distinct sequences of turns are sorted, and next to each stands the number of
turns that it shares with the one before, its LCP. The members of a prefix are then
a run of sequences between which no LCP is smaller than the prefix is long. Each
prefix finds the two ends of its run by itself, by a binary search over a sparse
table of range minima.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm.common import join_hot, stage

# Bytes of a turn in the key of a sequence.
TURN = 16
# Turns of sequences that are worked on together, and ids whose text is one row.
CHUNK_TURNS = 1 << 18
BLOCK_IDS = 4096

_NOTHING = hashlib.sha256(b"").hexdigest()
_NODE = (
    "node binary, parent binary, depth long, conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string"
)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` from 1, ``role`` and ``text``, by turn, a missing one first.

    Equal turns follow each other by role and text. A missing role or text is empty.
    Rows without a conv_id belong to no conversation and are left out.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.row_number().over(order).cast("long").alias("place"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def share_beginnings(messages: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on others, and all their ids, with turns or without.

    Conversation c begins with the first h turns of c - c % every, as many as that
    has, and goes on with its own turns after its first h; h = crc32(c) % most.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = messages.select("conv_id").distinct()
    begun = convs.select(
        F.col("conv_id").alias("conv"), (F.col("conv_id") - F.col("conv_id") % every).alias("conv_id"), h.alias("h")
    )
    shared = messages.where((F.col("place") < most) & (F.col("conv_id") % every == 0))
    first = shared.join(begun, "conv_id").where("place <= h").select(
        F.col("conv").alias("conv_id"), "place", "role", "text"
    )
    own = messages.where(F.col("place") > h).withColumn("place", F.col("place") + most)
    return first.unionByName(own), convs


def _keys(messages: DataFrame, convs: DataFrame) -> DataFrame:
    """For each conversation the ``key`` of its turns, 16 bytes each, and their ``chars``."""
    name = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    turns = messages.select(
        "conv_id", F.struct("place", F.md5(name).alias("turn"), F.char_length("text").cast("long").alias("chars")).alias("t")
    )
    told = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    key = F.coalesce(F.unhex(F.array_join("t.turn", "")), F.unhex(F.lit("")))
    chars = F.coalesce("t.chars", F.array().cast("array<bigint>"))
    return convs.join(told, "conv_id", "left").select(
        "conv_id", F.unhex(F.md5(key)).alias("seq"), key.alias("key"), chars.alias("chars")
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (seq, n, first, ids) sorted by seq and first: one row for each seq, the ids hashed."""
    names = ["seq", "n", "first", "ends_sha256"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    last = None
    for batch in batches:
        done = []
        for seq, n, first, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if last and last[0] == seq:
                last[1] += n
                last[3].update(b"," + ids.encode())
                continue
            if last:
                done.append(last)
            last = [seq, n, first, hashlib.sha256(ids.encode())]
        yield _rows(done, names, kinds)
    yield _rows([last] if last else [], names, kinds)


def _rows(done: list, names: list[str], kinds: list) -> pa.RecordBatch:
    shown = [[*row[:3], row[3].hexdigest()] for row in done]
    columns = zip(*shown) if shown else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _distinct(keyed: DataFrame) -> DataFrame:
    """The distinct sequences: ``key``, ``chars``, ``n`` conversations, their ``first`` and the hash of all.

    The ids of a sequence become text in blocks of neighbouring ids; a task then
    hashes the blocks in order, one at a time.
    """
    ids = F.array_sort(F.collect_list("conv_id"))
    block = F.floor(F.col("conv_id") / F.lit(BLOCK_IDS))
    blocks = keyed.groupBy("seq", block.alias("block")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"), F.array_join(ids, ",").alias("ids")
    )
    sorted_blocks = blocks.repartition("seq").sortWithinPartitions("seq", "first").select("seq", "n", "first", "ids")
    kinds = "seq binary, n long, first long, ends_sha256 string"
    ends = sorted_blocks.mapInArrow(_digests, kinds).withColumnRenamed("seq", "same")
    return keyed.join(ends, (F.col("conv_id") == F.col("first")) & (F.col("seq") == F.col("same"))).select(
        "key", "chars", "n", "first", "ends_sha256"
    )


def shared_turns(a: bytes, b: bytes) -> int:
    """How many turns two keys have in common from the start."""
    n = min(len(a), len(b)) // TURN
    same = np.frombuffer(a, np.int64, 2 * n) == np.frombuffer(b, np.int64, 2 * n)
    return n if same.all() else int(same.argmin()) // 2


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the turns they share with the one before and the one after; null at the ends."""
    held, before = None, None
    for batch in batches:
        keys = batch.column("key").to_pylist()
        if not keys:
            continue
        whole = pa.Table.from_batches([held, batch] if held else [batch]).combine_chunks()
        keys = [held.column("key")[0].as_py(), *keys] if held else keys
        lcps = [shared_turns(a, b) for a, b in zip(keys, keys[1:])]
        rows = whole.to_batches()[0]
        yield _with_lcps(rows.slice(0, len(lcps)), [before, *lcps][:-1], lcps)
        before, held = (lcps[-1] if lcps else before), rows.slice(len(lcps))
    if held:
        yield _with_lcps(held, [before], [None])


def _with_lcps(rows: pa.RecordBatch, before: list, after: list) -> pa.RecordBatch:
    columns = [*rows.columns, pa.array(before, pa.int64()), pa.array(after, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, [*rows.schema.names, "lcp", "lcp_next"])


def _sorted_with_lcps(sequences: DataFrame) -> DataFrame:
    """The sequences in order, dealt by ranges, each with its ``lcp`` and the next one's, -1 at the ends.

    Within a task both are seen as the rows go by. Between tasks they come from
    the first and last key of each task, which is one row per task.
    """
    ranged = sequences.repartitionByRange("key").sortWithinPartitions("key").withColumn(
        "nth", F.monotonically_increasing_id()
    )
    kinds = ranged.withColumns({"lcp": F.lit(None).cast("long"), "lcp_next": F.lit(None).cast("long")}).schema
    placed = stage(ranged.mapInArrow(_neighbours, kinds), "sorted")
    part = F.shiftright("nth", 33)
    edges = placed.where("lcp is null or lcp_next is null").groupBy(part.alias("part")).agg(
        F.min("key").alias("low"), F.max("key").alias("high")
    )
    by_part = Window.orderBy("part")
    met = edges.select("part", "low", F.lag("high").over(by_part).alias("high"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, low, high = (c.to_pylist() for c in batch.columns)
            shared = [-1 if b is None else shared_turns(a, b) for a, b in zip(low, high)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(shared, pa.int64())], ["part", "met"])

    starts = met.mapInArrow(meet, "part long, met long")
    borders = stage(starts.withColumn("met_next", F.lead("met", 1, -1).over(by_part)), "borders")
    return placed.join(F.broadcast(borders), part == F.col("part")).select(
        "nth",
        "key",
        "chars",
        "n",
        "first",
        "ends_sha256",
        F.coalesce("lcp", "met").alias("lcp"),
        F.coalesce("lcp_next", "met_next").alias("lcp_next"),
    )


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs of 1, 2, 4, ... values: ``table[k][i]`` is that of 2^k values from i."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        last, half = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(last[:-half], last[half:]))
    return table


def right_ends(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last row up to which no LCP after ``row`` is less than ``depth``."""
    end, n = row.copy(), len(table[0])
    for k in range(len(table) - 1, -1, -1):
        fits = end + (1 << k) < n
        least = table[k][np.where(fits, end + 1, 0)]
        end = np.where(fits & (least >= depth), end + (1 << k), end)
    return end


def left_ends(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first row from which on to ``row`` no LCP is less than ``depth``."""
    end = row.copy()
    for k in range(len(table) - 1, -1, -1):
        at = end - (1 << k) + 1
        fits = at >= 1  # the LCP of row 0 lies outside
        least = table[k][np.where(fits, at, 0)]
        end = np.where(fits & (least >= depth), end - (1 << k), end)
    return end


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Runs of neighbouring rows of about ``CHUNK_TURNS`` turns."""
    chunk, turns = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if chunk and (turns > CHUNK_TURNS or row[0] != chunk[-1][0] + 1):
                yield chunk
                chunk, turns = [], 0
            chunk.append(row)
            turns += 1 + len(row[2])
    if chunk:
        yield chunk


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches):
        yield chunk_nodes(chunk)


def chunk_nodes(chunk: list[tuple]) -> pa.RecordBatch:
    """What a run of sorted sequences adds to each node that it has members of.

    Sums and minima over the chunks give the whole, as every count is taken at the
    row, of all rows, where it is new: LCPs are those of the whole order.
    """
    _, keys, chars, n, first, ends, lcp, lcp_next = zip(*chunk)
    n, first, lcp, lcp_next = (np.array(x, np.int64) for x in (n, first, lcp, lcp_next))
    size = np.array([len(c) for c in chars], np.int64)
    inside = lcp.copy()
    inside[0] = -1  # the first row speaks for all of its prefixes here
    table, least = sparse_table(inside), sparse_table(first)

    # characters up to each turn, row by row
    base = np.concatenate([[0], np.cumsum(size + 1)])
    upto = np.concatenate([np.concatenate([[0], np.cumsum(c, dtype=np.int64)]) for c in chars])
    whole = upto[base[1:] - 1]
    fresh = whole - upto[base[:-1] + np.maximum(lcp, 0)]

    # a prefix for each depth at which a row differs from the one before
    count = size - inside
    row = np.repeat(np.arange(len(chunk)), count)
    begin = np.concatenate([[0], np.cumsum(count)])
    depth = np.arange(len(row)) - begin[row] + inside[row] + 1
    right, above = right_ends(table, row, depth), left_ends(table, row, depth - 1)
    parent = np.where(depth > 0, begin[above] + depth - 1 - inside[above] - 1, -1)

    members = np.concatenate([[0], np.cumsum(n)])
    leaves = np.concatenate([[0], np.cumsum(lcp_next < size)])
    texts = np.concatenate([[0], np.cumsum(n * whole)])
    news = np.concatenate([[0], np.cumsum(fresh)])
    top = np.maximum(depth - 1, 0)
    n_convs = members[right + 1] - members[row]
    own = whole[row] - upto[base[row] + np.maximum(lcp[row], top)]
    distinct = news[right + 1] - news[row + 1] + own
    saved = texts[right + 1] - texts[row] - n_convs * upto[base[row] + top] - distinct
    new = depth > lcp[row]
    children = np.bincount(parent[new & (depth > 0)], minlength=len(row))
    power = np.frexp(right - row + 1)[1] - 1
    smallest = np.empty(len(row), np.int64)
    for k, mins in enumerate(least):
        some = power == k
        smallest[some] = np.minimum(mins[row[some]], mins[right[some] - (1 << k) + 1])

    names, path = [], []
    for key, turns, shared in zip(keys, size.tolist(), inside.tolist()):
        del path[shared + 1 :]
        for at in range(shared + 1, turns + 1):
            told = path[-1] + key[TURN * (at - 1) : TURN * at] if at else b""
            path.append(hashlib.md5(told).digest())
        names += path[shared + 1 :]
    listed = np.array([*names, None], object)
    hashes = [ends[r] if last else None for r, last in zip(row.tolist(), (depth == size[row]).tolist())]
    numbers = (depth, smallest, n_convs, children, leaves[right + 1] - leaves[row], saved)
    columns = [
        pa.array(names, pa.binary()),
        pa.array(listed[parent].tolist(), pa.binary()),
        *[pa.array(x, pa.int64()) for x in numbers],
        pa.array(hashes, pa.string()),
    ]
    names = [field.split()[0] for field in _NODE.split(",")]
    return pa.RecordBatch.from_arrays(columns, names)


def prefix_trie(messages: DataFrame, convs: DataFrame | None = None) -> DataFrame:
    """A row for each distinct beginning of conversations, from the root of no turns.

    ``messages`` has conv_id, a whole number, place, role and text, as ``ordered_turns``
    gives them; ``convs`` lists the conv_ids, so that some may have no turns. Columns:
    ``node``, an id made of the turns; ``conv_id``, the smallest member; ``depth``;
    ``parent_conv_id``, missing for the root; ``n_convs``, members; ``n_children``;
    ``n_leaves``, nodes without children in the subtree; ``saved_tokens``, over the
    subtree, the code points of each node's last text times its members but one;
    ``ends_sha256``, the hash of the conv_ids that end here, in order, joined by commas.

    Turns are equal if role and text are. Equal conversations are one sequence and count
    as often as they stand there. Without conversations there is no root and no row.
    A conversation takes 24 bytes a turn in a task. Other columns are not read.

    Runs of sorted sequences are worked on one after another, so that no task holds more
    than ``CHUNK_TURNS`` turns and one conversation; nodes across two of them are summed up.
    """
    if convs is None:
        convs = messages.select("conv_id").distinct()
    keyed = stage(_keys(messages, convs), "conversations")
    sequences = stage(_distinct(keyed), "sequences")
    parts = _sorted_with_lcps(sequences).mapInArrow(_nodes, _NODE)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    ends = F.coalesce(F.max("ends_sha256"), F.lit(_NOTHING)).alias("ends_sha256")
    merged = parts.groupBy("node", "parent", "depth").agg(F.min("conv_id").alias("conv_id"), *sums, ends)
    nodes = stage(merged, "nodes")
    above = nodes.where("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("size")
    )
    joined = join_hot(nodes.where("parent is not null"), above, "parent", "size")
    root = nodes.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return joined.unionByName(root).drop("parent")
