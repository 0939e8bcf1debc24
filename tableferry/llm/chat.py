"""Conversations as texts with a loss mask, from trees of replies."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm.common import stage

# Marks around a turn: fixed values of the chat template.
START, END = "<|im_start|>", "<|im_end|>"

# Salts under which the branches of a tree are ranked before they meet.
SALTS = 64


def conversation_trees(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a tree for each conversation.

    Each turn replies to the one before; equal turns follow each other by role and
    text, missing ones come first. All scores are zero.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.select("conv_id", "role", "text", F.row_number().over(order).alias("n"))
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    return numbered.select(
        tree.alias("tree"),
        F.concat_ws(":", tree, "n").alias("node"),
        F.when(F.col("n") > 1, F.concat_ws(":", tree, F.col("n") - 1)).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def unique_messages(messages: DataFrame) -> DataFrame:
    """One message for each (tree, node): of repeated ones the least parent, role, text and score.

    Missing values are less than all others. A missing tree counts as the empty one;
    messages without a node are on no path and are left out.
    """
    tree = F.coalesce("tree", F.lit(""))
    told = F.struct("parent", "role", "text", "score")
    least = messages.where("node is not null").groupBy(tree.alias("tree"), "node").agg(F.min(told).alias("m"))
    return stage(least.select("tree", "node", "m.*"), "messages")


def branch_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The best ``branches`` root-to-leaf paths of each tree: ``tree``, ``leaf``, ``node``, ``depth``.

    A path's score is the sum of its messages' scores, a missing one counting as 0; of
    equal ones the longer path ranks first, then the smaller leaf. A message whose
    parent is missing or not in its tree is a root; messages whose parents run in a
    circle are on no path. Nodes are told apart by tree and name, and repeated ones are
    one message, see ``unique_messages``. An empty table gives no rows. Other columns
    are not read.
    """
    return _paths(unique_messages(messages), branches)


def _paths(nodes: DataFrame, branches: int) -> DataFrame:
    """The paths of unique messages, by self-joins that double their reach.

    After k rounds a message knows its ancestor 2^k steps up, and the score on the
    way. The same jumps then lead from each chosen leaf to all messages above it.
    """
    there = nodes.select("tree", F.col("node").alias("parent"))
    known = nodes.join(there.withColumn("there", F.lit(True)), ["tree", "parent"], "left")
    up = known.select(
        "tree",
        "node",
        F.when(F.col("there"), F.col("parent")).alias("jump"),
        F.lit(1).cast("long").alias("depth"),
        F.coalesce("score", F.lit(0.0)).alias("total"),
    )
    up = stage(up, "jumps")
    jumps = []
    for _ in range(nodes.count().bit_length() + 1):
        if not up.where("jump is not null").take(1):
            break
        jumps.append(up.select("tree", "node", "jump").where("jump is not null"))
        above = up.select(
            "tree",
            F.col("node").alias("jump"),
            F.col("jump").alias("next"),
            F.col("depth").alias("more"),
            F.col("total").alias("extra"),
        )
        # messages that have reached their root stay as they are
        further = up.where("jump is not null").join(above, ["tree", "jump"]).select(
            "tree",
            "node",
            F.col("next").alias("jump"),
            (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("total") + F.col("extra")).alias("total"),
        )
        up = stage(further.unionByName(up.where("jump is null")), "jumps")

    rooted = up.where("jump is null")
    replied = nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = rooted.join(replied, ["tree", "node"], "left_anti")
    ranking = [F.col("total").desc(), F.col("depth").desc(), "node"]
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS))
    chosen = leaves
    for by in (["tree", salt], ["tree"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*ranking))
        chosen = chosen.withColumn("rank", rank).where(F.col("rank") <= branches).drop("rank")

    reached = stage(chosen.select("tree", F.col("node").alias("leaf"), "node", "depth"), "paths")
    for k, jump in enumerate(jumps):
        further = reached.join(jump, ["tree", "node"]).select(
            "tree", "leaf", F.col("jump").alias("node"), (F.col("depth") - (1 << k)).alias("depth")
        )
        reached = stage(reached.unionByName(further), "paths")
    return reached


def _escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<|", "&lt;|")


def _unescape(text: str) -> str:
    return text.replace("&lt;|", "<|").replace("&#10;", "\n").replace("&amp;", "&")


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of a conversation, and begin and end of each assistant text in it."""
    parts, mask, size = [], [], 0
    for role, text in turns:
        head = f"{START}{_escape(role).replace(chr(10), '&#10;')}\n"
        body = _escape(text)
        if role == "assistant":
            mask.append((size + len(head), size + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        size += len(head) + len(body) + len(END) + 1
    return "".join(parts), mask


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts that ``format_turns`` wrote."""
    found = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        found.append((_unescape(role), _unescape(rest.removesuffix(END + "\n"))))
    return found


def masked_text(formatted: str, mask: list) -> str:
    """What stands under the loss mask, without escapes."""
    return "".join(_unescape(formatted[begin:end]) for begin, end in mask)


def format_conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``tree``, ``leaf``, ``formatted`` and ``mask`` for each chosen path of each tree.

    ``messages`` has tree, node, parent, role, text and score. Each turn becomes
    start mark, role, line feed, text, end mark, line feed. Within roles and texts
    "&" becomes "&amp;", "<|" becomes "&lt;|", and a line feed in a role "&#10;",
    so that no mark can come from a text and all can be read back. ``mask`` lists
    begin and end, in code points, of the assistant texts.

    Missing roles and texts count as empty. A conversation is one row, so it must
    fit into a task like any row. Repeated messages and missing trees and nodes are
    treated as in ``branch_paths``. An empty table gives no rows. Other columns are
    not read.
    """
    empty, nodes = F.lit(""), unique_messages(messages)
    said = nodes.select(
        "tree", "node", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    paths = _paths(nodes, branches).join(said, ["tree", "node"])
    turns = paths.groupBy("tree", "leaf").agg(
        F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns")
    )

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            done = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in part["turns"]]
            part = part[["tree", "leaf"]].copy()
            part["formatted"] = [text for text, _ in done]
            part["mask"] = [[{"begin": a, "end": b} for a, b in mask] for _, mask in done]
            yield part

    kind = "tree string, leaf string, formatted string, mask array<struct<begin: long, end: long>>"
    return turns.mapInPandas(run, kind)


def read_back(conversations: DataFrame) -> DataFrame:
    """Digests of what can be read from formatted conversations and their masks.

    Each row is read by itself, so repeated ones give repeated results. A missing text
    has no turns, a missing mask masks nothing, and text before the first start mark is
    part of no turn. An empty table gives no rows. Other columns are not read.
    """
    given = conversations.select(
        "tree",
        "leaf",
        F.coalesce("formatted", F.lit("")).alias("formatted"),
        F.coalesce("mask", F.array().cast("array<struct<begin: long, end: long>>")).alias("mask"),
    )

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for row in part.itertuples(index=False):
                turns = parse_turns(row.formatted)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                learnt = masked_text(row.formatted, [(m["begin"], m["end"]) for m in row.mask])
                digests = [hashlib.sha256(x.encode()).hexdigest() for x in (said, learnt)]
                found.append(
                    (row.tree, row.leaf, len(turns), digests[0], len(learnt), digests[1], len(row.formatted))
                )
            yield pd.DataFrame(found, columns=names)

    names = ["tree", "leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = (
        "tree string, leaf string, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )
    return given.mapInPandas(run, kind)
