"""Token counts of whole texts, by batches in Arrow tasks."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import free_name, named
from tableferry.llm.pieces import Memory, added, pieces

# Bytes of text that the library gets at a time.
BATCH_BYTES = 1 << 18

# Where byte-level tokenizers cut a text before any merge: a fixed value.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def safe_cuts(path: str) -> tuple[str, list[str]] | None:
    """The pattern along which texts may be cut, and strings that forbid it; None if unknown.

    Cuts are safe where the tokenizer itself cuts first: byte-level splitting with
    no normalizer and nothing put in front. A text that holds an added token is
    not cut, as those are taken out before.
    """
    if not path.endswith(".json"):
        return None
    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    split = settings.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True)
    if not plain or split.get("add_prefix_space") or settings.get("normalizer"):
        return None
    return BYTE_LEVEL, [token["content"] for token in settings.get("added_tokens", [])]


def balanced(texts: list[bytes], most: int = BATCH_BYTES) -> Iterator[list[bytes]]:
    """The texts in order, in batches of about ``most`` bytes each."""
    batch, size = [], 0
    for text in texts:
        if batch and size + len(text) > most:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    if batch:
        yield batch


_COUNTERS: dict[str, Memory] = {}


def counter(path: str) -> Memory:
    """Counts tokens of pieces with the library that the file is for; one for each process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Memory(_library(path))
    return _COUNTERS[path]


def _library(path: str) -> Callable[[list[bytes]], list[int]]:
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        encode = lambda batch: model.encode(batch, num_threads=1)
    else:
        # one task, one thread
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        encode = lambda batch: tokenizer.encode_batch_fast(batch, add_special_tokens=False)

    def count(found: list[bytes]) -> list[int]:
        return [len(ids) for batch in balanced(found) for ids in encode([p.decode() for p in batch])]

    return count


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, text: str = "text", keep_text: bool = True
) -> DataFrame:
    """The documents with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``path`` is a .json file of the tokenizers library or a .model file of
    sentencepiece that every executor can open. Whole texts are counted, without
    tokens for begin and end, truncation or padding; strings of special tokens
    inside texts count as the library takes them by default.

    Texts are cut where the tokenizer cuts in any case, so long ones need no
    memory to speak of. Distinct pieces of a task, if not seen of late, go to the
    library in batches of equal size, and only lengths come back. Tokenizers without
    such cuts get whole texts.

    A missing or empty text has no bytes and no tokens. Repeated rows get equal
    counts. Other columns stay, but for the text unless ``keep_text``; those of
    the added names are replaced. An empty table gives no rows.
    """
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    whole = F.coalesce(named(docs, text), F.lit(""))
    one = F.when(whole == "", F.array().cast("array<string>")).otherwise(F.array(whole))
    cuts = safe_cuts(path)
    if cuts is None:
        parts = one
    else:
        pattern, special = cuts
        held = F.lit(False)
        for token in special:
            held = held | F.contains(whole, F.lit(token))
        parts = F.when(held, one).otherwise(pieces(whole, pattern))

    def turn(lists: pa.ListArray) -> list[pa.Array]:
        offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        coded = lists.flatten().cast(pa.binary()).dictionary_encode()
        counts = np.array(counter(path)(coded.dictionary.to_pylist()), np.int64)
        ends = np.append(0, np.cumsum(counts[np.asarray(coded.indices)])) if len(coded) else np.zeros(1)
        return [pa.array((ends[offsets[1:]] - ends[offsets[:-1]]).astype(np.int64))]

    used = free_name(docs, "pieces")
    split = docs.withColumns({used: parts, "n_bytes": F.octet_length(whole).cast("long")})
    counted = added(split if keep_text else split.drop(text), used, {"n_tokens": "long"}, turn)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
