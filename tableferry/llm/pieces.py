"""Texts as lists of pieces, and what distinct pieces turn into, inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import named

# Rows of one Arrow batch are worked on in groups of about so many bytes.
GROUP_BYTES = 4 << 20


def pieces(text: Column, pattern: str) -> Column:
    """The matches of a pattern in the text, in order; none for a missing or empty text.

    ``\\s`` in the pattern means white space of all of Unicode, as in the tokenizers.
    """
    whole = F.coalesce(text, F.lit(""))
    return F.regexp_extract_all(whole, F.lit(f"(?U){pattern}"), F.lit(0))


class Memory:
    """Turns pieces into values, and remembers pieces seen of late.

    At most twice ``limit`` are held: when the young ones reach it, the old ones
    go, save for those that were asked for meanwhile.
    """

    def __init__(self, turn: Callable[[list], list], limit: int = 150_000) -> None:
        self.turn, self.limit = turn, limit
        self.young: dict = {}
        self.old: dict = {}

    def __call__(self, names: list) -> list:
        young, old = self.young, self.old
        again = {n: old[n] for n in names if n not in young and n in old}
        young.update(again)
        new = [n for n in names if n not in young]
        young.update(zip(new, self.turn(new)))
        values = [young[n] for n in names]
        if len(young) > self.limit:
            self.old, self.young = young, {}
        return values


def groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows of about ``GROUP_BYTES``."""
    step = max(1, int(batch.num_rows * min(1, GROUP_BYTES / max(batch.nbytes, 1))))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def turned(lists: pa.ListArray, memory: Memory) -> tuple[pa.Array, np.ndarray]:
    """Bytes for the pieces of all lists in a row, and where each list begins and ends in them."""
    flat = lists.flatten()
    coded = flat.cast(pa.binary()).dictionary_encode()
    values = pa.array(memory(coded.dictionary.to_pylist()), pa.binary())
    out = pa.concat_arrays([values.take(coded.indices)])
    ends = np.frombuffer(out.buffers()[1], np.int32, len(out) + 1) if len(out) else np.zeros(1, np.int32)
    offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    return out, ends[offsets]


def added(
    df: DataFrame, used: str, kinds: dict[str, str], turn: Callable[[pa.Array], list[pa.Array]]
) -> DataFrame:
    """The frame with column ``used`` turned, in Arrow tasks, into columns of the given types."""
    rest = [c for c in df.columns if c != used and c not in kinds]
    # Arrow tasks take no dots in names
    plain = [f"c{i}" for i in range(len(rest) + len(kinds))]
    n = len(rest)
    frame = df.select(*[named(df, c) for c in rest], df[used]).toDF(*plain[:n], "used")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch):
                columns = [part.column(i) for i in range(n)]
                yield pa.RecordBatch.from_arrays([*columns, *turn(part.column(n))], plain)

    nothing = [F.lit(None).cast(kind).alias(c) for c, kind in zip(plain[n:], kinds.values())]
    schema = frame.select(*plain[:n], *nothing).schema
    return frame.mapInArrow(run, schema).toDF(*rest, *kinds)
