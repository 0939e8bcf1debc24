"""Byte-level BPE: merges by a recursive query in each task, decoding by ordered aggregation."""

from __future__ import annotations

import base64
import os
import tempfile
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import free_name, named
from tableferry.llm.pieces import Memory, added, pieces, turned

# Bytes of a block: a longer word is encoded block by block, and the blocks are put together.
BLOCK = 64
# Rows that a query keeps at most, over all of its rounds, or those of one round if that is more.
QUERY_ROWS = 1_000_000
# What DuckDB may hold in a task before it spills.
MEMORY = "128MB"
# Ids that are decoded together at most.
RUN_IDS = 1 << 17
# Tokens on either side of a seam that are encoded anew where two blocks do not fit.
SEAM = 4

# A word is a row for each token: where it begins, the token, the same of the next
# one, and the token that the two would make. In every round each word contracts
# its pair of the least rank, the leftmost of equals; only the rows on either side
# look for a new pair. Words without a pair stay behind in their last round.
_ENCODE = """
WITH RECURSIVE run AS (
    SELECT start.*, id AS made, 0 AS round
    FROM start LEFT JOIN merges ON tok = l AND next_tok = r
    UNION ALL (
        WITH best AS (
            SELECT word, min(made::BIGINT << 32 | pos) AS pair,
                   arg_min(next_pos, made::BIGINT << 32 | pos) AS gone
            FROM run WHERE made IS NOT NULL GROUP BY word
        ), spot AS (
            SELECT best.word, (pair & 4294967295)::INT AS here, (pair >> 32)::INT AS joined, gone,
                   next_pos AS after_pos, next_tok AS after_tok
            FROM best JOIN run ON run.word = best.word AND run.pos = best.gone
        ), moved AS (
            SELECT run.word, run.pos, run.pos = here AS merged, run.next_pos = here AS before,
                   CASE WHEN merged THEN after_pos ELSE run.next_pos END AS next_pos,
                   CASE WHEN merged THEN joined ELSE run.tok END AS tok,
                   CASE WHEN merged THEN after_tok WHEN before THEN joined
                        ELSE run.next_tok END AS next_tok,
                   run.made, run.round + 1 AS round
            FROM run JOIN spot ON run.word = spot.word WHERE run.pos <> gone
        )
        SELECT word, pos, next_pos, tok, next_tok, made, round
        FROM moved WHERE (merged OR before) IS NOT TRUE
        UNION ALL
        SELECT word, pos, next_pos, tok, next_tok, id, round
        FROM moved LEFT JOIN merges ON tok = l AND next_tok = r WHERE merged OR before
    )
), ended AS (
    SELECT word, max(round) AS round FROM run WHERE pos = 0 GROUP BY word
)
SELECT word, tok FROM run JOIN ended USING (word, round) ORDER BY word, pos
"""

# The same for what cannot be cut into blocks, mostly repeats of few tokens. In one
# round all places of the least rank are contracted that do not overlap, from the
# left. That is the same as one by one if no lower rank can come up before they are
# through: if every join with the new token ranks after it (safe). Otherwise only
# the first place is contracted. A query ends after some rounds, and the next one
# goes on from there, so that not all rounds are kept.
_ENCODE_LONG = """
WITH RECURSIVE run AS (
    SELECT word, pos, tok, 0 AS round FROM start
    UNION ALL (
        WITH pairs AS (
            SELECT *, lead(tok) OVER next AS next_tok, row_number() OVER next AS nth
            FROM run WINDOW next AS (PARTITION BY word ORDER BY pos)
        ), ranked AS (
            SELECT pairs.*, id, safe, min(id) OVER (PARTITION BY word) AS least
            FROM pairs LEFT JOIN merges ON tok = l AND next_tok = r
        ), places AS (
            SELECT *, CASE WHEN id = least THEN row_number() OVER
                (PARTITION BY word, id = least ORDER BY nth) END AS place
            FROM ranked WHERE least IS NOT NULL AND round < $rounds
        ), taken AS (
            SELECT *, place IS NOT NULL AND (safe OR place = 1) AND
                (nth - min(nth) OVER (PARTITION BY word, nth - place)) % 2 = 0 AS take
            FROM places
        ), paired AS (
            SELECT *, lag(take, 1, false) OVER (PARTITION BY word ORDER BY nth) AS gone FROM taken
        )
        SELECT word, pos, CASE WHEN take THEN id ELSE tok END, round + 1 FROM paired WHERE NOT gone
    )
), ended AS (
    SELECT max(round) AS round FROM run
)
SELECT pos, tok, round FROM run JOIN ended USING (round) ORDER BY pos
"""

_DECODE = """
SELECT string_agg(hex, '' ORDER BY pos) AS hex FROM coded JOIN vocabulary USING (id)
"""


def _rows_of(word: bytes) -> int:
    """The rows that a query keeps of a word, at most: a round for each byte."""
    return len(word) ** 2 // 2 + 1


def _batches(places: Iterable[int], words: list[bytes]) -> Iterator[list[int]]:
    """Runs of places whose words fit into a query together, or a single one that is too long."""
    batch, rows = [], 0
    for i in places:
        size = _rows_of(words[i])
        if batch and rows + size > QUERY_ROWS:
            yield batch
            batch, rows = [], 0
        batch.append(i)
        rows += size
    if batch:
        yield batch


class Vocabulary:
    """The ranks of a file, as tables in a DuckDB of the task's own process."""

    _loaded: dict[str, Vocabulary] = {}

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.query = duckdb.connect(":memory:")
        # spills go to the executor's own folder, where only this process reads them
        spill = os.path.join(tempfile.gettempdir(), f"bpe-{os.getpid()}")
        for setting in ("threads = 1", f"memory_limit = '{MEMORY}'", f"temp_directory = '{spill}'"):
            self.query.execute(f"SET {setting}")
        # any two tokens that make a third when joined
        made = [
            (self.ranks.get(token[:i]), self.ranks.get(token[i:]), rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
        ]
        left, right, both = zip(*[m for m in made if None not in m]) if made else ((), (), ())
        safe = dict.fromkeys(both, True)
        for part, whole in (*zip(left, both), *zip(right, both)):
            if part > whole:
                safe[part] = False
        self._table(
            "merges", {"l": left, "r": right, "id": both, "safe": [safe[m] for m in both]}
        )
        self._table(
            "vocabulary",
            {"id": list(self.ranks.values()), "hex": [t.hex() for t in self.ranks]},
        )
        self.bytes_to_id = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.known = np.zeros(max(self.ranks.values(), default=0) + 1, bool)
        self.known[list(self.ranks.values())] = True
        self.sizes = np.zeros(len(self.known), np.int64)
        self.sizes[list(self.ranks.values())] = [len(t) for t in self.ranks]
        self.fits: dict[tuple[int, int], bool] = {}
        self.encoded = Memory(self._encode)

    @classmethod
    def at(cls, path: str) -> Vocabulary:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _table(self, name: str, columns: dict) -> None:
        kinds = {"hex": pa.string(), "safe": pa.bool_()}
        given = pa.table({k: pa.array(v, kinds.get(k, pa.int32())) for k, v in columns.items()})
        self.query.register("given", given)
        self.query.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.query.unregister("given")

    def _rows(self, sql: str, name: str, table: pa.Table, **values: int) -> list:
        self.query.register(name, table)
        try:
            return self.query.execute(sql, values or None).fetchall()
        finally:
            self.query.unregister(name)

    def _encode(self, words: list[bytes]) -> Iterable[bytes]:
        """The ids of each word as 32-bit integers, end to end."""
        known = [self.ranks.get(w) for w in words]
        out = [b"" if k is None else np.int32(k).tobytes() for k in known]
        rest = [i for i, k in enumerate(known) if k is None]
        short = [i for i in rest if len(words[i]) <= BLOCK]
        for some in _batches(short, words):
            for i, ids in zip(some, self._listed([words[i] for i in some])):
                out[i] = ids
        long = [i for i in rest if len(words[i]) > BLOCK]
        cut = [[words[i][at : at + BLOCK] for at in range(0, len(words[i]), BLOCK)] for i in long]
        for i, ids in zip(long, self._joined(cut)):
            out[i] = np.array(ids, np.int32).tobytes()
        return out

    def _listed(self, words: list[bytes]) -> Iterator[bytes]:
        """The ids of words that fit into a query together."""
        self.query.register("start", self._tokens(words))
        try:
            found = self.query.sql(_ENCODE).to_arrow_table()
        finally:
            self.query.unregister("start")
        word, tok = (found.column(c).to_numpy() for c in ("word", "tok"))
        ends = np.append(0, np.cumsum(np.bincount(word, minlength=len(words)))) * 4
        flat = np.ascontiguousarray(tok, np.int32).tobytes()
        return (flat[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist()))

    def _joined(self, cut: list[list[bytes]]) -> list[list[int]]:
        """The ids of words from their blocks.

        Two encodings put together are the encoding of both if their tokens at the seam
        fit: if the bytes of just these two are encoded as the two again. No contraction
        crosses the seam then, as the first one to do so would also cross it there.
        Where they do not fit, the tokens around the seam are encoded anew, and if the
        result does not fit its neighbours, the blocks become one.
        """
        coded = [list(ids) for ids in self._split(self._merged([b for word in cut for b in word]), cut)]
        while True:
            seams = [(w, i) for w, units in enumerate(coded) for i in range(1, len(units))]
            bad = self._unfit([(coded[w][i - 1][-1], coded[w][i][0]) for w, i in seams])
            bad = [seam for seam, unfit in zip(seams, bad) if unfit]
            if not bad:
                return [[t for unit in units for t in unit] for units in coded]
            sides = [(coded[w][i - 1][-SEAM:], coded[w][i][:SEAM]) for w, i in bad]
            anew = self._merged([self._bytes(left + right) for left, right in sides])
            outer = []
            for (w, i), ids in zip(bad, anew):
                before, after = coded[w][i - 1][:-SEAM], coded[w][i][SEAM:]
                # a block that is all seam would be changed from both ends
                whole = len(before) > SEAM and len(after) > SEAM
                outer.append([(before[-1], ids[0]), (ids[-1], after[0])] if whole else None)
            checked = iter(self._unfit([pair for pairs in outer if pairs for pair in pairs]))
            joined = {}
            for (w, i), pairs, ids in zip(bad, outer, anew):
                if pairs and not (next(checked) | next(checked)):
                    coded[w][i - 1] = coded[w][i - 1][:-SEAM] + ids
                    coded[w][i] = coded[w][i][SEAM:]
                else:
                    joined.setdefault(w, set()).add(i)
            grown = []
            for w, places in joined.items():
                places = self._widened(coded[w], places)
                runs: list[list[int]] = []
                for i, unit in enumerate(coded[w]):
                    if i not in places:
                        runs.append(unit)
                        continue
                    runs[-1] = runs[-1] + unit
                    if i + 1 not in places:
                        grown.append((w, len(runs) - 1))
                coded[w] = runs
            for (w, i), ids in zip(grown, self._merged([self._bytes(coded[w][i]) for w, i in grown])):
                coded[w][i] = ids

    def _widened(self, units: list[list[int]], places: set[int]) -> set[int]:
        """The seams to join, and more beside a block that has grown, until either side is as large.

        What is out of step at one seam may stay so for all of a long word, and blocks
        that double come to its end in few rounds.
        """
        sizes = [sum(len(self.tokens[t]) for t in unit) for unit in units]
        wide = set(places)
        for at in places:
            left, right = sizes[at - 1], sizes[at]
            i, j = at - 1, at
            while right < left and j + 1 < len(units):
                j += 1
                right += sizes[j]
            while left < right and i > 0:
                i -= 1
                left += sizes[i]
            wide.update(range(i + 1, j + 1))
        return wide

    @staticmethod
    def _split(flat: list, like: list[list]) -> Iterable[list]:
        """A list cut into parts of the same lengths as those of another."""
        rest = iter(flat)
        return [[next(rest) for _ in part] for part in like]

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def _unfit(self, pairs: list[tuple[int, int]]) -> list[bool]:
        """Whether the encoding of two tokens' bytes is something else than the two."""
        new = list({p for p in pairs if p not in self.fits})
        if len(self.fits) > 500_000:
            self.fits.clear()
            new = list(set(pairs))
        for pair, ids in zip(new, self._merged([self._bytes(p) for p in new])):
            self.fits[pair] = ids == list(pair)
        return [not self.fits[p] for p in pairs]

    def _merged(self, words: list[bytes]) -> list[list[int]]:
        """The ids of words, each merged from its bytes; equal ones once."""
        distinct = list(set(words))
        ids: dict[bytes, list[int]] = {}
        for some in _batches(range(len(distinct)), distinct):
            if len(some) == 1 and _rows_of(distinct[some[0]]) > QUERY_ROWS:
                ids[distinct[some[0]]] = self._in_stages(distinct[some[0]])
                continue
            found = self._listed([distinct[i] for i in some])
            ids.update((distinct[i], np.frombuffer(x, np.int32).tolist()) for i, x in zip(some, found))
        return [ids[w] for w in words]

    def _in_stages(self, word: bytes) -> list[int]:
        """The ids of a long word, some rounds at a time."""
        table = self._tokens([word]).select(["word", "pos", "tok"])
        while True:
            rounds = max(1, QUERY_ROWS // table.num_rows)
            found = self._rows(_ENCODE_LONG, "start", table, rounds=rounds)
            if found[0][2] < rounds:
                return [tok for _, tok, _ in found]
            pos, tok = (pa.array(column, pa.int32()) for column in list(zip(*found))[:2])
            table = pa.table({"word": pa.array(np.zeros(len(pos), np.int32)), "pos": pos, "tok": tok})

    def _tokens(self, words: list[bytes]) -> pa.Table:
        """A row for every byte: its word, place and id, and place and id of the next one."""
        sizes = np.array([len(w) for w in words])
        flat = self.bytes_to_id[np.frombuffer(b"".join(words), np.uint8)]
        if (flat < 0).any():
            raise ValueError("the vocabulary lacks some byte of the text")
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        pos = np.arange(len(flat), dtype=np.int32) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        last = pos == sizes[word] - 1
        return pa.table(
            {
                "word": word,
                "pos": pa.array(pos, pa.int32()),
                "next_pos": pa.array(pos + 1, pa.int32(), mask=last),
                "tok": flat,
                "next_tok": pa.array(np.append(flat[1:], 0), pa.int32(), mask=last),
            }
        )

    def decoded(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for, in their order."""
        out = []
        for at in range(0, len(ids), RUN_IDS):
            run = ids[at : at + RUN_IDS]
            coded = pa.table({"pos": np.arange(len(run), dtype=np.int32), "id": run})
            out.append(bytes.fromhex(self._rows(_DECODE, "coded", coded)[0][0]))
        return b"".join(out)


def _ids_of(lists: pa.ListArray, own: Vocabulary) -> pa.ListArray:
    """The ids of lists of words."""
    out, ends = turned(lists, own.encoded)
    data = out.buffers()[2] if len(out) else None
    flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]) // 4, [None, data])
    return pa.ListArray.from_arrays(pa.array(ends // 4, pa.int32()), flat)


def _bytes_of(lists: pa.ListArray, own: Vocabulary) -> pa.Array:
    """The bytes of lists of ids: decoded in a row, and cut where the sizes of the tokens say."""
    offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    flat = np.ascontiguousarray(lists.flatten().to_numpy(), np.int32)
    if len(flat) and (flat.min() < 0 or flat.max() >= len(own.known) or not own.known[flat].all()):
        raise ValueError("an id is not in the vocabulary")
    ends = np.concatenate([[0], np.cumsum(own.sizes[flat], dtype=np.int64)])[offsets]
    return pa.Array.from_buffers(
        pa.binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(own.decoded(flat))]
    )


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    name: str = "ids",
    decoded: str | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """The documents with the token ids of their texts, an array of integers, as ``name``.

    Each match of ``pattern`` in the whole text is a word. A word that is a token
    is that token. Any other starts as bytes; the adjacent pair whose join has
    the least rank is contracted, the leftmost of equals, until none is left.
    ``path`` is a file of ranks that every executor can open. There are no
    special tokens: their strings are ordinary text. With ``decoded`` the same
    task turns the ids back into bytes as well, in a column of that name.

    The words of a task are encoded by a recursive query, those seen of late only
    once, so repeated texts and rows cost little. Words of over ``BLOCK`` bytes are
    encoded in blocks that are then put together; no query keeps more than
    ``QUERY_ROWS`` rows, or two rounds of one word. A missing or empty text has no
    ids. Other columns stay, but for the text unless ``keep_text``; those of the
    added names are replaced. An empty table gives no rows.
    """
    words = free_name(docs, "words")
    split = docs.withColumn(words, pieces(named(docs, text), pattern))

    def turn(lists: pa.ListArray) -> list[pa.Array]:
        own = Vocabulary.at(path)
        ids = _ids_of(lists, own)
        pa.default_memory_pool().release_unused()  # a worker lives on after its task
        return [ids, _bytes_of(ids, own)] if decoded else [ids]

    kinds = {name: "array<int>"} | ({decoded: "binary"} if decoded else {})
    return added(split if keep_text else split.drop(text), words, kinds, turn)


def decode(coded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with the bytes that the ids stand for, in order, as ``name``.

    Documents are decoded in runs of up to ``RUN_IDS`` ids, by a join with the
    vocabulary and an aggregation ordered by position. Missing ids count as none
    and give no bytes. An id that is not in the vocabulary is an error. Other
    columns stay.
    """
    used = free_name(coded, "used")
    filled = F.coalesce(named(coded, ids), F.array().cast("array<int>"))

    def turn(lists: pa.ListArray) -> list[pa.Array]:
        return [_bytes_of(lists, Vocabulary.at(path))]

    return added(coded.withColumn(used, filled), used, {name: "binary"}, turn)
