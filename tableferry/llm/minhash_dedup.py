"""Near-duplicates by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import join_hot, named, row_key, stage
from tableferry.llm.pieces import groups
from tableferry.llm.simhash_dedup import components

# A sketch has BANDS bands of ROWS coordinates. Sets of similarity 0.8 agree in no
# band with a probability of (1 - 0.8^7)^50 = 0.000008, sets of 0.3 agree in one with 0.011.
BANDS, ROWS = 50, 7
# Pairs of a document that share one copy of its set.
FAN = 256
# Words of 64 bits that stand for the shingles of a set.
WORDS = 16

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _seed(n: int) -> np.uint64:
    return _mix(np.array([n + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the distinct shingles of all texts in a row, sorted in each, and where texts begin.

    Words are told apart by XXH64, shingles by mixing those: 64 bits in all. A text
    of fewer words than ``shingle`` is one shingle of another kind.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = lists.flatten()
    row = np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))
    some = np.asarray(pc.binary_length(words)) > 0
    coded = words.dictionary_encode()
    names = [xxhash.xxh64_intdigest(w.encode()) for w in coded.dictionary.to_pylist()]
    hashes = np.array(names, np.uint64)[np.asarray(coded.indices)][some] if len(words) else np.empty(0, np.uint64)
    row = row[some]
    counts = np.bincount(row, minlength=len(texts))
    ends = np.cumsum(counts)
    nth = np.arange(len(row)) - (ends - counts)[row]
    width = np.minimum(counts, shingle)[row]
    starts = nth <= counts[row] - width
    found = np.full(int(starts.sum()), _seed(0), np.uint64)
    at, width = np.flatnonzero(starts), width[starts]
    for k in range(shingle):
        inside = width > k
        found[inside] = _mix(found[inside] * np.uint64(0x9E3779B97F4A7C15) + hashes[at[inside] + k])
    found = _mix(found + width.astype(np.uint64))
    of_row = row[starts]
    order = np.lexsort((found, of_row))
    found, of_row = found[order], of_row[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (of_row[1:] != of_row[:-1])
    return found[new], np.searchsorted(of_row[new], np.arange(len(texts) + 1))


def sketches(found: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """A row of ``size`` coordinates for each set of hashes; that of an empty set has no meaning.

    In each round every member falls into one bin by the round's hash, and a bin
    keeps the least hash of the first round that reached it. After ``size`` rounds,
    one round per bin puts all members into it, so that no bin stays empty. A set is
    through as soon as its bins are full: in all it costs about its number of
    members, or size times the logarithm of size if that is more.
    """
    n = len(starts) - 1
    out = np.full(n * size, _NONE, np.uint64)
    filled = np.zeros(n * size, bool)
    row = np.repeat(np.arange(n), np.diff(starts))
    for turn in range(2 * size):
        if not len(row):
            break
        h = _mix(found ^ _seed(turn))
        if turn < size:
            bins = ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            bins = np.int64(turn - size)
        slot = row * size + bins
        empty = ~filled[slot]
        slot = slot[empty]
        np.minimum.at(out, slot, h[empty])
        filled[slot] = True
        left = ~filled.reshape(n, size).all(axis=1)[row]
        found, row = found[left], row[left]
    return out.reshape(n, size)


def _bands(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A number for each band of each sketch, of its coordinates and its place."""
    parts = sketch.reshape(len(sketch), bands, rows)
    found = np.broadcast_to(_mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2])
    for k in range(rows):
        found = _mix(found * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return found.view(np.int64)


def _in_arrow(frame: DataFrame, kept: list[str], kinds: dict[str, str], turn: Callable) -> DataFrame:
    """Columns ``kept`` of the frame, and what ``turn`` makes of the arrays of its ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch):
                columns = [part.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, *turn(part.column(len(kept)))], [*kept, *kinds])

    schema = frame.select(*kept, *[F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]).schema
    return frame.select(*kept, "text").mapInArrow(run, schema)


def _sketched(keyed: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``key``, ``doc_id``, ``n`` shingles, two halves of the set's digest, and its ``bands``."""

    def turn(texts: pa.Array) -> list[pa.Array]:
        found, starts = shingle_sets(texts, shingle)
        count = np.diff(starts)
        # a sum over distinct members does not depend on their order
        halves = [
            np.concatenate([[np.uint64(0)], np.cumsum(_mix(found ^ _seed(-k - 1 & 0xFFFFFFFF)), dtype=np.uint64)])
            for k in range(2)
        ]
        digests = [(sums[starts[1:]] - sums[starts[:-1]]).view(np.int64) for sums in halves]
        numbers = _bands(sketches(found, starts, bands * rows), bands, rows)[count > 0]
        ends = np.concatenate([[0], np.cumsum(np.where(count > 0, bands, 0))]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers.ravel()))
        return [pa.array(count, pa.int64()), *map(pa.array, digests), listed]

    kinds = {"n": "bigint", "d1": "bigint", "d2": "bigint", "bands": "array<bigint>"}
    return _in_arrow(keyed, ["key", "doc_id"], kinds, turn)


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``class`` and its full set of ``shingles``."""

    def turn(texts: pa.Array) -> list[pa.Array]:
        found, starts = shingle_sets(texts, shingle)
        return [pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(found.view(np.int64)))]

    return _in_arrow(texts, ["class"], {"shingles": "array<bigint>"}, turn)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough.

    ``sets`` has the size ``n`` of each full set and all ``shingles`` that it shares with
    any other. ``u`` may be a hub: its set is copied for every ``FAN`` of its pairs, and
    they are dealt over the copies.
    """
    pairs = stage(pairs, "pairs")
    degrees = pairs.groupBy("u").agg(F.count("*").alias("degree"))
    degrees = stage(degrees.withColumn("slots", F.ceil(F.col("degree") / FAN).cast("int")), "degrees")
    dealt = join_hot(pairs, degrees, "u", "degree").select(
        "u", "v", F.pmod(F.xxhash64("v"), F.col("slots")).cast("int").alias("slot")
    )
    copies = sets.join(degrees, F.col("class") == F.col("u")).select(
        "u",
        F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"),
        F.col("shingles").alias("a"),
        F.col("n").alias("size_a"),
    )
    ends = sets.select(F.col("class").alias("v"), F.col("shingles").alias("b"), F.col("n").alias("size_b"))
    both = F.size(F.array_intersect("a", "b"))
    union = F.col("size_a") + F.col("size_b") - both
    return dealt.join(ends, "v").join(copies, ["u", "slot"]).where(both * 100 >= union * percent).select("u", "v")


def _rooted(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members of buckets with the ``root`` of their component."""
    roots = components(links).withColumnRenamed("node", "class")
    return stage(
        members.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class")), "rooted"
    )


def _open_buckets(rooted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members of buckets that hold several components, and those not in the largest one."""
    parts = rooted.groupBy("bucket", "root").agg(F.count("*").alias("part"))
    main = parts.groupBy("bucket").agg(
        F.max(F.struct("part", "root"))["root"].alias("main"), F.count("*").alias("parts")
    )
    main = stage(main.where("parts > 1").drop("parts"), "open-buckets")
    members = stage(rooted.join(main, "bucket"), "open-members")
    return members, members.where("root <> main")


def _shared_parts(sets: DataFrame, percent: int) -> DataFrame:
    """Of each class that can have a link: ``n``, the shingles that others have too, and bits of them.

    Shingles that no other candidate has are in no intersection, so ``shingles`` here
    are the ``common`` ones only. They set bits of 16 words by their hash. A bit that
    one class has and another lacks stands for a shingle that the two do not share.
    """
    alone = (
        sets.select("class", F.explode("shingles").alias("s"))
        .groupBy("s")
        .agg(F.count("*").alias("holders"), F.min("class").alias("class"))
        .where("holders = 1")
        .groupBy("class")
        .agg(F.collect_list("s").alias("alone"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, shingles, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                whole = np.asarray(shingles.values)
                shared = np.setdiff1d(whole, np.asarray(own.values), assume_unique=True) if own.is_valid else whole
                if len(shared) * 100 < len(whole) * percent:
                    continue
                h = shared.view(np.uint64)
                bits = np.zeros(WORDS, np.uint64)
                np.bitwise_or.at(bits, (h >> np.uint64(60)).astype(np.int64), np.uint64(1) << (h & np.uint64(63)))
                rows.append((name, len(whole), len(shared), shared, bits.view(np.int64)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            columns = zip(*rows) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    names = ["class", "n", "common", "shingles", "bits"]
    kind = "class long, n long, common long, shingles array<bigint>, bits array<bigint>"
    return sets.join(alone, "class", "left").select("class", "shingles", "alone").mapInArrow(run, kind)


def _lacking(bits: Column, other: Column) -> Column:
    """So many shingles of the one are not in the other at least."""
    found = F.lit(0)
    for k in range(WORDS):
        found = found + F.bit_count(F.get(bits, F.lit(k)).bitwiseAND(F.bitwise_not(F.get(other, F.lit(k)))))
    return found


def _near(most: Column, percent: int) -> Column:
    """Whether an intersection of ``most`` makes sets of ``n`` and ``n2`` similar enough."""
    return most * 100 >= (F.col("n") + F.col("n2") - most) * percent


def _hub() -> Column:
    """Of a bucket's rows the one that has the most in common: the text that others are copies of."""
    share = (F.col("common") / F.col("n")).alias("share")
    return F.max(F.struct(share, "class", "n", "common", "root")).alias("hub")


def _star(led: DataFrame, percent: int) -> DataFrame:
    """Pairs of each row's hub and the row, if they can be linked."""
    told = led.select(
        "class",
        "n",
        "common",
        F.col("hub.class").alias("u"),
        F.col("hub.n").alias("n2"),
        F.col("hub.common").alias("common2"),
    )
    possible = _near(F.least("common", "common2"), percent)
    return told.where("u <> class").where(possible).select("u", F.col("class").alias("v")).distinct()


def _links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect all classes that verified candidates connect.

    Candidates are classes that share a bucket. First all members of a bucket are
    checked against its hub, then in buckets where that left several components all
    others against a hub outside of the largest. What is still apart after that is
    checked pair by pair, so that no link is lost; but members that are connected
    already are never paired, nor are those that lack too many of each other's
    shingles, by their numbers and bits, for the two to be similar enough.
    """
    parts = stage(_shared_parts(sets, percent), "shared-parts")
    sizes = parts.select("class", "n", "common")
    members = stage(members.join(sizes, "class"), "linkable")
    hubs = members.withColumn("root", F.col("class")).groupBy("bucket").agg(F.count("*").alias("size"), _hub())
    hubs = stage(hubs.where("size > 1").drop("size"), "hubs")
    members = stage(members.join(hubs, "bucket"), "led")
    links = stage(_verified(_star(members, percent), parts, percent), "links-found")

    plain = ["bucket", "class", "n", "common"]
    apart, minor = _open_buckets(_rooted(members.select(plain), links))
    second = stage(minor.groupBy("bucket").agg(_hub()), "second-hubs")
    led = apart.join(second, "bucket").where("root <> hub.root")
    links = stage(links.unionByName(_verified(_star(led, percent), parts, percent)), "links-found")

    apart, minor = _open_buckets(_rooted(apart.select(plain), links))
    bits = parts.select("class", "bits")
    left = minor.join(bits, "class").select(
        "bucket",
        *[F.col(c).alias(as_) for c, as_ in (("class", "u"), ("n", "n2"), ("common", "common2"), ("root", "root2"), ("bits", "bits2"))],
    )
    most = F.least(
        F.col("common") - _lacking(F.col("bits"), F.col("bits2")),
        F.col("common2") - _lacking(F.col("bits2"), F.col("bits")),
    )
    possible = (F.col("root") != F.col("root2")) & _near(F.least("common", "common2"), percent) & _near(most, percent)
    rest = apart.join(bits, "class").join(left, "bucket").where(possible)
    return links.unionByName(_verified(rest.select("u", F.col("class").alias("v")).distinct(), parts, percent))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Words are the runs of characters other than [\\x20\\x09-\\x0D] in the text with A-Z
    in lower case. A document's set holds its distinct shingles of ``shingle`` words; a
    text of fewer words is one shingle, one without words has an empty set and is
    linked with nothing. Documents are linked if 100 times the intersection of
    their sets is ``percent`` times the union or more, and ``component_id`` is the
    smallest doc_id that links lead to. A document whose own id that is is ``kept``.

    Documents with equal sets are one class, of which the smallest doc_id stands for
    all. Sketches are cut into ``bands`` of ``rows`` coordinates each; classes that
    agree in a band are candidates, and the full sets decide. Candidates come with a
    probability of 1 - (1 - s^rows)^bands at similarity s; nothing else is left out.

    Repeated rows give repeated results. A component whose doc_ids are all missing has
    a missing id, and its rows are kept. An empty table gives no rows. Only the two
    columns are read, so others may have any name.
    """
    keyed = docs.select(
        row_key(named(docs, doc_id), named(docs, text)).alias("key"),
        named(docs, doc_id).alias("doc_id"),
        named(docs, text).alias("text"),
    )
    found = stage(_sketched(keyed, shingle, bands, rows), "sketches")
    digest = F.struct("n", "d1", "d2").alias("digest")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    same = found.where("n > 0").groupBy(digest).agg(
        first.alias("first"), F.count("*").alias("copies"), F.first("bands").alias("bands")
    )
    classes = stage(
        same.select(
            F.monotonically_increasing_id().alias("class"),
            "digest",
            F.col("digest.n").alias("n"),
            F.col("first.doc_id").alias("first_id"),
            F.col("first.key").alias("key"),
            "copies",
            "bands",
        ),
        "classes",
    )
    marks = classes.select("class", F.explode("bands").alias("bucket"))
    buckets = marks.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    # a class is in a bucket once, so no bucket has more than one in ``bands`` of the rows
    members = stage(marks.join(stage(buckets.select("bucket"), "buckets"), "bucket", "left_semi"), "members")

    needed = classes.select("class", "key").join(members.select("class").distinct(), "class", "left_semi")
    texts = keyed.select("key", "text").join(needed, "key").dropDuplicates(["key"])
    sets = stage(_sets(texts, shingle), "sets")

    roots = components(_links(members, sets, percent)).withColumnRenamed("node", "class")
    rooted = classes.select("class", "digest", "first_id", "copies").join(roots, "class", "left")
    rooted = stage(rooted.withColumn("root", F.coalesce("root", "class")), "rooted")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = stage(rooted.join(ids, "root").select("digest", "copies", "component_id"), "labels")

    plain = found.select("doc_id", F.col("n").alias("n_shingles"), digest)
    linked = join_hot(plain.where("n_shingles > 0"), labels, "digest", "copies")
    alone = plain.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    every = linked.unionByName(alone).drop("digest")
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
