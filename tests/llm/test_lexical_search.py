from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tableferry.llm import lexical_search as module
from tableferry.llm.lexical_search import search
from tableferry.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=50):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in set(items):
        found = []
        for (doc_id, c), size in zip(counts, sizes):
            m = 50 + (50 * size * n) // max(total, 1)
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        found.sort(key=lambda f: f[:3])
        out += [(item_id, rank, f[3], -f[0]) for rank, f in enumerate(found[:top], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


DOCS = [
    (1, "The cat sat on the mat"), (2, "the CAT, the cat!"), (3, "dog"), (4, None), (5, ""), (6, " .,; "),
    (7, "cat dog"), (8, "dog cat"), (9, "Dog-cat"), (None, "cat dog"), (7, "cat dog"),
    (10, "Ünïcode ünïcode x1y2"), (11, "cat " * 30000), (12, "déjà vu cat"), (13, "x\x00y\x7fz"),
    (14, "zebra"), (15, "quagga"),
]
FOUND = [
    (100, "cat dog"), (101, "DOG dog dog"), (102, None), (103, "..."), (104, "Ünïcode é 1"), (104, "zebra"),
    (105, "nothing of this"), (100, "cat dog"), (None, "quagga x y z"), (106, "the cat sat on the mat déjà"),
]


def test_cases(spark, frame):
    items = spark.createDataFrame(FOUND, ITEMS)
    assert got(search(frame(DOCS), items)) == brute(DOCS, FOUND)
    assert got(search(frame(DOCS), items, top=2)) == brute(DOCS, FOUND, 2)


def test_many_copies_are_ranked_by_id(spark, frame):
    """More copies than can be listed, over several tasks, and classes that tie."""
    docs = [(i, "red apple") for i in range(200, 0, -1)] + [(i, "apple red") for i in range(300, 400)]
    docs += [(i, f"filler {i}") for i in range(400, 1400)] + [(-3, "red apple pie"), (-4, "red")]
    items = [(1, "red apple"), (2, "pie"), (3, "apple")]
    for top in (1, 7, 50):
        assert got(search(frame(docs).repartition(7), spark.createDataFrame(items, ITEMS), top)) == brute(docs, items, top)


@pytest.mark.parametrize("size", [1, 2000, 1 << 25])
def test_blocks_of_items(spark, frame, size, monkeypatch):
    rng = random.Random(size)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 25)))) for i in range(150)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 9)))) for i in range(7)]
    monkeypatch.setattr(module, "BLOCK_BYTES", size)
    assert got(search(frame(docs), spark.createDataFrame(items, ITEMS), 5)) == brute(docs, items, 5)


def test_sums_past_the_exact_doubles(spark, frame, monkeypatch):
    monkeypatch.setattr(module, "EXACT", 1)
    items = spark.createDataFrame(FOUND, ITEMS)
    assert got(search(frame(DOCS), items)) == brute(DOCS, FOUND)


def test_no_rows_and_other_columns(spark, frame):
    items = spark.createDataFrame(FOUND, ITEMS)
    assert search(frame([]), items).collect() == []
    empty = search(frame(DOCS), spark.createDataFrame([], ITEMS))
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]
    odd = [(i, t, 1, "x") for i, t in DOCS]
    df = frame(odd, "doc_id long, text string, rank int, score string")
    assert got(search(df, items)) == brute(DOCS, FOUND)


def test_query(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(QUERIES["op13_lexical_search"](spark, small)) == brute(docs, items)
