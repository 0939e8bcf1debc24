from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tableferry.llm import simhash_dedup
from tableferry.llm.queries import QUERIES
from tableferry.llm.simhash_dedup import components, keep_one, near_duplicates, trie_links, walk_pair

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text, shingle=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def connected(values, max_bits):
    """The least value that links lead to, for each distinct value."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def expected(rows, shingle=3, max_bits=2):
    prints = [fingerprint(t, shingle) for _, t in rows]
    roots = connected(prints, max_bits)
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[roots[p]] = min(doc_id, least.get(roots[p], doc_id))
    return sorted(
        ((i, f"{p:016x}", least.get(roots[p])) for (i, _), p in zip(rows, prints)), key=repr
    )


def got(df):
    return sorted(
        ((r.doc_id, f"{r.fingerprint % 2**64:016x}", r.component_id) for r in df.collect()), key=repr
    )


CASES = [
    (1, "One two three four five six"),
    (2, "one TWO three  four\tfive six"),
    (3, "one two"),
    (4, ""),
    (5, None),
    (6, " \n\t "),
    (7, "Étoile é a"),
    (8, "étoile é a"),
    (9, "x"),
    (9, "x"),
    (None, "x"),
    (None, "only without an id"),
    (10, "same " * 9),
    (11, "w" * 70000),
    (12, " ".join(f"w{i}" for i in range(30000))),
]


def test_cases(frame):
    assert got(near_duplicates(frame(CASES))) == expected(CASES)


def test_no_rows(frame):
    assert got(near_duplicates(frame([]))) == []
    assert keep_one(frame([])).collect() == []


def test_query(spark, small):
    rows = [
        (r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()
    ]
    found = QUERIES["op8_simhash_near_dedup"](spark, small).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


def near_values(seed, n):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 9)):
            out.add(v)
            v ^= 1 << rng.randrange(64)
            v ^= rng.choice((0, 1 << rng.randrange(64)))
    return sorted(out)


@pytest.mark.parametrize(("leaf_rows", "max_bits"), [(2, 2), (4096, 5)])
def test_trie_finds_all_components(spark, leaf_rows, max_bits):
    values = near_values(max_bits, 300) + [0, 2**64 - 1, 2**63, 1]
    values = sorted(set(values))
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    prints = spark.createDataFrame(signed, "fingerprint long")
    links = trie_links(prints, max_bits, leaf_rows)
    roots = {r.node % 2**64: r.root % 2**64 for r in components(links).collect()}
    groups, want = {}, {}
    for v in values:
        groups.setdefault(roots.get(v, v), set()).add(v)
    for v, root in connected(values, max_bits).items():
        want.setdefault(root, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_only_small_nodes_are_gathered(spark, monkeypatch):
    rng = random.Random(1)
    values = [rng.getrandbits(63) for _ in range(300)] + list(range(0, 3000, 7))
    prints = spark.createDataFrame([(v,) for v in sorted(set(values))], "fingerprint long")
    gather, F = simhash_dedup.F.collect_list, simhash_dedup.F

    def checked(column):
        large = F.raise_error(F.lit("a large node is gathered")).cast("array<long>")
        return F.when(F.count(column) <= 20, gather(column)).otherwise(large)

    whole = {tuple(sorted(r)) for r in components(trie_links(prints, 2)).collect()}
    monkeypatch.setattr(F, "collect_list", checked)
    cut = {tuple(sorted(r)) for r in components(trie_links(prints, 2, leaf_rows=20)).collect()}
    assert cut == whole


def test_a_cut_frontier_finds_the_same(monkeypatch):
    values = np.array(near_values(3, 400), np.uint64)
    whole = walk_pair(values, values, 0, 0, 3)
    monkeypatch.setattr(simhash_dedup, "FRONTIER", 16)
    cut = walk_pair(values, values, 0, 0, 3)
    assert set(zip(*map(list, whole))) == set(zip(*map(list, cut)))


def test_long_chain_of_links(spark):
    chain = [(i, i + 1) for i in range(60)]
    links = spark.createDataFrame(chain, "u long, v long")
    assert {(r.node, r.root) for r in components(links).collect()} == {
        (i, 0) for i in range(1, 61)
    }


def test_one_of_each_group_stays(frame):
    rows = [(i, t, "k") for i, t in CASES]
    kept = keep_one(frame(rows, "doc_id long, text string, key string"))
    assert kept.columns == ["doc_id", "text", "key"]
    ids = [r.doc_id for r in kept.collect()]
    groups = {c if c is not None else i for i, _, c in expected(CASES)}
    assert sorted(ids, key=repr) == sorted(groups, key=repr)
