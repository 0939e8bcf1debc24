from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tableferry.llm.minhash_dedup import near_duplicates, shingle_sets, sketches


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, shingle, percent):
    """Sets as texts, every pair compared."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        found = {" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)}
        sets.append(found or ({" ".join(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def got(df):
    found = df.select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    return sorted((tuple(r)[:3] for r in found), key=repr)


LONG = "tail " + " ".join(f"w{i}" for i in range(20000))
CASES = [
    (1, "a b c d e f g h i j k"),
    (2, "A  b\tc d e f\x0bg h i j K"),
    (3, "a b c d e f g h i j"),
    (4, "a b c d e f g h i j k l"),
    (5, "one"),
    (6, "ONE "),
    (7, "one two"),
    (8, ""),
    (9, None),
    (9, None),
    (10, " \n\t"),
    (None, "a b c d e f g h i j k"),
    (None, "no id at all here"),
    (None, "no id at all here"),
    (11, "É é x y z"),
    (12, "é é x y z"),
    (13, LONG),
    (14, LONG + " more"),
    (15, "x\x1cy \x85 z"),
    (5, "one"),
]


@pytest.mark.parametrize("shingle, percent", [(2, 80), (1, 80), (5, 60), (3, 100)])
def test_cases(frame, shingle, percent):
    assert got(near_duplicates(frame(CASES), shingle, percent)) == brute(CASES, shingle, percent)


def test_chains_and_groups_that_are_not_all_alike(frame):
    """Families of edited copies, where most pairs are near the threshold and some links are chains."""
    rng = random.Random(5)
    rows, n = [], 0
    for family in range(4):
        base = [f"{family}x{i}" for i in range(60)]
        for _ in range(60):
            words = list(base)
            for _ in range(rng.randrange(0, 12)):
                words[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
            rows.append((n, " ".join(words)))
            n += 1
        drift = list(base)
        for step in range(25):
            drift[step * 2 % 60] = f"d{family}.{step}"
            rows.append((n, " ".join(drift)))
            n += 1
    rng.shuffle(rows)
    assert got(near_duplicates(frame(rows), 2, 80)) == brute(rows, 2, 80)


def test_no_rows_and_other_columns(spark, frame):
    assert got(near_duplicates(frame([]))) == []
    odd = [(1, "a b c", 5, "x"), (2, "a b c", 6, "y")]
    df = frame(odd, "doc_id long, text string, component_id long, key string")
    assert got(near_duplicates(df, 2)) == [(1, 2, 1), (2, 2, 1)]
    named = frame([("p", "a b"), ("q", "a b")], "`my.id` string, `a text` string")
    assert got(near_duplicates(named, 2, doc_id="my.id", text="a text")) == [("p", 1, "p"), ("q", 1, "p")]


def test_every_coordinate_fills():
    texts = ["x", "a b", " ".join(map(str, range(50))), "", " ".join(map(str, range(5000)))]
    found, starts = shingle_sets(pa.array(texts), 1)
    assert np.diff(starts).tolist() == [1, 2, 50, 0, 5000]
    sketch = sketches(found, starts, 120)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (sketch[[0, 1, 2, 4]] != none).all()


def test_agreement_of_sketches_is_the_similarity():
    rng = random.Random(3)
    for shared in (20, 100, 200):
        a = " ".join(f"s{i}" for i in range(shared)) + " " + " ".join(f"a{i}" for i in range(200 - shared))
        b = " ".join(f"s{i}" for i in range(shared)) + " " + " ".join(f"b{i}" for i in range(200 - shared))
        found, starts = shingle_sets(pa.array([a, b]), 1)
        left, right = sketches(found, starts, 2000)
        assert abs((left == right).mean() - shared / (400 - shared)) < 0.05
    assert rng


def test_batches_and_slices_do_not_matter():
    texts = pa.array(["skipped", None, "a b a b", "B a", ""])
    whole, ends = shingle_sets(texts, 2)
    part, part_ends = shingle_sets(texts.slice(2), 2)
    assert (whole[ends[2] :] == part).all() and (np.diff(ends)[2:] == np.diff(part_ends)).all()
