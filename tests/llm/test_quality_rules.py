from __future__ import annotations

import math
import re
from collections import Counter

import pytest
import xxhash

from tableferry.llm.quality_rules import judge

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BUCKETS = 64


def measured(text):
    text = text or ""
    found = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    again = {
        i + k
        for i in range(len(found) - 4)
        if windows[tuple(found[i : i + 5])] > 1
        for k in range(5)
    }
    failed = len(found) < 10 or 100 * len(again) > 20 * len(found)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(again), failed)


def grams(text):
    found = [w.encode() for w in WORD.findall(text or "")]
    ones = [xxhash.xxh64_intdigest(w, seed=42) for w in found]
    twos = [xxhash.xxh64_intdigest(b, seed=h) for h, b in zip(ones, found[1:])]
    signed = [h - 2**64 if h >= 2**63 else h for h in ones + twos]
    return [h % BUCKETS for h in signed]


def ratios(rows, trusted):
    every, chosen = Counter(), Counter()
    for doc_id, text in rows:
        every.update(grams(text))
        if doc_id in trusted:
            chosen.update(grams(text))
    total, n = every.total(), chosen.total()

    def weight(b):
        if not n:
            return 0
        share = (chosen[b] + 1) / (n + BUCKETS)
        return round(math.log(share / ((every[b] + 1) / (total + BUCKETS))) * 2**20)

    return [
        sum(map(weight, grams(t))) / max(len(grams(t)), 1) / 2**20 for _, t in rows
    ]


PROSE = "it was the best of times and it was the worst of times for all of us"
CASES = [
    (1, PROSE),
    (2, "a&&& b### c$$$ d|| e<> f%% g** h## i&& j$$ k%% l**"),
    (3, "same line here\nsame line here\n\n \nother\nsame line here "),
    (4, "one two three four five six " * 4),
    (5, ""),
    (6, None),
    (7, " \t\n\x0b"),
    (8, "É étoile \x85 \U0001f600 ñ a b c d e f g h"),
    (9, "word " * 9),
    (10, "word" + " x y z" * 20000),
    (11, PROSE + " " + PROSE),
    (12, "z" * 70000 + " a b c d e f g h i j k"),
    (13, PROSE),
    (13, PROSE),
    (None, PROSE),
    (14, "p q r s t p q r s t p q r s u v w x y 1 2 3 4 5 6 7 8 9"),
]


@pytest.mark.parametrize("trusted", [(1, 8), ()])
def test_cases(spark, frame, trusted):
    ids = spark.createDataFrame([(i,) for i in [*trusted, *trusted, None]], "doc_id long")
    found = judge(frame(CASES), ids, threshold=-0.1, n_buckets=BUCKETS)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = sorted(
        ((r.doc_id, *[r[n] for n in names], round(r.llr, 4), r.kept) for r in found.collect()), key=repr
    )
    want = []
    for (doc_id, text), llr in zip(CASES, ratios(CASES, trusted)):
        base = measured(text)
        want.append((doc_id, *base, round(llr, 4), not base[-1] and llr >= -0.1))
    assert got == sorted(want, key=repr)


def test_no_rows_and_other_columns(spark, frame):
    ids = spark.createDataFrame([(1,)], "doc_id long")
    assert judge(frame([]), ids).collect() == []
    odd = frame([(1, PROSE, 5, 6, "w")], "doc_id long, text string, key int, n_words int, words string")
    row = judge(odd, ids).first()
    assert (row["key"], row["n_words"], row["words"]) == (5, len(PROSE.split()), "w")


def test_good_documents_are_kept(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    judged = judge(docs, labels.where("quality = 1").select("doc_id")).join(labels, "doc_id").collect()
    sound = [r for r in judged if not r.base_failed]
    good = [r.kept for r in sound if r.quality == 1]
    bad = [r.kept for r in sound if r.quality == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.1 * len(bad)
