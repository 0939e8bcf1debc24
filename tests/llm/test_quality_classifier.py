from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np

from tableferry.llm import quality_classifier as module
from tableferry.llm.queries import QUERIES
from tableferry.llm.quality_classifier import N_FEATURES, features, fit, score

LABELS = "doc_id long, quality int, toxic int"
CASES = [
    (1, "a fine text of plain words that says something"),
    (2, "JUNK!! JUNK!! JUNK!!"),
    (3, None),
    (4, ""),
    (5, " \n\t"),
    (None, "without an id"),
    (6, "copy"),
    (6, "copy"),
    (7, "long " * 50000),
]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = score(docs, labels).select("doc_id", "held_out", "score", "predicted").collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.held_out == held_out(r.doc_id)
        assert 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
    known = {r.doc_id: r.quality for r in labels.collect()}
    tested = [(r.predicted, known[r.doc_id]) for r in found if r.held_out and r.doc_id in known]
    assert np.mean([p == q for p, q in tested]) >= 0.95


def test_held_out_labels_teach_nothing(spark, frame):
    rows = [(i, "plain words of a text" if i % 2 else "JUNK!! ***") for i in range(60)]
    plain = [(i, i % 2, 0) for i in range(60)]
    turned = [(i, 1 - q if held_out(i) else q, 0) for i, q, _ in plain]
    results = [
        sorted(map(tuple, score(frame(rows), spark.createDataFrame(x, LABELS)).select("doc_id", "score").collect()))
        for x in (plain, turned)
    ]
    assert results[0] == results[1]


def test_cases(spark, frame):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (4, 0, 0), (None, 0, 0), (7, None, 0)], LABELS)
    found = score(frame(CASES), labels).collect()
    assert sorted((str(r.doc_id), r.text) for r in found if r.text) == sorted(
        (str(i), t) for i, t in CASES if t
    )
    assert len(found) == len(CASES)
    assert all(0 <= r.score <= 1 for r in found)
    scores = {r.text: r.score for r in found}
    assert scores[None] == scores[""]
    assert len({r.score for r in found if r.doc_id == 6}) == 1


def test_rows_that_teach_are_bounded(spark, frame, monkeypatch):
    """An id with very many texts brings no more of them to the driver than the bound."""
    seen = []
    monkeypatch.setattr(module, "fit", lambda good, bad, run=fit: seen.append((len(good), len(bad))) or run(good, bad))
    ids = [i for i in range(40) if not held_out(i)]
    rows = [(ids[0], f"text number {i}") for i in range(300)] + [(i, f"JUNK {i} ***") for i in ids[1:30]]
    labels = spark.createDataFrame([(ids[0], 1, 0)] + [(i, 0, 0) for i in ids[1:30]], LABELS)
    assert score(frame(rows), labels, sample_docs=20).count() == len(rows)
    assert seen == [(20, 20)]


def plain_scores(docs, labels, threshold=0.3):
    """The scores of all documents, worked out without Spark from the same sample."""
    teach = {}
    for doc_id, quality in labels:
        if quality in (0, 1) and not held_out(doc_id):
            teach[doc_id] = min(quality, teach.get(doc_id, 1))
    known = sorted((d, md5_key(d, t), teach[d], features(t)) for d, t in set(docs) if d in teach)
    weights = fit(*[np.array([v for *_, q, v in known if q == wanted]) for wanted in (1, 0)])
    value = {(d, t): features(t) @ weights for d, t in docs}
    taught = sorted((value[d, t], teach[d]) for d, t in docs if d in teach)
    bad = sum(q == 0 for _, q in taught) / len(taught)
    cut = taught[max(math.ceil(bad * len(taught)) - 1, 0)][0]
    odds = (1 - threshold) / threshold
    return {d: threshold if v == cut else 1 / (1 + odds * math.exp(min(cut - v, 700))) for (d, _), v in value.items()}


def md5_key(doc_id, text):
    return hashlib.md5(f"{len(str(doc_id))}:{doc_id}{text or ''}".encode()).digest()


def test_scores_against_a_plain_version(spark):
    """The registered query: every score, and what it is predicted to be."""
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality").collect()]
    want = plain_scores(docs, labels)
    found = QUERIES["op6_quality_classifier"](spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        assert abs(r.score - want[r.doc_id]) < 1e-9 and r.predicted == int(want[r.doc_id] >= 0.3)
        assert r.held_out == held_out(r.doc_id)


def test_without_labels_nothing_is_rejected(spark, frame):
    for given in ([], [(1, 1, 0)]):
        found = score(frame(CASES), spark.createDataFrame(given, LABELS)).collect()
        assert {(r.score, r.predicted) for r in found} == {(0.3, 1)}


def test_no_rows_and_other_columns(spark, frame):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], LABELS)
    assert score(frame([]), labels).collect() == []
    odd = frame([(1, "x", 5, "v", 9)], "doc_id long, text string, key int, value string, score int")
    row = score(odd, labels).first()
    assert (row["key"], row["value"], row["predicted"]) == (5, "v", 1)


def test_fit_ranks_good_over_bad():
    good = np.array([features("plain words of a text"), features("another sentence, of words.")])
    bad = np.array([features("&&& *** $$$"), features("x x x x x x")])
    weights = fit(good, bad)
    assert (good @ weights).min() > (bad @ weights).max()
    assert not fit(good[:0], bad).any()
    assert features(None).shape == (N_FEATURES,)
