"""Bradley-Terry ranking of documents by quality, cut at a quantile of the scores."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import free_name, named, row_key, stage

# At most so many labelled documents of each class are learned from, and so many pairs.
SAMPLE_DOCS = 10_000
PAIRS = 200_000

_GROUPS = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b"#*$%&<>",
    b"|",
    b"!?",
    b".,;:",
    b"/\\_=+-@~^[]{}()\"'`",
    b"\n",
]
_CLASSES = np.zeros((256, len(_GROUPS)))
for _k, _group in enumerate(_GROUPS):
    _CLASSES[list(_group), _k] = 1
N_FEATURES = len(_GROUPS) + 9


def features(text: str | None) -> np.ndarray:
    """What a document's text shows of its quality: shares of marks, repeats and lengths."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n = max(len(words), 1)
    per_word = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = Counter(zip(words, words[1:], words[2:]))
    again = sum(c for c in triples.values() if c > 1)
    out = np.empty(N_FEATURES)
    out[: len(_GROUPS)] = np.minimum(np.sqrt(per_word), 2)
    out[len(_GROUPS) :] = (
        math.log1p(len(words)) / 10,
        min(len(words), 20) / 20,
        min(len(raw) / n, 30) / 10,
        len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        again / n,
        1 - len(set(lines)) / max(len(lines), 1),
        math.sqrt(max(Counter(words).values(), default=0) / n),
        math.sqrt(sum(w.isupper() for w in words) / n),
    )
    return out


def _featured(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """(key, doc_id, text) with each text turned into its features, or into its utility."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features(t) for t in batch.column("text").to_pylist()])
            rows = rows.reshape(-1, N_FEATURES)
            if weights is None:
                value = pa.array(list(rows), pa.list_(pa.float64()))
            else:
                value = pa.array(rows @ weights)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), value], ["key", "doc_id", "value"]
            )

    kind = "array<double>" if weights is None else "double"
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(turn, f"key binary, doc_id {id_type}, value {kind}")


def fit(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-4) -> np.ndarray:
    """Weights under which a good document is preferred to a bad one.

    Logistic loss on the differences of the features of paired documents, with
    a ridge, by Newton steps. Pairs are dealt out by a seeded generator.
    """
    if not len(good) or not len(bad):
        return np.zeros(N_FEATURES)
    rng = np.random.default_rng(7)
    n = min(pairs, len(good) * len(bad))
    x = good[rng.integers(0, len(good), n)] - bad[rng.integers(0, len(bad), n)]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(np.clip(x @ w, -50, 50)))
        slope = ridge * w - x.T @ p / n
        curve = (x * (p * (1 - p))[:, None]).T @ x / n + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step * min(1, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    sample_docs: int = SAMPLE_DOCS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 or 0).

    ``labels`` has doc_id and quality (1 or 0). Rows whose crc32 of the doc_id as
    text is divisible by 5 are held out; the rest teach. The weights are learned
    from pairs of a good and a bad document, drawn from at most ``sample_docs`` of
    each class, ids as well as rows. Only the text is looked at, whole. The utility at
    the quantile that equals the share of bad documents among all that teach becomes
    the score ``threshold``; from there on ``predicted`` is 1. That quantile is
    Spark's approximate one: of n documents that teach, its rank may be off by
    n / 100,000, and by another such number in another run.

    Missing texts count as empty and are scored like any other. A missing doc_id is
    not held out and never taught from. Of repeated labels of a document the
    lowest counts; other or missing qualities teach nothing. Without labels of both classes every score
    is the threshold, and nothing is rejected. Repeated rows get equal scores. An
    empty table gives no rows. Columns of the same names as the added ones are
    replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")
    fold = F.crc32(named(docs, doc_id).cast("string").cast("binary")) % 5
    held_out = F.coalesce(fold == 0, F.lit(False))
    slim = docs.select(
        row_key(named(docs, doc_id), named(docs, text)).alias("key"),
        named(docs, doc_id).alias("doc_id"),
        named(docs, text).alias("text"),
    )
    teach = (
        labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("quality in (0, 1)")
        .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    teach = stage(teach, "teach")

    order = F.xxhash64("doc_id")
    drawn = [
        teach.where(F.col("quality") == q).orderBy(order, "doc_id").limit(sample_docs) for q in (0, 1)
    ]
    # at most twice sample_docs ids, and then as many rows: an id may have many texts
    qualities = drawn[0].unionByName(drawn[1])
    texts = slim.join(F.broadcast(qualities), "doc_id").dropDuplicates(["key"])
    by_key = [
        texts.where(F.col("quality") == q).orderBy(F.xxhash64("key"), "key").limit(sample_docs) for q in (0, 1)
    ]
    sample = by_key[0].unionByName(by_key[1])
    rows = _featured(sample.select("key", "doc_id", "text")).join(qualities, "doc_id")
    known = sorted((r.doc_id, r.key, r.quality, r.value) for r in rows.collect())
    classes = [
        np.array([v for *_, q, v in known if q == wanted]).reshape(-1, N_FEATURES) for wanted in (1, 0)
    ]
    weights = fit(*classes)

    found = stage(_featured(slim, weights), "utilities")
    taught = found.join(teach, "doc_id")
    bad = taught.agg(F.avg(1 - F.col("quality"))).first()[0]
    cut = 0.0
    if weights.any() and bad is not None:
        cut = taught.agg(F.percentile_approx("value", F.lit(float(bad)), F.lit(100_000))).first()[0]
    # a utility at the cut gets the threshold itself
    away = F.exp(F.least(F.lit(cut) - F.col("value"), F.lit(700.0)))
    odds = (1 - threshold) / threshold
    value = F.when(F.col("value") == cut, F.lit(threshold)).otherwise(1 / (1 + odds * away))

    key, utility = free_name(docs, "key"), free_name(docs, "score")
    scores = found.select(F.col("key").alias(key), value.alias(utility)).dropDuplicates([key])
    scored = docs.withColumns(
        {key: row_key(named(docs, doc_id), named(docs, text)), "held_out": held_out}
    ).join(scores, key)
    return (
        scored.withColumn("score", F.col(utility))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
        .drop(key, utility)
    )
