"""The whole pipeline against a plain version of every stage."""

from __future__ import annotations

import base64

import public_tokenizers as public
import tiktoken
from test_decontamination import expected as leaks
from test_line_dedup import expected as without_lines
from test_simhash_dedup import expected as near

import __spark_entry__
import corpus_pipeline
from tableferry.llm.queries import QUERIES


def test_stages(spark, small):
    rejected = {
        r.doc_id for r in QUERIES["op6_quality_classifier"](spark, small).where("predicted = 0").collect()
    }
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in rejected]
    assert rejected and len(rows) > 100

    rows = [(i, t) for i, t, _, _ in without_lines(rows, 10)]
    rows = [r for r, c in zip(sorted(rows), sorted(near(rows))) if c[0] == c[2]]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    leaky = {doc_id for doc_id, *_ in leaks(rows, items)}
    rows = [r for r in rows if r[0] not in leaky]

    with open(public.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = corpus_pipeline.run(spark, small).collect()
    got = sorted((r.doc_id, r.text, list(r.ids), bytes(r.decoded)) for r in found)
    assert got == sorted((i, t, own.encode_ordinary(t), t.encode()) for i, t in rows)


def test_stages_keep_the_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, small).columns == docs.columns, name


def test_empty_and_odd_documents(spark, small):
    schema = spark.read.parquet(f"{small}/documents.parquet").schema
    for rows in ([], [(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0)]):
        docs = spark.createDataFrame(rows, schema)
        for _, function in corpus_pipeline.STAGES:
            docs = function(spark, docs, small)
        assert docs.count() <= len(rows)


def test_registered():
    found = __spark_entry__.queries()
    assert "pipeline" in found
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in found}
