"""From raw documents to a clean corpus: each stage takes what the one before kept.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and
returns a frame, which is written and read again before the next one. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tableferry.llm.bpe import encode
from tableferry.llm.common import stage, staged
from tableferry.llm.decontamination import drop_contaminated
from tableferry.llm.line_dedup import drop_shared_lines
from tableferry.llm.quality_classifier import score
from tableferry.llm.simhash_dedup import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, labels, threshold=0.3).where("predicted = 1").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go; documents stay."""
    return drop_shared_lines(docs, min_documents=10, min_chars=1).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays."""
    return keep_one(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item stands go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and the bytes that the ids decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE encoding and decoding", tokens),
]

# The classifier, the fingerprints and the tokens have no SQL; the tests compare
# the pipeline with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written; all but the last one's rows is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with staged(spark):
        for name, function in STAGES:
            with staged(spark):
                docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
