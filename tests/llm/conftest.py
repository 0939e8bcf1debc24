from __future__ import annotations

import os

import pytest

SMALL = os.environ.get("TEST_SMALL_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def small():
    return SMALL


@pytest.fixture
def frame(spark):
    """Rows of (doc_id, text, more ...) as a frame of documents over a few partitions."""

    def make(found, schema=DOCS):
        return spark.createDataFrame(found, schema).repartition(3)

    return make
