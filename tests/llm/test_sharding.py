from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from tableferry.llm import sharding
from tableferry.llm.queries import QUERIES
from tableferry.llm.sharding import shuffle_into_shards, write_shards

CASES = [(i, f"text {i}" * (i % 7)) for i in range(50)]
CASES += [(99, "copy")] * 40 + [(None, None), (None, ""), (100, None), (101, "w" * 100000)]


def check_law(found, n_shards):
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(n_shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert set(slots) <= set(range(n_shards))


def test_cases(frame):
    for bucket_bytes in (200, 1 << 20):
        found = shuffle_into_shards(frame(CASES), 7, bucket_bytes=bucket_bytes).collect()
        check_law(found, 7)
        assert Counter((r.doc_id, r.text) for r in found) == Counter(CASES)


def test_copies_of_a_row_spread(frame):
    found = shuffle_into_shards(frame([(1, "same text")] * 400), 4, bucket_bytes=90)
    check_law(found.collect(), 4)


def test_the_order_is_shuffled(frame):
    rows = [(i, "some text") for i in range(300)]
    found = shuffle_into_shards(frame(rows), 1, bucket_bytes=500).orderBy("slot").collect()
    ids = [r.doc_id for r in found]
    assert sorted(ids) == list(range(300))
    climbs = sum(a < b for a, b in zip(ids, ids[1:]))
    assert 110 < climbs < 190
    other = shuffle_into_shards(frame(rows), 1, seed=7, bucket_bytes=500).orderBy("slot").collect()
    assert [r.doc_id for r in other] != ids


def test_no_rows_and_other_columns(frame):
    assert shuffle_into_shards(frame([])).collect() == []
    odd = frame([(1, "a", 3, {"k": 1})], "doc_id long, text string, place int, row map<string,int>")
    assert shuffle_into_shards(odd).first().asDict() == {
        "doc_id": 1, "text": "a", "place": 3, "row": {"k": 1}, "shard": 0, "slot": 0,
    }


def largest_bucket(monkeypatch, docs, **sizes):
    kept, write = [], sharding.stage
    monkeypatch.setattr(sharding, "stage", lambda df, label: kept.append(write(df, label)) or kept[-1])
    check_law(shuffle_into_shards(docs, 3, **sizes).collect(), 3)
    return kept[0].groupBy("bucket").count().agg(F.max("count")).first()[0]


def test_buckets_are_sized_by_whole_rows(frame, monkeypatch):
    empty = frame([(i, None if i % 2 else "") for i in range(300)])
    assert largest_bucket(monkeypatch, empty, bucket_bytes=1000) < 60
    wide = [(i, "a", b"h" * 900, [{"k": "v" * 500}], None) for i in range(100)]
    wide = frame(wide, "doc_id long, text string, html binary, `a.b` array<map<string,string>>, s struct<x:int>")
    assert largest_bucket(monkeypatch, wide, bucket_bytes=6000) < 25
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 10)
    assert largest_bucket(monkeypatch, empty) < 60


def test_written_shards(spark, frame, tmp_path):
    path = str(tmp_path / "shards")
    write_shards(shuffle_into_shards(frame(CASES), 5, bucket_bytes=500), path)
    back = spark.read.parquet(path)
    assert back.count() == len(CASES)
    assert back.select("shard").distinct().count() == 5


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    df = QUERIES["op5_sharding"](spark, small)
    found = df.collect()
    assert dict(df.dtypes)["grown_shard"] == "int"
    check_law(found, 24)
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        assert (r.law, r.grown_shard) == ("rows", None)
    assert df.where(F.col("slot") < 0).count() == 0
