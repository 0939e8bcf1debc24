"""Deal all records into shards in a random order: a shuffle in two passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.llm.common import free_name, named, row_key, stage

# Bytes and rows that a bucket holds on the average, what a row takes besides its values,
# and buckets whose offsets go to all executors.
BUCKET_BYTES = 8 << 20
BUCKET_ROWS = 1 << 16
ROW_BYTES = 64
BROADCAST_BUCKETS = 1_000_000


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    """About the memory that a value takes; for a missing one, its place."""
    place = F.lit(8).cast("long")
    if isinstance(kind, T.UserDefinedType):
        return _value_bytes(value, kind.sqlType())
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType, T.BinaryType)):
        held = F.octet_length(value)
    elif isinstance(kind, T.StructType):
        held = sum((_value_bytes(value.getField(f.name), f.dataType) for f in kind.fields), F.lit(0))
    elif isinstance(kind, T.ArrayType):
        held = F.aggregate(
            value, F.lit(0).cast("long"), lambda sum_, x: sum_ + _value_bytes(x, kind.elementType)
        )
    elif isinstance(kind, T.MapType):
        keys = _value_bytes(F.map_keys(value), T.ArrayType(kind.keyType))
        held = keys + _value_bytes(F.map_values(value), T.ArrayType(kind.valueType))
    elif isinstance(kind, T.VariantType):
        held = F.octet_length(value.cast("string"))
    else:
        return place * 2 if isinstance(kind, T.DecimalType) else place
    return place + F.coalesce(held.cast("long"), F.lit(0))


def shuffle_into_shards(
    docs: DataFrame,
    n_shards: int = 24,
    seed: int = 42,
    bucket_bytes: int = BUCKET_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """All rows with ``shard`` (0 to ``n_shards`` - 1) and ``slot``, its place in the shard from 0.

    The first pass scatters the rows by a seeded hash into buckets that fit into
    memory, as many as the size of the whole rows and their number ask for, on the
    average ``bucket_bytes`` and ``BUCKET_ROWS`` each at most. The second gathers each
    bucket, gives it a Fisher-Yates shuffle and writes it. The buckets one after
    the other are a random order of all rows, and the shards are dealt from it in
    turn: their row counts differ by at most one, and slots have no gaps.

    The hash covers the row's place in its partition, with the rows there in order
    of doc_id and text, so copies of a row spread over the buckets too, and a
    repeated task deals them again in the same way. Missing and empty texts are
    dealt like any other, as are missing doc_ids. An empty table
    gives no rows. Columns called ``shard`` and ``slot`` are replaced.
    """
    docs = docs.drop("shard", "slot")
    size = sum((_value_bytes(named(docs, f.name), f.dataType) for f in docs.schema), F.lit(ROW_BYTES))
    total, n_rows = docs.agg(F.sum(size.cast("long")), F.count("*")).first()
    n_buckets = max(1, -(-(total or 0) // bucket_bytes), -(-n_rows // BUCKET_ROWS))

    key, place = free_name(docs, "key"), free_name(docs, "place")
    row = F.struct(*[named(docs, c) for c in docs.columns])
    placed = (
        docs.select(row_key(named(docs, doc_id), named(docs, text)).alias(key), row.alias("row"))
        .sortWithinPartitions(key)
        .select(key, "row", F.monotonically_increasing_id().alias(place))
    )
    bucket = F.pmod(F.xxhash64(F.lit(seed), key, place), F.lit(n_buckets))
    gathered = placed.groupBy(bucket.alias("bucket")).agg(
        F.collect_list(F.struct(F.col(place).alias("place"), "row")).alias("rows")
    )
    order = F.array_sort("rows", lambda a, b: F.when(a["place"] < b["place"], -1).otherwise(1))
    shuffled = stage(
        gathered.select("bucket", F.posexplode(F.shuffle(order, seed)).alias("pos", "one")).select(
            "bucket", "pos", "one.row"
        ),
        "buckets",
    )

    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        shuffled.groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    if n_buckets <= BROADCAST_BUCKETS:  # one row for each bucket
        offsets = F.broadcast(offsets)
    at = F.col("offset") + F.col("pos")
    return shuffled.join(offsets, "bucket").select(
        "row.*",
        (at % n_shards).cast("int").alias("shard"),
        F.floor(at / F.lit(n_shards)).cast("long").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """A folder for each shard; within a file the rows are in order of their slots."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
