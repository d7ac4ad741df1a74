"""A two-pass external shuffle into shards of equal row counts.

Pass one scatters the rows, by a seeded hash, over buckets small enough for the
memory of a task, and writes them. Pass two gathers each bucket, shuffles it
(Spark's ``shuffle`` is a Fisher-Yates shuffle of an array) and deals the rows
out: the bucket's place in the whole plus the row's place in the bucket is the
row's place in one long shuffled line, and the line goes round the shards. So
the counts of the shards differ by one at most, and a shard's slots have no gap.

The hash covers the row's place in its input partition besides its id, so that
copies of one row, however many, scatter like any others.

All of it is DataFrame functions; no Python runs in a task.

Defined results: a null text has size 1 (no bytes) and no checksum. Repeated
rows are rows of their own. Fewer rows than shards leave the last shards empty.
Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketseq.llm.prefix_sums import sums_before
from basketseq.llm.scratch import Scratch

SHARDS = 8
SEED = 20_240_607
#: Bytes of text a bucket holds on average; a task gathers one bucket at a time.
BUCKET_BYTES = 8 << 20


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes plus one for the end of the text."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def sharded(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(row, shard, slot): each document as a struct, its shard and its place there."""
    scratch = Scratch(docs.sparkSession, "sharding")
    total = docs.agg(F.sum(text_bytes(F.col(text_col)))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    scattered = F.xxhash64(F.lit(seed), F.col(id_col), F.monotonically_increasing_id())
    first, _ = scratch.write(
        docs.select(
            F.pmod(scattered, F.lit(buckets)).alias("bucket"),
            scattered.alias("line"),
            F.struct(*docs.columns).alias("row"),
        ),
        "scattered",
    )
    counts = first.groupBy("bucket").count()
    begins = sums_before(counts, None, [F.col("bucket")], {"begin": "count"}, scratch)
    gathered = first.groupBy("bucket").agg(
        # Sorted first: what a shuffle delivers has no fixed order.
        F.sort_array(F.collect_list(F.struct("line", "row"))).alias("rows")
    )
    shuffled = gathered.join(begins, "bucket").select(
        "begin", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("place", "drawn")
    )
    place = F.col("begin") + F.col("place")
    return shuffled.select(
        F.col("drawn.row").alias("row"),
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
        F.call_function("div", place, F.lit(shards)).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """One folder per shard, each in slot order."""
    placed = sharded(docs, **options)
    (
        placed.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .select("row.*", "shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
