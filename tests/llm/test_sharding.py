import collections

import pytest
from pyspark.sql import functions as F

from basketseq.llm import sharding
from tests.llm import edge


def check(docs, placed, shards):
    rows = placed.collect()
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[i]) for i in range(shards)]
    assert max(counts) - min(counts) <= 1
    want = collections.Counter(map(tuple, docs.collect()))
    assert collections.Counter(tuple(r.row) for r in rows) == want
    return rows


@pytest.mark.parametrize("bucket_bytes", [1_000, 100_000, 8 << 20])
def test_tables(spark, bucket_bytes):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = check(docs, sharding.sharded(docs, bucket_bytes=bucket_bytes), 8)
    line = [r.row.doc_id for r in sorted(rows, key=lambda r: (r.slot, r.shard))]
    fixed = sum(a < b for a, b in zip(line, line[1:], strict=False))
    assert 0.4 < fixed / len(line) < 0.6


def test_copies_scatter(spark):
    docs = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    check(docs, sharding.sharded(docs, shards=3, bucket_bytes=500), 3)


def test_edge_rows(spark, tmp_path):
    docs = edge.frame(spark)
    check(docs, sharding.sharded(docs), 8)
    check(docs, sharding.sharded(docs, shards=40), 40)
    assert sharding.sharded(edge.empty(spark)).count() == 0
    sharding.write_shards(docs.select("doc_id", "text"), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(edge.ROWS)
    assert {r.shard for r in back.collect()} == {0, 1, 2, 3}
