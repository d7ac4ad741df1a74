import os
import random

import pytest
from pyspark.sql import functions as F

from basketseq.operators import baskets, enrich, incremental
from basketseq.sources.shared import shared_folder
from tests.brute import random_source
from tests.frames import source_tables


def sequences(items):
    return baskets.user_sequences(baskets.order_baskets(items))


def stored(spark, path, rows):
    return rows(baskets.sequence_text(incremental.read_users(spark, path)))


@pytest.mark.parametrize("seed", [1, 2])
def test_three_batches_equal_a_rebuild(spark, tmp_path, rows, seed):
    """Batches of whole orders, drawn without regard to their age."""
    items = enrich.enriched_items(source_tables(spark, random_source(seed)))
    rng = random.Random(seed)
    orders = sorted(r.order_id for r in items.select("order_id").distinct().collect())
    batch = {o: rng.randrange(4) for o in orders}
    path = tmp_path / "user_data"

    def part(number):
        return items.where(F.col("order_id").isin([o for o in orders if batch[o] == number]))

    incremental.build_users(sequences(part(0)), path, n_buckets=5)
    for number in (1, 2, 3):
        incremental.merge_orders(spark, path, part(number))
        seen = items.where(F.col("order_id").isin([o for o in orders if batch[o] <= number]))
        assert stored(spark, path, rows) == rows(baskets.sequence_text(sequences(seen)))
    assert stored(spark, path, rows) == rows(baskets.sequence_text(sequences(items)))


def folders(path):
    return {
        name: {(f, os.stat(path / name / f).st_mtime_ns) for f in os.listdir(path / name)}
        for name in os.listdir(path)
        if name.startswith("bucket_of")
    }


def test_only_touched_buckets_are_read_and_written(spark, tmp_path, rows, capsys):
    items = enrich.enriched_items(source_tables(spark, random_source(3)))
    path = tmp_path / "user_data"
    incremental.build_users(sequences(items), path, n_buckets=8)
    user = items.select(F.min("user_id")).first()[0]
    before = folders(path)
    new = items.where(F.col("user_id") == user).withColumn("order_id", F.col("order_id") + 900_000)
    touched = incremental.merge_orders(spark, path, new)
    after = folders(path)
    assert len(touched) == 1
    changed = {name for name in after if after[name] != before.get(name)}
    assert changed == {f"bucket_of_8={touched[0]}"}
    assert not [name for name in os.listdir(tmp_path) if name != "user_data"], "nothing is left"
    capsys.readouterr()
    incremental.stored_buckets(spark, path, touched).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and f"= {touched[0]}" in plan or f"IN ({touched[0]}" in plan
    opened = incremental.stored_buckets(spark, path, touched).select(F.input_file_name()).distinct()
    assert all(f"bucket_of_8={touched[0]}/" in r[0] for r in opened.collect())


def test_a_stored_order_is_replaced(spark, tmp_path, rows):
    items = enrich.enriched_items(source_tables(spark, random_source(4)))
    path = tmp_path / "user_data"
    incremental.build_users(sequences(items), path, n_buckets=3)
    order = items.select(F.min("order_id")).first()[0]
    new = items.where(F.col("order_id") == order).withColumn("reordered", F.lit(1).cast("tinyint"))
    incremental.merge_orders(spark, path, new)
    whole = items.where(F.col("order_id") != order).unionByName(new)
    assert stored(spark, path, rows) == rows(baskets.sequence_text(sequences(whole)))


def test_edges(spark, tmp_path, rows):
    items = enrich.enriched_items(source_tables(spark, random_source(5)))
    path = tmp_path / "user_data"
    with pytest.raises(ValueError):
        incremental.build_users(sequences(items), path, n_buckets=0)
    incremental.build_users(sequences(items.where("user_id < 3")), path, n_buckets=4)
    assert incremental.merge_orders(spark, path, items.limit(0)) == []
    # Users of buckets that did not exist yet.
    incremental.merge_orders(spark, path, items.where("user_id >= 3"))
    assert stored(spark, path, rows) == rows(baskets.sequence_text(sequences(items)))
    plain = tmp_path / "plain"
    sequences(items).write.parquet(str(plain))
    with pytest.raises(ValueError):
        incremental.merge_orders(spark, plain, items)


def test_new_items_are_computed_once(spark, tmp_path, rows):
    """However many steps of the merge use the new orders; nothing is left behind."""
    items = enrich.enriched_items(source_tables(spark, random_source(4)))
    path, seen = tmp_path / "user_data", spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(order_id):
        seen.add(1)
        return True

    is_new = F.col("order_id") % 2 == 0
    incremental.build_users(sequences(items.where(~is_new)), path, n_buckets=3)
    # Fixed rows, so that the counting filter stays above them.
    new = spark.createDataFrame(items.where(is_new).collect(), items.schema)
    new = new.where(counted.asNondeterministic()("order_id"))
    before = set(os.listdir(shared_folder(spark)))
    assert incremental.merge_orders(spark, path, new)
    assert seen.value == items.where(is_new).count() > 0
    assert set(os.listdir(shared_folder(spark))) == before
    assert stored(spark, path, rows) == rows(baskets.sequence_text(sequences(items)))
