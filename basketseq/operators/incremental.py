"""User sequences that take in new orders without being rebuilt.

The table is stored as typed arrays in a fixed number of buckets of users, each a
folder (``bucket_of_<n>=<i>``). New orders touch the buckets of their users: only
these are read (partition pruning) and replaced; within them, users without new
orders pass through as they are, and the others' orders are taken apart, united with
the new ones and put together again by the same code that builds the table.

An order arrives whole. One that is stored already is replaced by its new items. An
order may be older than stored ones: it takes its place by its number. The result
equals a rebuild from all items.

Bucket folders are written beside the table and renamed into place one by one. The
driver handles folder names only, never rows: ``n_buckets`` of them at most.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketseq import schemas
from basketseq.operators import baskets
from basketseq.sources.files import child, read_parquet
from basketseq.sources.shared import drop_folder, new_folder
from basketseq.sources.staged import beside, exists, put_in_place

_PREFIX = "bucket_of_"


def bucket_of(user: Column, n_buckets: int) -> Column:
    """By the text of the id, so that integer widths don't matter."""
    return F.pmod(F.xxhash64(user.cast("string")), F.lit(n_buckets)).cast("int")


def _write_buckets(users: DataFrame, path: str, n_buckets: int) -> None:
    name = f"{_PREFIX}{n_buckets}"
    placed = users.withColumn(name, bucket_of(F.col("user_id"), n_buckets))
    # AQE splits a large bucket over several files and joins small ones in a task.
    placed.hint("rebalance", name).write.partitionBy(name).parquet(path)


def build_users(sequences: DataFrame, path, n_buckets: int = 256) -> None:
    """Store ``user_sequences`` in buckets; replaces a table at ``path``."""
    if n_buckets < 1:
        raise ValueError(f"n_buckets must be positive, not {n_buckets}")
    spark, staged = sequences.sparkSession, beside(path, "staged")
    _write_buckets(sequences, staged, n_buckets)
    put_in_place(spark, staged, str(path))


def bucket_count(spark: SparkSession, path) -> int:
    """The number of buckets, which the folder names carry."""
    names = [c for c in read_parquet(spark, path).columns if re.fullmatch(rf"{_PREFIX}\d+", c)]
    if len(names) != 1:
        raise ValueError(f"{path} is not stored in buckets of users")
    return int(names[0].removeprefix(_PREFIX))


def read_users(spark: SparkSession, path) -> DataFrame:
    """The sequences, without the bucket column."""
    return read_parquet(spark, path).select(schemas.USER_SEQUENCES)


def orders_of_sequences(users: DataFrame) -> DataFrame:
    """The baskets that ``user_sequences`` was made from. Only the last order of a user
    knows its split, which is all that the sequences need of it."""
    fields = {**baskets._FLAT, **baskets._NESTED}
    orders = F.posexplode(F.arrays_zip(*fields)).alias("at", "o")
    apart = users.select("user_id", "eval_set", F.size("order_ids").alias("n"), orders)
    split = F.when(F.col("at") == F.col("n") - 1, F.col("eval_set"))
    return apart.select(
        "user_id",
        *[F.col(f"o.{name}").alias(field) for name, field in fields.items()],
        split.alias("eval_set"),
    )


def merged_users(stored: DataFrame, new_baskets: DataFrame) -> DataFrame:
    """``stored`` sequences with the new orders taken in."""
    fresh = new_baskets.withColumn("order_id", F.col("order_id").cast("string"))
    touched = fresh.select(F.col("user_id").alias("touched")).distinct()
    is_touched = F.col("user_id").eqNullSafe(F.col("touched"))
    same = F.col("user_id").eqNullSafe(F.col("new_user")) & (F.col("order_id") == F.col("new_order"))
    replaced = fresh.select(
        F.col("user_id").alias("new_user"), F.col("order_id").alias("new_order")
    ).distinct()
    old = orders_of_sequences(stored.join(touched, is_touched, "left_semi"))
    kept = old.join(replaced, same, "left_anti")
    columns = [
        F.col(f.name).cast(f.dataType).alias(f.name) for f in old.schema
    ]
    rebuilt = baskets.user_sequences(kept.unionByName(fresh.select(columns)))
    untouched = stored.join(touched, is_touched, "left_anti")
    return untouched.unionByName(rebuilt)


def merge_orders(spark: SparkSession, path, items: DataFrame) -> list[int]:
    """Take the orders of ``items`` (enriched item rows) into the table at ``path``.

    Returns the buckets that were replaced; all others are neither read nor written.
    """
    path, n_buckets = str(path).rstrip("/"), bucket_count(spark, path)
    name = f"{_PREFIX}{n_buckets}"
    # Written once: the buckets, the touched users and the merge all read the new baskets.
    kept = new_folder(spark, "new-baskets")
    staged = beside(path, "staged")
    try:
        baskets.order_baskets(items.repartition("user_id", "order_id")).write.parquet(kept)
        fresh = read_parquet(spark, kept)
        found = fresh.select(bucket_of(F.col("user_id"), n_buckets).alias("bucket")).distinct()
        buckets = sorted(row.bucket for row in found.collect())
        if not buckets:
            return []
        stored = stored_buckets(spark, path, buckets)
        _write_buckets(merged_users(stored, fresh), staged, n_buckets)
        for bucket in buckets:
            folder = f"{name}={bucket}"
            put_in_place(spark, child(staged, folder), child(path, folder))
    finally:
        drop_folder(spark, kept)
        if exists(spark, staged):
            drop_folder(spark, staged)
    return buckets


def stored_buckets(spark: SparkSession, path, buckets: list[int]) -> DataFrame:
    """The users of some buckets; the others' files are not opened."""
    name = f"{_PREFIX}{bucket_count(spark, path)}"
    found = read_parquet(spark, path).where(F.col(name).isin(buckets))
    return found.select(schemas.USER_SEQUENCES)
