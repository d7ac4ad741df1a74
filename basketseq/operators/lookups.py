"""Lookups too large to broadcast, brought to users instead of moving wide pair rows.

A pair repeats its user's sequences, so that pairs moved to a lookup's rows and sorted
there fill the disk. Only (user, product) moves here, and what it finds moves back,
one array per user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def is_broadcast(table: DataFrame) -> bool:
    """Whether Catalyst takes ``table`` for small enough to broadcast it."""
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    most = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(size)) <= most


def finder() -> Column:
    """``user_id`` as a join key: a user without an id is one, too. Rows grouped by it
    lie where a join on it needs them; a null-safe join would move them again."""
    return F.struct("user_id").alias("finder")


def is_same_user() -> Column:
    return F.struct("user_id") == F.col("finder")


def found_by_user(pairs: DataFrame, lookup: DataFrame) -> DataFrame:
    """(finder, found): the distinct products of each user with their lookup rows.

    ``pairs`` is (user_id, product_id); ``found`` an array of (product_id, rows), ``rows``
    an array of the lookup's other columns, null for a product that is not there.
    """
    columns = [name for name in lookup.columns if name != "product_id"]
    rows = lookup.groupBy("product_id").agg(F.collect_list(F.struct(*columns)).alias("rows"))
    distinct = pairs.repartition("product_id").distinct()
    return (
        distinct.join(rows, "product_id", "left")
        .groupBy(finder())
        .agg(F.collect_list(F.struct("product_id", "rows")).alias("found"))
    )
