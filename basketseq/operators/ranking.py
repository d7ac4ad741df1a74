"""A total ranking that does not pass through one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketseq.sources.shared import materialise


def rank_in_ranges(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``row_number`` over a total order, computed range by range.

    Rows are range-partitioned by the order, and each range is ranked on its
    own and shifted by the number of rows in the ranges before it. The ranged
    rows are written out first: both uses must see the same ranges. Only one
    (range, row count) pair per partition meets the unpartitioned window and
    the broadcast.
    """
    ranged = materialise(
        df.repartitionByRange(*order).withColumn("range_id", F.spark_partition_id()),
        "ranges",
    )
    before = Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("range_id")
        .count()
        .select("range_id", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("range_id").orderBy(*order)
    return (
        ranged.withColumn("rank_in_range", F.row_number().over(within))
        .join(F.broadcast(offsets), "range_id")
        .withColumn(name, F.col("offset") + F.col("rank_in_range"))
        .drop("range_id", "rank_in_range", "offset")
    )
