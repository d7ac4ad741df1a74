"""How the rows of a DataFrame are laid out over partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def partition_distribution(df: DataFrame) -> DataFrame:
    """(partition_id, row_count) of the partitions that hold rows."""
    return (
        df.groupBy(F.spark_partition_id().alias("partition_id"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("partition_id")
    )


def partition_summary(df: DataFrame) -> DataFrame:
    """(n_partitions, n_rows, max_rows, min_rows), empty partitions included.

    Rows are counted inside the JVM; only the number of partitions comes from
    the physical plan. Asking for it runs the stages below the last shuffle, and the
    counts run with adaptive merging out of the way, so both see one layout.
    """
    n_partitions = df.rdd.getNumPartitions()
    filled = F.count(F.lit(1))
    return partition_distribution(df).agg(
        F.lit(n_partitions).alias("n_partitions"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.max("row_count"), F.lit(0)).alias("max_rows"),
        F.when(filled < n_partitions, 0).otherwise(F.min("row_count")).alias("min_rows"),
    )
