"""Running sums over a total order that no single task walks through."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketseq.llm.scratch import Scratch


def sums_before(
    df: DataFrame,
    within: str | None,
    order: Sequence[Column],
    sums: dict[str, str],
    scratch: Scratch,
) -> DataFrame:
    """``df`` plus, for each ``name: column`` of ``sums``, the column's sum over the
    rows before this one in ``order``, among the rows with the same ``within``.

    Rows are range-partitioned by (within, order) and written, so that a large
    ``within`` group lies in many ranges. Each range is summed on its own and
    shifted by the totals of the ranges before it: one row per range and group
    is all that meets a window over ranges. ``order`` should tell all rows apart
    but those that equal each other in every column.
    """
    group = [] if within is None else [F.col(within).asc_nulls_first()]
    ranged, _ = scratch.write(
        df.repartitionByRange(*group, *order).withColumn("range_id", F.spark_partition_id()),
        "ranges",
    )
    key = F.lit(0) if within is None else F.col(within)
    before = Window.partitionBy("group_key").orderBy("range_at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = ranged.groupBy(F.col("range_id").alias("range_at"), key.alias("group_key")).agg(
        *(F.sum(column).alias(f"total_{name}") for name, column in sums.items())
    )
    shifts = totals.select(
        "range_at",
        "group_key",
        *(
            F.coalesce(F.sum(f"total_{name}").over(before), F.lit(0)).alias(f"shift_{name}")
            for name in sums
        ),
    )
    here = Window.partitionBy("range_id", key).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    local = ranged.select(
        "*",
        *(
            F.coalesce(F.sum(column).over(here), F.lit(0)).alias(f"local_{name}")
            for name, column in sums.items()
        ),
    )
    joined = local.join(
        shifts, (F.col("range_id") == F.col("range_at")) & key.eqNullSafe(F.col("group_key"))
    )
    return joined.select(
        *df.columns,
        *(
            (F.col(f"local_{name}") + F.col(f"shift_{name}")).alias(name)
            for name in sums
        ),
    )
