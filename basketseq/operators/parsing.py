"""Parsed views of stored user sequences, history and target apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketseq.functions.sequences import before_last, nested_column


def parse_orders(
    df: DataFrame,
    column: str,
    prefix: str,
    with_sets: bool = False,
    item_type: str = "int",
) -> DataFrame:
    """Adds ``{p}_raw``, ``{p}_prev``, ``{p}_all``, ``next_{p}``, ``next_{p}_int``.

    raw and prev are order texts, all and next_int their ids. ``with_sets``
    adds the distinct ids of the history and of the target in first-seen order.
    """
    texts = F.split(column, " ")
    ids = nested_column(df, column, item_type)
    parsed = df.withColumns(
        {
            f"{prefix}_raw": texts,
            f"{prefix}_prev": before_last(texts),
            f"next_{prefix}": F.try_element_at(texts, F.lit(-1)),
            f"{prefix}_all": before_last(ids),
            f"next_{prefix}_int": F.try_element_at(ids, F.lit(-1)),
        }
    )
    if not with_sets:
        return parsed
    return parsed.withColumns(
        {
            f"{prefix}_set": F.array_distinct(F.flatten(f"{prefix}_all")),
            f"next_{prefix}_set": F.array_distinct(f"next_{prefix}_int"),
        }
    )


def parse_aisles(df: DataFrame, item_type: str = "int") -> DataFrame:
    """The same for ``aisle_ids``, under the aisle tables' column names."""
    return (
        parse_orders(df, "aisle_ids", "aisle", with_sets=True, item_type=item_type)
        .withColumnRenamed("next_aisle", "aisle_next")
        .drop("next_aisle_int")
    )
