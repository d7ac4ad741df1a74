"""Item rows -> ordered baskets -> one purchase sequence per user.

Two stages on purpose: the first groups by order, so a very active user's item
rows spread over many tasks, and only finished baskets travel to the user
stage. After an order_id join the first stage needs no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketseq import schemas
from basketseq.functions.sequences import encode_flat, encode_nested

# basket column <- item column
_BASKET = {
    "products": "product_id",
    "reorders": "reordered",
    "departments": "department_id",
    "aisles": "aisle_id",
}
# user column <- order column
_NESTED = {
    "product_ids": "products",
    "reorders": "reorders",
    "department_ids": "departments",
    "aisle_ids": "aisles",
}
_FLAT = {
    "order_ids": "order_id",
    "order_numbers": "order_number",
    "order_dows": "order_dow",
    "order_hours": "order_hour",
    "days_since_prior_orders": "days_since_prior_order",
}


def order_baskets(items: DataFrame) -> DataFrame:
    """One row per (user, order) with four parallel arrays of the items' values.

    Items are ordered by cart position; equal positions by the text of the
    product id, then of the other values.
    """
    line = F.struct(
        "add_to_cart_order",
        *[F.col(source).cast("string").alias(name) for name, source in _BASKET.items()],
    )

    def values(name: str, source: str):
        item_type = items.schema[source].dataType.simpleString()
        # A missing value leaves no element, as in the stored text.
        return F.array_compact(F.col("lines")[name]).cast(f"array<{item_type}>").alias(name)

    # Order metadata is constant within an order; min keeps reruns deterministic.
    return (
        items.groupBy("user_id", "order_id")
        .agg(
            F.sort_array(F.collect_list(line)).alias("lines"),
            F.min("order_number").alias("order_number"),
            F.min("order_dow").alias("order_dow"),
            F.min("order_hour_of_day").alias("order_hour"),
            F.min("days_since_prior_order").alias("days_since_prior_order"),
            F.min("eval_set").alias("eval_set"),
        )
        .select(
            "user_id",
            "order_id",
            "order_number",
            "order_dow",
            "order_hour",
            "days_since_prior_order",
            "eval_set",
            *[values(name, source) for name, source in _BASKET.items()],
        )
    )


def basket_text(baskets: DataFrame) -> DataFrame:
    """The stored form of the baskets: tokens joined by ``_``."""
    return baskets.withColumns(
        {name: F.array_join(F.col(name).cast("array<string>"), "_") for name in _BASKET}
    )


def declared_targets(baskets: DataFrame, orders: DataFrame) -> DataFrame:
    """``baskets`` plus an empty one for each tagged order without items.

    The target of a user is then the order that the split declares, and all orders
    with items are history, instead of the last of them being the target.
    """
    tagged = orders.where(F.col("eval_set").isin("train", "test"))
    filled = tagged.join(baskets.select("order_id"), "order_id", "left_anti")
    columns = {
        "order_hour": F.col("order_hour_of_day"),
        "days_since_prior_order": F.coalesce("days_since_prior_order", F.lit(-1)),
        **{name: F.array() for name in _BASKET},
    }
    return baskets.unionByName(
        filled.withColumns(columns).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in baskets.schema]
        )
    )


def user_orders(baskets: DataFrame) -> DataFrame:
    """One row per user: the orders as array of structs, oldest first.

    Orders with the same number follow each other by the text of their id.
    """
    order = F.struct(
        F.col("order_number").try_cast("bigint").alias("sort_number"),
        F.col("order_id").cast("string").alias("order_id"),
        "order_number",
        "order_dow",
        "order_hour",
        "days_since_prior_order",
        "eval_set",
        *_BASKET,
    )
    return baskets.groupBy("user_id").agg(F.sort_array(F.collect_list(order)).alias("orders"))


def user_sequences(baskets: DataFrame) -> DataFrame:
    """Typed sequences per user: flat arrays and arrays of arrays.

    ``eval_set`` is the split of the last order that has items.
    """
    orders = F.col("orders")
    sequences = {name: orders[field] for name, field in {**_FLAT, **_NESTED}.items()}
    last_split = F.try_element_at(orders["eval_set"], F.lit(-1))
    return (
        user_orders(baskets)
        .withColumns({**sequences, "eval_set": last_split})
        .select(schemas.USER_SEQUENCES)
    )


def sequence_text(sequences: DataFrame) -> DataFrame:
    """The stored form of ``user_sequences``: ten text columns."""
    return sequences.withColumns(
        {
            **{name: encode_flat(F.col(name)) for name in _FLAT},
            **{name: encode_nested(F.col(name)) for name in _NESTED},
        }
    )
