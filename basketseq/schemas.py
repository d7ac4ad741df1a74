"""Data contracts of the source tables and column layouts of the outputs.

Fixed values: the column names, their order and their types are what
downstream readers expect, so they are spelled out literally.
"""

from __future__ import annotations

import re

ORDERS = (
    "order_id INT, user_id INT, eval_set STRING, order_number TINYINT, "
    "order_dow TINYINT, order_hour_of_day TINYINT, days_since_prior_order DOUBLE"
)
ORDER_PRODUCTS = (
    "order_id INT, product_id INT, add_to_cart_order SMALLINT, reordered TINYINT"
)
PRODUCTS = (
    "product_id INT, product_name STRING, aisle_id SMALLINT, department_id TINYINT"
)
AISLES = "aisle_id INT, aisle STRING"
DEPARTMENTS = "department_id INT, department STRING"

SOURCE_TABLES = {
    "orders": ORDERS,
    "products": PRODUCTS,
    "order_products__prior": ORDER_PRODUCTS,
    "order_products__train": ORDER_PRODUCTS,
    "aisles": AISLES,
    "departments": DEPARTMENTS,
}
# The same tables for data that outgrows the narrow types.
WIDE_SOURCE_TABLES = {
    table: re.sub(r"\b(INT|SMALLINT|TINYINT)\b", "BIGINT", schema)
    for table, schema in SOURCE_TABLES.items()
}
ITEM_TABLES = ("order_products__prior", "order_products__train")
LOOKUP_TABLES = ("aisles", "departments", "products")

# One entry per order of a user, target order included.
TEMPORAL = ["order_dows", "order_hours", "days_since_prior_orders", "order_numbers"]

USER_SEQUENCES = [
    "user_id",
    "order_ids",
    "order_numbers",
    "order_dows",
    "order_hours",
    "days_since_prior_orders",
    "product_ids",
    "reorders",
    "department_ids",
    "aisle_ids",
    "eval_set",
]
PRODUCT_HISTORY = [
    "user_id",
    "product_id",
    "label",
    "aisle_id",
    "department_id",
    "product_name",
    "eval_set",
    "is_ordered_history",
    "position_in_order_history",
    "history_order_size",
    "history_reorder_size",
    *TEMPORAL,
]
AISLE_HISTORY = [
    "user_id",
    "aisle_id",
    "department_id",
    "eval_set",
    "is_ordered_history",
    "position_in_order",
    "num_products_from_aisle",
    "aisle_history_size",
    *TEMPORAL,
]
PRODUCT_TRAINING = [
    "user_id",
    "product_id",
    "eval_set",
    "label",
    "product_name_encoded",
    "is_ordered_history",
    "position_in_order_history",
    "history_order_size",
    "history_reorder_size",
    *TEMPORAL,
    "history_length",
    "product_name_length",
]
REORDER_SIZE_TRAINING = [
    "user_id",
    "eval_set",
    "order_sizes",
    "reorder_sizes",
    "label",
    *TEMPORAL,
    "history_length",
]
