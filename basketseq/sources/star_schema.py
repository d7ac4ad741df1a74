"""The order model derived from the star-schema test tables.

orders, lineitem and part become orders, order_products (prior and train) and
products. Keys are shifted by one because product 0 means "None". Ids stay
bigint: order keys outgrow 32 bits at large scale factors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketseq.sources.files import SourceTables, child, read_parquet
from basketseq.sources.shared import materialise


def orders_model(spark: SparkSession, folder) -> DataFrame:
    """One row per order; a user's last order is the target (train or test)."""
    raw = read_parquet(spark, child(folder, "orders.parquet")).select(
        (F.col("o_orderkey") + 1).alias("order_id"),
        (F.col("o_custkey") + 1).alias("user_id"),
        F.to_date("o_orderdate").alias("day"),
    )
    by_user = Window.partitionBy("user_id").orderBy("day", "order_id")
    is_last = F.lead("order_id").over(by_user).isNull()
    return raw.select(
        "order_id",
        "user_id",
        F.when(~is_last, "prior")
        .when(F.col("user_id") % 3 == 0, "test")
        .otherwise("train")
        .alias("eval_set"),
        F.row_number().over(by_user).alias("order_number"),
        (F.dayofweek("day") - 1).alias("order_dow"),
        ((F.col("order_id") - 1) % 24).cast("int").alias("order_hour_of_day"),
        F.date_diff("day", F.lag("day").over(by_user))
        .cast("double")
        .alias("days_since_prior_order"),
    )


def products_model(spark: SparkSession, folder) -> DataFrame:
    aisle = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    return read_parquet(spark, child(folder, "part.parquet")).select(
        (F.col("p_partkey") + 1).alias("product_id"),
        F.col("p_name").alias("product_name"),
        aisle.alias("aisle_id"),
        (F.floor((aisle - 1) / 5) + 1).cast("int").alias("department_id"),
    )


def items_model(spark: SparkSession, folder, orders: DataFrame) -> DataFrame:
    """Order lines with the reordered flag and the split of their order."""
    lines = read_parquet(spark, child(folder, "lineitem.parquet")).select(
        (F.col("l_orderkey") + 1).alias("order_id"),
        (F.col("l_partkey") + 1).alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
    )
    tagged = lines.join(orders.select("order_id", "user_id", "eval_set", "order_number"), "order_id")
    first_bought = F.min("order_number").over(Window.partitionBy("user_id", "product_id"))
    return tagged.select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        (first_bought < F.col("order_number")).cast("int").alias("reordered"),
        "eval_set",
    )


def star_schema_tables(
    spark: SparkSession, folder, test_items: bool = False
) -> SourceTables:
    """Items of test orders are left out, as in a two-file source, unless
    ``test_items`` adds them to the prior ones."""
    orders = orders_model(spark, folder)
    items = items_model(spark, folder, orders)
    return _split_tables(orders, products_model(spark, folder), items, test_items)


def stored_tables(spark: SparkSession, folder, test_items: bool = False) -> SourceTables:
    """``star_schema_tables`` with orders and items written to the shared folder, for
    several jobs on them: the join and the windows then run once."""
    orders = materialise(orders_model(spark, folder), "orders")
    items = materialise(items_model(spark, folder, orders), "items")
    return _split_tables(orders, products_model(spark, folder), items, test_items)


def _split_tables(
    orders: DataFrame, products: DataFrame, items: DataFrame, test_items: bool
) -> SourceTables:
    columns = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    return SourceTables(
        orders=orders,
        products=products,
        prior=items.where(
            F.col("eval_set").isin("prior", "test") if test_items else F.col("eval_set") == "prior"
        ).select(columns),
        train=items.where(F.col("eval_set") == "train").select(columns),
    )


def aisles_model(products: DataFrame) -> DataFrame:
    return products.select(
        "aisle_id", F.concat(F.lit("aisle "), F.col("aisle_id").cast("string")).alias("aisle")
    ).distinct()


def departments_model(products: DataFrame) -> DataFrame:
    return products.select(
        "department_id",
        F.concat(F.lit("department "), F.col("department_id").cast("string")).alias("department"),
    ).distinct()


def products_with_mixed_aisles(spark: SparkSession, folder) -> DataFrame:
    """Products whose department follows the part type, so that one aisle
    belongs to several departments."""
    department = (F.ascii("p_type") % 5 + 1).alias("department_id")
    return (
        read_parquet(spark, child(folder, "part.parquet"))
        .select((F.col("p_partkey") + 1).alias("product_id"), department)
        .join(products_model(spark, folder).drop("department_id"), "product_id")
    )
