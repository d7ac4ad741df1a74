"""A referentially closed sample of whole users."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketseq import schemas
from basketseq.sources.files import child, write_csv
from basketseq.sources.shared import materialise

# Hexadecimal digits of a draw, and how many of them one round of counts tells apart.
DRAW_DIGITS = 32
PREFIX_DIGITS = 3
# Users with a common prefix that are sorted to find the cut among them.
FEW_USERS = 100_000


def read_raw(spark: SparkSession, path) -> DataFrame:
    """CSV cells as they are, all text."""
    return spark.read.csv(str(path), header=True)


def check_inputs(spark: SparkSession, raw_dir, sample_n: int) -> None:
    """Raise when a source table is missing or has too few users."""
    missing = []
    for table in schemas.SOURCE_TABLES:
        try:
            spark.read.text(child(raw_dir, f"{table}.csv"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(table)
    if missing:
        raise FileNotFoundError(
            f"Missing required input files in {raw_dir} (as <table>.csv): {' '.join(sorted(missing))}"
        )
    check_user_count(read_raw(spark, child(raw_dir, "orders.csv")), sample_n)


def user_count(orders: DataFrame) -> DataFrame:
    """(n_users), counted without collecting the users."""
    return orders.select("user_id").distinct().agg(F.count("user_id").alias("n_users"))


def check_user_count(orders: DataFrame, sample_n: int) -> None:
    available = user_count(orders).first()["n_users"]
    if sample_n > available:
        raise ValueError(
            f"sample_n={sample_n} is greater than number of unique users ({available} have orders)"
        )


def sample_users(orders: DataFrame, sample_n: int, seed: int) -> DataFrame:
    """Exactly ``sample_n`` distinct users (all, if fewer), the same ones for the same seed.

    Users are drawn in the order of a seeded hash of their id, so the draw depends
    neither on row order nor on partitioning. No user is sorted but those next to the
    cut: users are counted by the first digits of their draw, which leaves one prefix
    that the cut falls into, and so on within it until few users share the prefix. Those
    before it are taken by comparison, the rest from within it. The distinct users are
    written once, since all counts must see the same ones.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("user_id").cast("string")))
    users = materialise(
        orders.select("user_id").distinct().withColumn("draw", draw), "drawn-users"
    )
    prefix, missing = _cut(users, sample_n)
    if prefix is None:
        return users.select("user_id")
    before = users.where(F.col("draw") < prefix).select("user_id")
    within = users.where(F.col("draw").startswith(prefix))
    last = within.orderBy("draw", "user_id").limit(missing).select("user_id")
    return before.unionByName(last)


def _cut(users: DataFrame, sample_n: int) -> tuple[str | None, int]:
    """The prefix of draws that the cut falls into, and how many of its users are
    taken; no prefix where all users are. Each round collects ``16 ** PREFIX_DIGITS``
    counts at most."""
    prefix, missing = "", sample_n
    while len(prefix) < DRAW_DIGITS:
        digits = len(prefix) + PREFIX_DIGITS
        counts = (
            users.where(F.col("draw").startswith(prefix))
            .groupBy(F.substring("draw", 1, digits).alias("prefix"))
            .count()
            .collect()
        )
        for found, count in sorted(tuple(row) for row in counts):
            if count >= missing:
                break
            missing -= count
        else:
            return None, 0
        prefix = found
        if count <= FEW_USERS:
            break
    return prefix, missing


def orders_of_users(orders: DataFrame, users: DataFrame) -> DataFrame:
    return orders.join(users, "user_id", "left_semi").select(orders.columns)


def items_of_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    return items.join(orders, "order_id", "left_semi").select(items.columns)


def sample_dataset(
    spark: SparkSession, raw_dir, sample_dir, sample_n: int = 5, seed: int = 42
) -> None:
    """Write the orders and items of ``sample_n`` users; lookups unchanged."""
    check_inputs(spark, raw_dir, sample_n)

    def raw(table: str) -> DataFrame:
        return read_raw(spark, child(raw_dir, f"{table}.csv"))

    def write(df: DataFrame, table: str) -> None:
        write_csv(df, child(sample_dir, f"{table}.csv"))

    write(orders_of_users(raw("orders"), sample_users(raw("orders"), sample_n, seed)), "orders")
    sampled = read_raw(spark, child(sample_dir, "orders.csv"))
    for table in schemas.ITEM_TABLES:
        write(items_of_orders(raw(table), sampled), table)
    for table in schemas.LOOKUP_TABLES:
        write(raw(table), table)
