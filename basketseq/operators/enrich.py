"""Item-level enrichment: union of the item tables, order and product joins.

No join carries a hint. Catalyst broadcasts a lookup only when its scan is
below ``spark.sql.autoBroadcastJoinThreshold``; beyond that it sort-merges and
AQE splits a hot order or product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from basketseq.functions.cleaning import fill_gaps
from basketseq.sources.files import SourceTables
from basketseq.sources.staged import write_checked

NULLABLE = ["days_since_prior_order"]


def all_items(prior: DataFrame, train: DataFrame) -> DataFrame:
    return prior.unionByName(train)


def with_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Inner join: orders without items and items without order disappear."""
    return items.join(orders, "order_id")


def with_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Inner join: items of unknown products disappear."""
    return items.join(products, "product_id")


def joined_items(tables: SourceTables) -> DataFrame:
    return _with_both(all_items(tables.prior, tables.train), tables)


def _with_both(items: DataFrame, tables: SourceTables) -> DataFrame:
    """Products first: narrower rows then move for a large product table, and the rows
    end up placed by order, so that grouping them into orders moves nothing more."""
    joined = with_orders(with_products(items, tables.products), tables.orders)
    columns = with_products(with_orders(items, tables.orders), tables.products).columns
    return joined.select(columns)


def enriched_items(tables: SourceTables) -> DataFrame:
    """The order_products table: one row per order line, gaps filled with -1."""
    return fill_gaps(joined_items(tables), NULLABLE)


def join_counts(joined: DataFrame, items: DataFrame) -> DataFrame:
    """(joined_count, raw_count) in one job."""
    tagged = joined.select(F.lit(True).alias("is_joined")).unionAll(
        items.select(F.lit(False).alias("is_joined"))
    )
    return tagged.agg(
        F.count_if("is_joined").alias("joined_count"),
        F.count_if(~F.col("is_joined")).alias("raw_count"),
    )


def check_join_counts(joined: DataFrame, items: DataFrame) -> None:
    """Raise when the joins dropped or multiplied item rows."""
    counts = join_counts(joined, items).first()
    _compare(counts["joined_count"], counts["raw_count"])


def _compare(joined_count: int, raw_count: int) -> None:
    if joined_count != raw_count:
        raise ValueError(
            f"Joined row count mismatch: {raw_count} items went into the joins, "
            f"{joined_count} rows came out"
        )


def write_enriched_items(tables: SourceTables, path) -> dict[str, int]:
    """Write ``enriched_items`` and check the joins in the same run; both counts.

    Items are counted where they enter the joins and where they leave them, while the
    rows are written. If the counts differ this raises, and readers of ``path`` never
    see the rows.
    """
    into, out = Observation("items"), Observation("joined")
    count = F.count(F.lit(1)).alias("n")
    items = all_items(tables.prior, tables.train)
    joined = _with_both(items.observe(into, count), tables).observe(out, count)

    def check() -> dict[str, int]:
        joined_count = out.get["n"]
        # Where the other side of a join is empty, Spark doesn't read the items at all.
        raw_count = into.get["n"] if joined_count else items.count()
        _compare(joined_count, raw_count)
        return {"joined_count": joined_count, "raw_count": raw_count}

    return write_checked(fill_gaps(joined, NULLABLE), path, check)


def row_counts(**frames: DataFrame) -> DataFrame:
    """(dataset, row_count) of several frames in one job; only partial counts move."""
    counts = None
    for name, frame in frames.items():
        one = frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("dataset"), "row_count"
        )
        counts = one if counts is None else counts.unionAll(one)
    return counts
