import pytest

from basketseq.operators import baskets, enrich
from basketseq.sources.files import SourceTables
from tests.brute import random_source
from tests.frames import source_tables


def test_inner_joins_drop_unmatched_and_fill_gaps(spark, rows):
    source = {
        "orders": [(1, 10, "prior", 1, 0, 9, None), (2, 10, "train", 2, 3, 8, 6.0), (3, 11, "test", 1, 1, 1, None)],
        "products": [(5, "tea", 2, 1)],
        "prior": [(1, 5, 1, 0), (1, 6, 2, 0), (9, 5, 1, 0)],
        "train": [(2, 5, 1, 1)],
    }
    got = rows(enrich.enriched_items(source_tables(spark, source)))
    assert [(r["order_id"], r["product_id"], r["days_since_prior_order"]) for r in got] == [
        (1, 5, -1),
        (2, 5, 6),
    ]
    assert set(got[0]) == {
        "order_id", "product_id", "add_to_cart_order", "reordered", "user_id", "eval_set",
        "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order",
        "product_name", "aisle_id", "department_id",
    }


def test_union_is_by_name_and_keeps_duplicates(spark):
    prior = spark.createDataFrame([(1, 2)], "order_id int, product_id int")
    train = spark.createDataFrame([(2, 1)], "product_id int, order_id int")
    assert [tuple(r) for r in enrich.all_items(prior, train).collect()] == [(1, 2), (1, 2)]


def test_join_count_check(spark):
    tables = source_tables(spark, random_source(3))
    items = enrich.all_items(tables.prior, tables.train)
    enrich.check_join_counts(enrich.joined_items(tables), items)
    n = items.count()
    fewer = SourceTables(tables.orders, tables.products.where("product_id <> 1"), tables.prior, tables.train)
    left = enrich.joined_items(fewer).count()
    assert left < n
    with pytest.raises(ValueError, match=f"Joined row count mismatch: {n} items .* {left} rows"):
        enrich.check_join_counts(enrich.joined_items(fewer), items)


def test_row_counts(spark, rows):
    assert rows(enrich.row_counts(a=spark.range(4), b=spark.range(0))) == [
        {"dataset": "a", "row_count": 4},
        {"dataset": "b", "row_count": 0},
    ]


def test_joined_items_lie_by_order(spark, rows):
    """Also where products are too many to broadcast: grouping them moves nothing."""
    tables = source_tables(spark, random_source(3))
    usual = rows(enrich.joined_items(tables))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        grouped = baskets.order_baskets(enrich.enriched_items(tables))
        plan = grouped._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "hashpartitioning(order_id" in plan
        assert "hashpartitioning(user_id" not in plan
        assert rows(enrich.joined_items(tables)) == usual
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
