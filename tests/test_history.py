import time

import pytest
from pyspark.sql import functions as F

from basketseq import schemas
from basketseq.functions.sequences import flat_column
from basketseq.operators import baskets, enrich, history
from basketseq.sources.files import split_tags
from tests import brute
from tests.frames import source_tables

USER = (
    "user_id bigint, product_ids string, reorders string, aisle_ids string, eval_set string, "
    "order_dows string, order_hours string, days_since_prior_orders string, order_numbers string"
)


def typed_users(spark, tables):
    return baskets.user_sequences(baskets.order_baskets(enrich.enriched_items(tables)))


@pytest.fixture(params=["text", "arrays"])
def users_form(request):
    return baskets.sequence_text if request.param == "text" else lambda users: users


@pytest.mark.parametrize("seed", range(3))
def test_product_history_matches_brute_force(spark, rows, seed, users_form):
    source = brute.random_source(seed, n_users=20)
    tables = source_tables(spark, source)
    users = users_form(typed_users(spark, tables))
    got = history.product_history_with_none(users, split_tags(tables.orders), tables.products)
    assert got.columns == schemas.PRODUCT_HISTORY
    expected = brute.product_rows(source) + brute.none_rows(source)
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_aisle_history_matches_brute_force(spark, rows, seed, users_form):
    source = brute.random_source(seed, n_users=20)
    tables = source_tables(spark, source)
    # Every aisle in two departments: rows fan out.
    mixed = tables.products.select("aisle_id", F.explode(F.array(F.lit(1), F.lit(8))).alias("department_id"))
    got = history.aisle_history(users_form(typed_users(spark, tables)), mixed)
    assert got.columns == schemas.AISLE_HISTORY
    expected = brute.aisle_rows(source, {a: {1, 8} for a in (3, 5, 11)})
    assert rows(got) == sorted(expected, key=repr)


def test_large_users_take_the_spread_path_with_equal_rows(spark, rows, monkeypatch):
    source = brute.random_source(11, n_users=20)
    tables = source_tables(spark, source)
    users = typed_users(spark, tables)
    tags = split_tags(tables.orders)
    usual = rows(history.product_history(users, tags, tables.products))
    aisles = rows(history.aisle_history(users, tables.products))
    monkeypatch.setattr(history, "CELLS_PER_CHUNK", 6)
    for some_users in (users, baskets.sequence_text(users)):
        spread = history.product_history(some_users, tags, tables.products, large_user_items=3)
        assert rows(spread) == usual
        spread = history.aisle_history(some_users, tables.products, large_user_items=3)
        assert rows(spread) == aisles


def test_a_user_of_many_orders_ends_in_time(spark):
    """80,000 orders with a new product each: linear, so seconds."""
    users = spark.range(1).select(
        F.expr("transform(sequence(1, 80000), i -> array(i, 1))").alias("past"),
        F.expr("sequence(1, 80000)").alias("first_orders"),
    )
    start = time.monotonic()
    overlaps = users.select(history.order_overlaps("past", "first_orders").alias("n")).first()["n"]
    assert time.monotonic() - start < 20
    assert overlaps == [0, *[1] * 79_999]


def test_a_user_of_many_items_ends_in_time(spark):
    """24,000 items over 60 products: every row is there, within a minute."""
    users = spark.range(1).select(
        F.lit(1).cast("long").alias("user_id"),
        F.expr("transform(sequence(1, 8000), i -> array(i % 60, (i * 7) % 60, (i * 11) % 60))").alias("product_ids"),
        F.lit("train").alias("eval_set"),
        *[F.array(F.lit(1)).alias(name) for name in schemas.TEMPORAL],
    )
    tags = spark.createDataFrame([(1, "train")], "user_id bigint, target_eval_set string")
    products = spark.createDataFrame([], schemas.PRODUCTS)
    start = time.monotonic()
    got = history.product_history(users, tags, products, as_text=False)
    sizes = got.select(F.size("position_in_order_history"), "history_reorder_size").collect()
    assert time.monotonic() - start < 60
    assert len(sizes) == 60 and {r[0] for r in sizes} == {7999}


@pytest.mark.parametrize("bad", ["x", ""])
def test_overlaps_start_at_zero_beside_a_token_that_is_no_number(spark, rows, bad):
    users = spark.createDataFrame(
        [(1, f"{bad}_5 5_6 5 7", "0_0 1_0 1 0", "1_1 1_1 1 1", "train", "0 1 2 3", "5 6 7 8", "-1 3 4 5", "1 2 3 4")],
        USER,
    )
    tags = spark.createDataFrame([(1, "train")], "user_id bigint, target_eval_set string")
    products = spark.createDataFrame([], schemas.PRODUCTS)
    for bound in (history.LARGE_USER_ITEMS, 0):
        got = rows(history.product_history(users, tags, products, large_user_items=bound))
        assert {r["history_reorder_size"] for r in got} == {"0 1 1"}


def test_ids_beyond_32_bits_fail_or_make_pairs(spark, rows):
    users = spark.createDataFrame(
        [(1, "3000000000_5 5_6 5 7", "0_0 1_0 1 0", "1_1 1_1 1 1", "train", "0 1 2 3", "5 6 7 8", "-1 3 4 5", "1 2 3 4")],
        USER,
    )
    tags = spark.createDataFrame([(1, "train")], "user_id bigint, target_eval_set string")
    products = spark.createDataFrame([], schemas.PRODUCTS)
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        history.product_history(users, tags, products).collect()
    wide = rows(history.product_history(users, tags, products, item_type="bigint"))
    assert {r["product_id"] for r in wide} == {3000000000, 5, 6}


def test_declared_targets(spark, rows):
    source = brute.random_source(7, n_users=30)
    tables = source_tables(spark, source)
    filled = baskets.order_baskets(enrich.enriched_items(tables))
    users = baskets.user_sequences(baskets.declared_targets(filled, tables.orders))
    got = {r["user_id"]: r for r in rows(users)}
    with_items = {r[0] for r in source["prior"] + source["train"]}
    missing = [o for o in source["orders"] if o[2] != "prior" and o[0] not in with_items]
    assert missing
    for order_id, user, split, *_ in missing:
        assert got[user]["eval_set"] == split
        assert got[user]["order_ids"][-1] == str(order_id) and got[user]["product_ids"][-1] == []
    tags = split_tags(tables.orders)
    labels = {r["user_id"]: r["label"] for r in rows(history.none_history(users, tags))}
    for _, user, split, *_ in missing:
        assert labels[user] == (1 if split == "train" else -1)


def test_mixed_aisles(spark, rows):
    products = spark.createDataFrame([(1, "a", 3, 1), (2, "b", 3, 2), (3, "c", 4, 1)], schemas.PRODUCTS)
    assert rows(history.mixed_aisles(products)) == [{"aisle_id": 3, "n_departments": 2}]
    with pytest.raises(ValueError, match="1 aisles lie in several departments, the first is 3"):
        history.check_aisles(products)
    history.check_aisles(products.where("product_id <> 2"))


def test_arrays_and_text_hold_the_same(spark, rows):
    source = brute.random_source(5)
    tables = source_tables(spark, source)
    users, tags = typed_users(spark, tables), split_tags(tables.orders)
    as_text = history.product_history_with_none(users, tags, tables.products)
    arrays = history.product_history_with_none(users, tags, tables.products, as_text=False)
    sequences = [c for c, t in arrays.dtypes if t.startswith("array")]
    assert len(sequences) == 8
    parsed = as_text.withColumns({c: flat_column(as_text, c) for c in sequences})
    assert rows(parsed) == rows(arrays)


def test_user_without_tag_or_history(spark, rows):
    users = spark.createDataFrame(
        [
            (1, "4_4_2 2_4", "0_0_0 1_1", "7_7_1 1_7", "prior", "0 1", "5 6", "-1 3", "1 2"),
            (2, "8", "0", "3", "train", "0", "5", "-1", "1"),
            (3, None, None, None, None, None, None, None, None),
        ],
        USER,
    )
    tags = spark.createDataFrame([(2, "train")], "user_id bigint, target_eval_set string")
    products = spark.createDataFrame([(4, "four", 7, 1)], schemas.PRODUCTS)
    got = rows(history.product_history(users, tags, products))
    picked = [
        (r["user_id"], r["product_id"], r["label"], r["product_name"], r["position_in_order_history"])
        for r in got
    ]
    # One-order and unknown users have no pair; an unknown product keeps nulls.
    assert sorted(picked, key=repr) == [(1, 2, -1, None, "3"), (1, 4, -1, "four", "1")]
    assert {r["history_order_size"] for r in got} == {"3"}

    none = {r["user_id"]: r for r in rows(history.none_history(users, tags))}
    assert (none[1]["label"], none[1]["is_ordered_history"]) == (-1, "1")
    assert (none[2]["label"], none[2]["is_ordered_history"], none[2]["history_order_size"]) == (1, "", "")
    assert none[3]["label"] == -1 and none[3]["is_ordered_history"] is None

    aisles = rows(history.aisle_history(users, products))
    assert [(r["aisle_id"], r["position_in_order"], r["num_products_from_aisle"]) for r in aisles] == [
        (1, "2", "1"),
        (7, "1", "2"),
    ]


def test_a_token_that_is_no_number_makes_no_pair(spark, rows):
    users = spark.createDataFrame(
        [(1, "4_x_9 9", "0_0_0 1", "7_x_1 1", "train", "0 1", "5 6", "-1 3", "1 2")], USER
    )
    tags = spark.createDataFrame([(1, "train")], "user_id bigint, target_eval_set string")
    products = spark.createDataFrame([], schemas.PRODUCTS)
    got = rows(history.product_history(users, tags, products))
    assert [(r["product_id"], r["label"], r["position_in_order_history"], r["history_order_size"]) for r in got] == [
        (4, 0, "1", "3"),
        (9, 1, "3", "3"),
    ]


def test_overlap_counts_differ_from_flag_sums(spark, rows):
    """Product rows count products seen earlier, "None" rows add up flags."""
    users = spark.createDataFrame(
        [(1, "1_2 2_2_1 3", "0_0 1_0_0 1", "1_1 1_1_1 1", "train", "0 1 2", "5 6 7", "-1 3 4", "1 2 3")], USER
    )
    tags = spark.createDataFrame([(1, "train")], "user_id bigint, target_eval_set string")
    products = spark.createDataFrame([], schemas.PRODUCTS)
    pairs = rows(history.product_history(users, tags, products))
    assert {r["history_reorder_size"] for r in pairs} == {"0 2"}
    assert rows(history.none_history(users, tags))[0]["history_reorder_size"] == "0 1"


def test_aisles_of_a_large_product_table_are_broadcast(spark, tmp_path):
    """By their real size, so that no pairs move for them."""
    products = spark.range(20_000).selectExpr(
        "int(id) AS product_id", "md5(string(id)) AS product_name",
        "int(id % 5) AS aisle_id", "int(id % 5) AS department_id",
    )
    products.write.parquet(f"{tmp_path}/products")
    users = spark.createDataFrame(
        [(1, "train", "1 2", "1 2", "1 2", "1 2", "1_2 3")],
        "user_id int, eval_set string, order_dows string, order_hours string, "
        "days_since_prior_orders string, order_numbers string, aisle_ids string",
    )
    users.write.parquet(f"{tmp_path}/users")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        pairs = history.aisle_history(
            spark.read.parquet(f"{tmp_path}/users").unionAll(users),
            spark.read.parquet(f"{tmp_path}/products"),
        )
        plan = pairs._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert sorted((r["aisle_id"], r["department_id"]) for r in pairs.collect()) == [
            (1, 1), (1, 1), (2, 2), (2, 2)
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
