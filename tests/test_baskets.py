import pytest

from basketseq.operators import baskets, enrich
from tests import brute
from tests.frames import source_tables

ITEM = (
    "user_id int, order_id int, add_to_cart_order smallint, product_id int, reordered tinyint, "
    "department_id int, aisle_id int, order_number int, order_dow int, order_hour_of_day int, "
    "days_since_prior_order int, eval_set string"
)


@pytest.mark.parametrize("seed", range(4))
def test_user_sequences_match_brute_force(spark, rows, seed):
    source = brute.random_source(seed)
    items = enrich.enriched_items(source_tables(spark, source))
    got = rows(baskets.sequence_text(baskets.user_sequences(baskets.order_baskets(items))))
    assert got == sorted(brute.user_rows(brute.users_of(source)), key=repr)


def test_equal_positions_follow_the_text_of_the_id(spark):
    lines = [(1, 4, pos, product, 0, 1, 2, 1, 0, 0, -1, "prior") for pos, product in [(2, 9), (2, 10), (1, 33)]]
    df = spark.createDataFrame(lines, ITEM)
    row = baskets.basket_text(baskets.order_baskets(df)).first()
    assert row["products"] == "33_10_9"


def test_missing_values_leave_no_token(spark):
    lines = [
        (1, 4, 1, 7, 0, 1, None, 1, 0, 0, None, "prior"),
        (1, 4, 2, 8, None, None, 6, 1, 0, 0, None, "prior"),
    ]
    df = spark.createDataFrame(lines, ITEM)
    typed = baskets.user_sequences(baskets.order_baskets(df))
    row = baskets.sequence_text(typed).first()
    assert (row["product_ids"], row["reorders"], row["department_ids"], row["aisle_ids"]) == (
        "7_8", "0", "1", "6",
    )
    assert row["days_since_prior_orders"] == ""
    assert typed.first()["aisle_ids"] == [[6]]


def test_last_eval_set_is_that_of_the_last_order_with_items(spark):
    lines = [
        (1, 4, 1, 7, 0, 1, 2, 10, 0, 0, 3, "train"),
        (1, 5, 1, 7, 0, 1, 2, 9, 0, 0, 3, "prior"),
    ]
    df = spark.createDataFrame(lines, ITEM)
    row = baskets.user_sequences(baskets.order_baskets(df)).first()
    assert row["order_ids"] == ["5", "4"]
    assert row["eval_set"] == "train"
