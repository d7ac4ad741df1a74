import pytest

from basketseq import schemas
from basketseq.functions.sequences import pad
from basketseq.operators import baskets, enrich, history, reorder_size, training, vocabulary
from basketseq.operators.ranking import rank_in_ranges
from basketseq.sources.files import split_tags
from pyspark.sql import functions as F
from tests import brute
from tests.frames import source_tables


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("as_text", [True, False])
def test_reorder_size_matches_brute_force(spark, rows, seed, as_text):
    source = brute.random_source(seed, n_users=20)
    items = enrich.enriched_items(source_tables(spark, source))
    users = baskets.user_sequences(baskets.order_baskets(items))
    users = baskets.sequence_text(users) if as_text else users
    expected = brute.size_rows(source)
    got = reorder_size.reorder_size(users)
    assert rows(got, *expected[0]) == sorted(expected, key=repr)

    padded = training.reorder_size_training(users, 3)
    assert padded.columns == schemas.REORDER_SIZE_TRAINING
    by_user = {r["user_id"]: r for r in expected}
    orders = brute.users_of(source)
    for row in padded.collect():
        sizes = by_user[row["user_id"]]
        assert row["order_sizes"] == brute.padded(sizes["order_sizes"], 3)
        assert row["reorder_sizes"] == brute.padded(sizes["reorder_sizes"], 3)
        assert row["history_length"] == min(3, len(sizes["reorder_sizes"]))
        assert row["order_hours"] == brute.padded([o["hour"] for o in orders[row["user_id"]]], 3)


def test_blank_reorders_are_no_orders(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "  "), (3, "1_1"), (4, " 0_1  1 ")], "user_id int, reorders string")
    got = rows(reorder_size.reorder_size(df), "user_id", "reorders_prev", "reorders_next", "order_sizes", "label")
    assert [tuple(r.values()) for r in got] == [
        (1, [], [], [], 0),
        (2, [], [], [], 0),
        (3, [[1, 1]], [], [2], 0),
        (4, [[0, 1]], [1], [2], 1),
    ]


NAMES = [
    (1, "Green Tea"),
    (2, "green  PEPPER"),
    (3, " black tea "),
    (4, None),
    (5, "   "),
    (6, "green"),
    (7, "\tpepper"),
    (8, "saffron"),
]


def test_word_index(spark):
    products = spark.createDataFrame(NAMES, "product_id int, product_name string")
    index = vocabulary.word_index(products, 2)
    assert index.dtypes == [("word", "string"), ("word_idx", "int")]
    got = {r["word"]: r["word_idx"] for r in index.collect()}
    assert got == {"green": 1, "pepper": 2, "tea": 3, "black": 0, "saffron": 0}
    assert got == brute.vocabulary([name for _, name in NAMES], 2)


def test_encode_names(spark, rows):
    products = spark.createDataFrame([*NAMES, (9, "tea"), (9, "green tea")], "product_id int, product_name string")
    index = spark.createDataFrame([("green", 1), ("pepper", 2), ("tea", 3), ("black", 0)], "word string, word_idx int")
    got = [tuple(r.values()) for r in rows(vocabulary.encode_names(products, index))]
    assert got == [
        (1, "1 3"),
        (2, "1 2"),
        (3, "0 3"),
        (4, "0"),
        (5, "0"),
        (6, "1"),
        (7, "2"),
        (8, ""),
        # Listed twice: the tokens of both names, in place order, on both rows.
        (9, "1 3 3"),
        (9, "1 3 3"),
    ]


def test_rank_in_ranges_equals_row_number(spark):
    df = spark.range(2000).select(
        (F.col("id") % 7).alias("word_count"), F.md5(F.col("id").cast("string")).alias("word")
    )
    ranked = rank_in_ranges(df, [F.desc("word_count"), F.asc("word")], "r").collect()
    expected = sorted((-r["word_count"], r["word"]) for r in df.collect())
    assert [(-r["word_count"], r["word"]) for r in sorted(ranked, key=lambda r: r["r"])] == expected
    assert sorted(r["r"] for r in ranked) == list(range(1, 2001))


@pytest.mark.parametrize("stored", [True, False])
def test_missing_sequences_are_all_zeros(spark, stored):
    """A null sequence pads to zeros, whichever form the table stores."""
    dtype = "string" if stored else "array<int>"
    names = ["order_sizes", "reorder_sizes", *schemas.TEMPORAL]
    df = spark.createDataFrame([(1, *[None] * 6)], "user_id int, " + ", ".join(f"{n} {dtype}" for n in names))
    row = training.pad_reorder_sizes(df, 3).first()
    assert all(row[name] == [0, 0, 0] for name in names) and row["history_length"] == 0


def test_padding_can_keep_the_newest(spark):
    df = spark.createDataFrame([([1, 2, 3, 4],), ([5],), ([],)], "v array<int>")
    newest = [r[0] for r in df.select(pad(F.col("v"), 3, keep="last")).collect()]
    assert newest == [[2, 3, 4], [5, 0, 0], [0, 0, 0]]
    with pytest.raises(ValueError, match="keep must be"):
        pad(F.col("v"), 3, keep="middle")


def test_product_training(spark):
    source = brute.random_source(4)
    tables = source_tables(spark, source)
    users = baskets.user_sequences(baskets.order_baskets(enrich.enriched_items(tables)))
    stored = history.product_history_with_none(users, split_tags(tables.orders), tables.products)
    known = tables.products.where("product_id <> 2")
    got = training.product_training(stored, known, 2, 3, 4)
    assert got.columns == schemas.PRODUCT_TRAINING
    types = dict(got.dtypes)
    assert types["product_name_encoded"] == types["order_hours"] == "array<int>"
    assert types["history_length"] == types["product_name_length"] == "int"
    source_rows = {
        (r["user_id"], r["product_id"]): r for r in brute.product_rows(source) + brute.none_rows(source)
    }
    rows = got.collect()
    for some_users in (users, baskets.sequence_text(users)):
        straight = training.product_training_of_users(
            some_users, split_tags(tables.orders), known, 2, 3, 4
        )
        assert sorted(map(repr, straight.collect())) == sorted(map(repr, rows))
    assert len(rows) == len(source_rows)
    for row in rows:
        expected = source_rows[row["user_id"], row["product_id"]]
        for name in ["is_ordered_history", "history_reorder_size", "order_numbers"]:
            assert row[name] == brute.padded([int(t) for t in expected[name].split()], 4)
        assert row["history_length"] == min(4, len(expected["is_ordered_history"].split()))
        # "name" is the one frequent word; ids 0 (None) and 2 are not in the table.
        named = row["product_id"] not in (0, 2)
        assert row["product_name_encoded"] == ([1, 0, 0] if named else [0, 0, 0])
        assert row["product_name_length"] == (2 if named else 0)


def test_aisle_training(spark):
    columns = ["is_ordered_history", "position_in_order", "num_products_from_aisle", "aisle_history_size", *schemas.TEMPORAL]
    df = spark.createDataFrame(
        [(1, "1 0 1 1", " 2 0 1 9", "3", "", None, "  ", "-1 7", "1 2 3 4 5")],
        "user_id int, " + ", ".join(f"{c} string" for c in columns),
    )
    row = training.aisle_training(df, 3).first()
    assert row["is_ordered_history"] == [1, 0, 1]
    assert row["position_in_order"] == [2, 0, 1]
    assert row["num_products_from_aisle"] == [3, 0, 0]
    assert row["aisle_history_size"] == row["order_dows"] == row["order_hours"] == [0, 0, 0]
    assert row["days_since_prior_orders"] == [-1, 7, 0]
    assert row["order_numbers"] == [1, 2, 3]
    assert row["history_length"] == 3


def test_pad_reorder_sizes_keeps_long_sizes(spark):
    df = spark.createDataFrame(
        [(1, "", None, "-1 4", "1 2", [5, 6, 7], [])],
        "user_id int, order_dows string, order_hours string, days_since_prior_orders string, "
        "order_numbers string, order_sizes array<bigint>, reorder_sizes array<bigint>",
    )
    row = training.pad_reorder_sizes(df, 2).first()
    assert (row["order_sizes"], row["reorder_sizes"], row["history_length"]) == ([5, 6], [0, 0], 0)
    assert (row["order_dows"], row["order_hours"], row["order_numbers"]) == ([0, 0], [0, 0], [1, 2])


def test_encode_names_collects_numbers(spark, rows):
    """One number a word, not a struct: any int as id, in the order of the words."""
    products = spark.createDataFrame(
        [(1, "b a c a"), (2, "z"), (3, "a"), (3, "b")], "product_id bigint, product_name string"
    )
    index = spark.createDataFrame(
        [("a", 2**31 - 1), ("b", -(2**31)), ("c", 0)], "word string, word_idx int"
    )
    encoded = vocabulary.encode_names(products, index)
    got = {tuple(r.values()) for r in rows(encoded)}
    low, high = -(2**31), 2**31 - 1
    # Of a product listed twice, equal places follow each other by id.
    assert got == {(1, f"{low} {high} 0 {high}"), (2, ""), (3, f"{low} {high}")}
    assert encoded.count() == 4
    plan = encoded._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and "struct" not in plan


def test_rows_move_to_their_names_unpadded(spark):
    """Padded rows take ten times the bytes of stored ones, in the shuffle and its sort."""
    source = brute.random_source(4)
    tables = source_tables(spark, source)
    users = baskets.user_sequences(baskets.order_baskets(enrich.enriched_items(tables)))
    stored = history.product_history_with_none(users, split_tags(tables.orders), tables.products)
    table = training.product_training(stored, tables.products, 2, 3, 4)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    after, _, before = plan.partition("Join LeftOuter")
    assert "AS history_length" in after and "AS history_length" not in before


@pytest.fixture
def no_broadcasts(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("large_user_items", [4_000, 6, 0])
@pytest.mark.parametrize("as_text", [True, False])
def test_products_too_many_to_broadcast(spark, rows, no_broadcasts, as_text, large_user_items):
    """Products come to the users: missing ones, ones listed twice, a user without id."""
    source = brute.random_source(4)
    tables = source_tables(spark, source)
    users = baskets.user_sequences(baskets.order_baskets(enrich.enriched_items(tables)))
    users = users.withColumn("user_id", F.nullif("user_id", F.lit(3)))
    users = baskets.sequence_text(users) if as_text else users
    products = tables.products.where("product_id <> 2")
    products = products.unionAll(products.where("product_id < 5"))
    tags = split_tags(tables.orders)
    found = history.product_history(
        users, tags, products, as_text, large_user_items=large_user_items
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    joined = history.product_history(
        users, tags, products, as_text, large_user_items=large_user_items
    )
    assert found.columns == joined.columns
    assert rows(found) == rows(joined) != []


def test_training_of_users_with_names_too_many_to_broadcast(spark, rows, no_broadcasts):
    source = brute.random_source(4)
    tables = source_tables(spark, source)
    users = baskets.user_sequences(baskets.order_baskets(enrich.enriched_items(tables)))
    products = tables.products.where("product_id <> 2")
    products = products.unionAll(products.where("product_id = 3")).unionAll(
        products.where("product_id = 3").withColumn("product_id", F.lit(0).cast("int"))
    )
    tags = split_tags(tables.orders)
    moved = training.product_training_of_users(users, tags, products, 2, 3, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    joined = training.product_training_of_users(users, tags, products, 2, 3, 4)
    assert moved.columns == joined.columns
    assert rows(moved) == rows(joined) != []


@pytest.mark.parametrize("usual_pairs", [4_000, 3, 0])
def test_stored_pairs_with_names_too_many_to_broadcast(
    spark, rows, no_broadcasts, monkeypatch, usual_pairs
):
    source = brute.random_source(4)
    tables = source_tables(spark, source)
    users = baskets.user_sequences(baskets.order_baskets(enrich.enriched_items(tables)))
    pairs = history.product_history_with_none(users, split_tags(tables.orders), tables.products)
    # A user without id, products without one, and a row that comes twice.
    pairs = pairs.withColumns(
        {
            "user_id": F.nullif("user_id", F.lit(3)),
            "product_id": F.nullif("product_id", F.lit(4)),
        }
    ).unionAll(pairs.where("product_id = 1"))
    products = tables.products.where("product_id <> 2")
    products = products.unionAll(products.where("product_id = 3"))
    monkeypatch.setattr(training, "USUAL_PAIRS", usual_pairs, raising=False)
    by_user = training.product_training(pairs, products, 2, 3, 4)
    shuffles = by_user._jdf.queryExecution().toString().count("hashpartitioning(user_id")
    assert shuffles > 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    joined = training.product_training(pairs, products, 2, 3, 4)
    assert by_user.columns == joined.columns
    assert rows(by_user) == rows(joined) != []
