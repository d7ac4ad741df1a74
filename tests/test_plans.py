"""Plan properties that decide about large data."""

import pytest

from basketseq.operators import baskets, history, training
from basketseq.plans import jobs, queries
from basketseq.sources import files
from tests.brute import random_source
from tests.test_sources import write_source_csv


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    write_source_csv(spark, random_source(9), folder / "raw")
    files.ingest_csv_tables(spark, folder / "raw", folder)
    jobs.build_order_products(spark, folder, folder)
    jobs.build_user_data(spark, folder / "order_products", folder / "user_data")
    return folder


@pytest.fixture
def plan(capsys):
    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


def test_split_tags_reach_the_scan(spark, stored, plan):
    text = plan(files.split_tags(files.read_parquet(spark, stored / "orders")))
    assert "PushedFilters: [In(eval_set" in text
    assert "ReadSchema: struct<user_id:int,eval_set:string>" in text


def test_histories_read_only_their_sequence(spark, stored, plan):
    users = files.read_parquet(spark, stored / "user_data")
    text = plan(history.aisle_history(users, files.read_parquet(spark, stored / "products")))
    assert "product_ids" not in text and "reorders" not in text
    assert "ReadSchema: struct<aisle_id:smallint,department_id:tinyint>" in text


def test_histories_shuffle_only_chunks_of_large_users(spark, stored, plan):
    users = files.read_parquet(spark, stored / "user_data")
    tags = files.split_tags(files.read_parquet(spark, stored / "orders"))
    products = files.read_parquet(spark, stored / "products")
    text = plan(history.product_history(users, tags, products))
    shuffles = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert len(shuffles) == 1 and "chunk" in shuffles[0]


def test_reorder_sizes_are_narrow(spark, stored, plan):
    users = files.read_parquet(spark, stored / "user_data")
    assert "Exchange" not in plan(training.reorder_size_training(users, 10))


def test_two_shuffles_from_stored_items_to_users(spark, stored, plan):
    items = files.read_parquet(spark, stored / "order_products")
    text = plan(baskets.sequence_text(jobs.user_data(items)))
    shuffles = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert len(shuffles) == 2
    assert "product_name" not in text


def test_no_python_in_the_data_path(spark, stored, plan):
    users = files.read_parquet(spark, stored / "user_data")
    tags = files.split_tags(files.read_parquet(spark, stored / "orders"))
    products = files.read_parquet(spark, stored / "products")
    pairs = history.product_history_with_none(users, tags, products)
    assert "Python" not in plan(training.product_training(pairs, products, 2, 3, 4))


@pytest.mark.parametrize("name", ["d1_join_counts", "a8_row_counts", "a4_declared_target"])
def test_items_read_several_times_are_derived_once(spark, plan, name):
    """Else one task sorts the rows of several joins, those of prior and train items."""
    text = plan(queries.REGISTRY[name](spark, "/root/testdata/sf0.001"))
    assert "Window" not in text and "l_orderkey" not in text
