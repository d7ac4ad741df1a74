import pytest

from basketseq.operators.history import product_history_with_none
from basketseq.plans import jobs
from basketseq.sources import files
from tests import brute
from tests.test_sources import write_source_csv


@pytest.mark.parametrize("as_text", [True, False])
def test_stored_table_jobs(spark, tmp_path, rows, as_text):
    source = brute.random_source(8)
    write_source_csv(spark, source, tmp_path / "raw")
    bronze, out = tmp_path / "bronze", tmp_path / "out"
    files.ingest_csv_tables(spark, tmp_path / "raw", bronze)
    jobs.build_order_products(spark, bronze, out, check_joins=True)
    jobs.build_user_data(spark, out / "order_products", out / "user_data", as_text)
    jobs.build_product_history(spark, out, bronze, out / "product_history_data", as_text)
    jobs.build_aisle_history(spark, out, bronze, out, as_text)
    jobs.build_product_training(spark, bronze, out, out, 2, 3, 4)
    jobs.build_aisle_training(spark, out, out, 5)
    jobs.build_reorder_size_training(spark, out, out, 5)

    def table(name):
        return files.read_parquet(spark, out / name)

    n_pairs = len(brute.product_rows(source))
    n_users = len(brute.users_of(source))
    assert table("order_products").count() == len(source["prior"] + source["train"])
    assert table("product_training_data").count() == n_pairs + n_users
    assert table("reorder_size_training_data").count() == n_users
    assert table("aisle_training_data").count() == table("aisle_history_data").count()
    if as_text:
        assert rows(table("user_data")) == sorted(brute.user_rows(brute.users_of(source)), key=repr)
        assert rows(table("product_history_data")) == sorted(
            brute.product_rows(source) + brute.none_rows(source), key=repr
        )
    again = product_history_with_none(
        table("user_data"),
        files.split_tags(files.read_parquet(spark, bronze / "orders")),
        files.read_parquet(spark, bronze / "products"),
        as_text,
    )
    assert rows(again) == rows(table("product_history_data"))


def test_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    """Later jobs get tasks of even work, though many rows take few bytes."""
    source = brute.random_source(8)
    write_source_csv(spark, source, tmp_path / "raw")
    bronze, out = tmp_path / "bronze", tmp_path / "out"
    files.ingest_csv_tables(spark, tmp_path / "raw", bronze)
    monkeypatch.setattr(jobs, "USERS_PER_FILE", 2, raising=False)
    monkeypatch.setattr(jobs, "PAIRS_PER_FILE", 3, raising=False)
    jobs.build_order_products(spark, bronze, out)
    jobs.build_user_data(spark, out / "order_products", out / "user_data")
    jobs.build_product_history(spark, out, bronze, out / "product_history_data")
    jobs.build_product_training(spark, bronze, out, out, 2, 3, 4)
    for name, most in (("user_data", 2), ("product_history_data", 3), ("product_training_data", 3)):
        table = files.read_parquet(spark, out / name)
        per_file = table.groupBy("_metadata.file_path").count()
        assert per_file.agg({"count": "max"}).first()[0] <= most
    assert files.read_parquet(spark, out / "user_data").count() == len(brute.users_of(source))
    assert files.read_parquet(spark, out / "product_training_data").count() == len(
        brute.product_rows(source)
    ) + len(brute.users_of(source))
