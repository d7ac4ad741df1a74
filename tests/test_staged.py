import os

import pytest
from pyspark.sql import functions as F

from basketseq.operators import enrich
from basketseq.sources.files import SourceTables, ingest_csv_tables, read_parquet
from basketseq.sources.staged import write_checked
from tests.brute import random_source
from tests.frames import source_tables

ITEMS = "order_id int, product_id int, add_to_cart_order smallint, reordered tinyint"


def test_counts_come_from_the_write(spark, tmp_path):
    tables, path = source_tables(spark, random_source(6)), tmp_path / "order_products"
    counts = enrich.write_enriched_items(tables, path)
    n = tables.prior.count() + tables.train.count()
    assert counts == {"joined_count": n, "raw_count": n}
    assert read_parquet(spark, path).count() == n
    assert os.listdir(tmp_path) == ["order_products"]


def test_a_mismatch_is_never_seen(spark, tmp_path):
    tables, path = source_tables(spark, random_source(7)), tmp_path / "order_products"
    enrich.write_enriched_items(tables, path)
    before = read_parquet(spark, path).count()
    for products in (tables.products.where("product_id > 2"), tables.products.limit(0)):
        broken = SourceTables(tables.orders, products, tables.prior, tables.train)
        with pytest.raises(ValueError, match="Joined row count mismatch"):
            enrich.write_enriched_items(broken, path)
        doubled = SourceTables(
            tables.orders, tables.products.union(tables.products), tables.prior, tables.train
        )
        with pytest.raises(ValueError, match="Joined row count mismatch"):
            enrich.write_enriched_items(doubled, path)
    assert read_parquet(spark, path).count() == before
    assert os.listdir(tmp_path) == ["order_products"]


def test_empty_tables_agree(spark, tmp_path):
    tables = source_tables(spark, random_source(7))
    empty = SourceTables(tables.orders, tables.products, tables.prior.limit(0), tables.train.limit(0))
    counts = enrich.write_enriched_items(empty, tmp_path / "order_products")
    assert counts == {"joined_count": 0, "raw_count": 0}


def test_a_failed_job_leaves_the_table(spark, tmp_path):
    path = tmp_path / "numbers"
    write_checked(spark.range(3), path, lambda: None)
    with pytest.raises(Exception, match="no such number"):
        write_checked(
            spark.range(9).select(F.raise_error(F.lit("no such number")).alias("id")), path, lambda: None
        )
    assert read_parquet(spark, path).count() == 3 and os.listdir(tmp_path) == ["numbers"]


RAGGED = "order_id,product_id,add_to_cart_order,reordered\n1,2,1,0\n1,3,2,0,7\n2,2\n2,5,1,\n\n3,4,1,1\n"


def _ingest(spark, tmp_path, text=RAGGED, **options):
    (tmp_path / "raw").mkdir(exist_ok=True)
    (tmp_path / "raw" / "items.csv").write_text(text)
    return ingest_csv_tables(spark, tmp_path / "raw", tmp_path / "out", {"items": ITEMS}, **options)


def test_ragged_rows_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="2 rows of items"):
        _ingest(spark, tmp_path)
    assert not (tmp_path / "out" / "items").exists()
    with pytest.raises(ValueError):
        _ingest(spark, tmp_path, on_ragged_rows="drop")


def test_ragged_rows_are_kept_aside(spark, tmp_path, rows):
    assert _ingest(spark, tmp_path, on_ragged_rows="quarantine") == {"items": 3}
    kept = read_parquet(spark, tmp_path / "out" / "_quarantine" / "items").collect()
    assert sorted(r.row_text for r in kept) == ["1,3,2,0,7", "2,2"]
    assert all(r.file.endswith("items.csv") for r in kept)
    assert sorted(r.cells for r in kept) == [["1", "3", "2", "0"], ["2", "2", None, None]]
    whole = read_parquet(spark, tmp_path / "out" / "items")
    assert sorted(map(tuple, whole.collect()), key=repr) == [(1, 2, 1, 0), (2, 5, 1, None), (3, 4, 1, 1)]


def test_header_is_checked(spark, tmp_path):
    swapped = "product_id,order_id,add_to_cart_order,reordered\n1,2,1,0\n"
    with pytest.raises(ValueError, match="expected"):
        _ingest(spark, tmp_path, swapped)
