import time

import pytest
from pyspark.errors import AnalysisException

from basketseq import schemas
from basketseq.functions.cleaning import fill_and_cast, fill_gaps
from basketseq.sources import files, star_schema
from tests.brute import random_source
from tests.frames import source_tables


def write_source_csv(spark, source, folder):
    tables = source_tables(spark, source)
    frames = {
        "orders": tables.orders,
        "products": tables.products,
        "order_products__prior": tables.prior,
        "order_products__train": tables.train,
        "aisles": spark.createDataFrame([(3, "a"), (5, "b")], schemas.AISLES),
        "departments": spark.createDataFrame([(1, "d, with comma")], schemas.DEPARTMENTS),
    }
    for name, frame in frames.items():
        files.write_csv(frame, folder / f"{name}.csv")
    return frames


def test_ingest_is_typed_and_counted(spark, tmp_path, rows):
    frames = write_source_csv(spark, random_source(1), tmp_path / "raw")
    counts = files.ingest_csv_tables(spark, tmp_path / "raw", tmp_path / "bronze")
    for name, frame in frames.items():
        table = files.read_parquet(spark, tmp_path / "bronze" / name)
        assert table.dtypes == frame.dtypes
        assert rows(table) == rows(frame)
        assert counts[name] == frame.count()


def test_bad_cells_become_null(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(
        "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
        "1,2,prior,200,3,x,\n"
    )
    row = files.read_csv(spark, path, schemas.ORDERS).first()
    assert (row["order_id"], row["order_number"], row["order_hour_of_day"]) == (1, None, None)
    assert row["days_since_prior_order"] is None


ORDERS_HEADER = (
    "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
)


@pytest.mark.parametrize(
    ("table", "line", "column"),
    [
        ("orders", "3000000000,2,prior,1,3,4,5.0", "order_id"),
        ("orders", "1,2,prior,128,3,4,", "order_number"),
        ("order_products__prior", "1,3000000000,1,0", "product_id"),
        ("products", "1,name,x,1", "aisle_id"),
    ],
)
def test_ingest_raises_on_cells_that_do_not_fit(spark, tmp_path, table, line, column):
    write_source_csv(spark, random_source(1), tmp_path / "raw")
    header = ORDERS_HEADER if table == "orders" else {
        "order_products__prior": "order_id,product_id,add_to_cart_order,reordered\n",
        "products": "product_id,product_name,aisle_id,department_id\n",
    }[table]
    extra = tmp_path / "raw" / f"{table}.csv" / "more.csv"
    extra.write_text(header + line + "\n")
    with pytest.raises(ValueError, match=f"cells of {table} .*'{column}': 1"):
        files.ingest_csv_tables(spark, tmp_path / "raw", tmp_path / "bronze")
    assert not (tmp_path / "bronze" / table).exists()
    files.ingest_csv_tables(spark, tmp_path / "raw", tmp_path / "nulls", on_bad_cells="null")
    assert files.read_parquet(spark, tmp_path / "nulls" / table).where(f"{column} is null").count() == 1
    if table != "products":
        wide = schemas.WIDE_SOURCE_TABLES
        files.ingest_csv_tables(spark, tmp_path / "raw", tmp_path / "wide", wide)
        value = max(int(v) for v in line.split(",") if v.isdigit())
        stored = files.read_parquet(spark, tmp_path / "wide" / table)
        assert dict(stored.dtypes)[column] == "bigint"
        assert stored.where(f"{column} = {value}").count() == 1


def test_schema_is_inferred_without_contract(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,x\n")
    assert files.read_csv(spark, path).dtypes == [("a", "int"), ("b", "string")]


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_csv(spark, tmp_path / "nothing.csv")


def test_parquet_overwrites(spark, tmp_path):
    files.write_parquet(spark.range(5), tmp_path / "t")
    files.write_parquet(spark.range(3), tmp_path / "t")
    assert files.read_parquet(spark, tmp_path / "t").count() == 3


def test_load_and_split_tags(spark, tmp_path, rows):
    tables = source_tables(spark, random_source(2))
    for name, frame in zip(
        ["orders", "products", "order_products__prior", "order_products__train"],
        [tables.orders, tables.products, tables.prior, tables.train],
        strict=True,
    ):
        files.write_parquet(frame, tmp_path / name)
    loaded = files.load_source_tables(spark, tmp_path)
    assert rows(loaded.train) == rows(tables.train)
    expected = [
        {"user_id": r[1], "target_eval_set": r[2]}
        for r in random_source(2)["orders"]
        if r[2] != "prior"
    ]
    assert rows(files.split_tags(loaded.orders)) == sorted(expected, key=repr)


@pytest.mark.parametrize(
    ("dtype", "value", "expected"),
    [
        ("double", None, -1),
        ("double", float("nan"), -1),
        ("double", 7.0, 7),
        ("string", None, -1),
        ("string", "10", 10),
        ("int", None, -1),
    ],
)
def test_fill_and_cast(spark, dtype, value, expected):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    out = fill_and_cast(df, "x", -1, "int")
    assert out.dtypes == [("x", "int")]
    assert out.first()["x"] == expected


def test_fill_gaps_touches_only_named_columns(spark):
    df = spark.createDataFrame([(None, None, 2.0)], "a double, b double, c double")
    assert tuple(fill_gaps(df, ["a", "c"]).first()) == (-1, None, 2)


def test_star_schema_tables_are_stored_once(spark, rows):
    """Prior and train items are read from the same stored table, without a second join."""
    folder = "/root/testdata/sf0.001"
    lazy = star_schema.star_schema_tables(spark, folder)
    stored = star_schema.stored_tables(spark, folder)
    for name in ("orders", "products", "prior", "train"):
        assert rows(getattr(stored, name)) == rows(getattr(lazy, name))
        plan = getattr(stored, name)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Window" not in plan


def test_shuffles_go_when_their_table_is_written(spark, tmp_path):
    """Not only when the driver collects garbage."""
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        names = (one.getName() for one in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles()))
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffles()
    table = spark.range(1000).repartition(3, "id")
    files.write_parquet(table, tmp_path / "table")
    files.write_csv(table, tmp_path / "csv")
    assert files.read_parquet(spark, tmp_path / "table").count() == 1000
    deadline = time.monotonic() + 10
    while left := {name for name in shuffles() - before if name.endswith(".data")}:
        if time.monotonic() > deadline:
            break
        time.sleep(0.1)
    # The count's own single row may still be there.
    assert len(left) <= 1
