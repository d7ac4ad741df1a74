"""CSV and parquet scans and sinks, typed ingest, multi-table load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import _parse_datatype_string

from basketseq import schemas
from basketseq.sources.shared import drop_folder, dropping_shuffles


def child(folder, name: str) -> str:
    return f"{str(folder).rstrip('/')}/{name}"


def read_csv(spark: SparkSession, path, schema=None) -> DataFrame:
    """CSV with a header. Bad cells become null; a missing path raises.

    Without a schema Spark infers one, which costs an extra pass.
    """
    options = {"header": True} if schema is not None else {"header": True, "inferSchema": True}
    return spark.read.csv(str(path), schema=schema, **options)


def write_csv(df: DataFrame, path) -> None:
    with dropping_shuffles(df.sparkSession):
        df.write.csv(str(path), header=True, mode="overwrite")


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(str(path))


def write_parquet(df: DataFrame, path, rows_per_file: int = 0) -> None:
    """``rows_per_file`` starts a new file after so many rows (0: never). Where rows
    take a few bytes each but much work, readers that split by bytes get few and uneven
    tasks; files of bounded rows are dealt out evenly."""
    with dropping_shuffles(df.sparkSession):
        df.write.option("maxRecordsPerFile", rows_per_file).parquet(str(path), mode="overwrite")


#: The text of a row whose number of cells is not the header's.
_RAGGED = "_ragged_row"


def check_header(spark: SparkSession, path, names: list[str]) -> None:
    """Raise unless the first line names the columns in the contract's order."""
    found = spark.read.csv(str(path), header=True).columns
    if [name.strip().lower() for name in found] != [name.lower() for name in names]:
        raise ValueError(f"columns of {path} are {found}, expected {names}")


def ingest_csv_tables(
    spark: SparkSession,
    input_dir,
    output_dir,
    source_tables: dict[str, str] = schemas.SOURCE_TABLES,
    on_bad_cells: str = "raise",
    on_ragged_rows: str = "raise",
    quarantine_dir=None,
) -> dict[str, int]:
    """Typed CSV -> parquet for the six source tables; returns the row counts.

    A cell that holds something but nothing of its column's type, such as an id
    beyond 32 bits, is a bad cell. By default a table with bad cells raises and is
    not left behind; ``on_bad_cells="null"`` writes it with nulls in their place.
    ``schemas.WIDE_SOURCE_TABLES`` as ``source_tables`` takes any 64-bit value.

    A row with more or fewer cells than the header is ragged. By default that raises,
    too; ``on_ragged_rows="quarantine"`` leaves such rows out and writes them to
    ``quarantine_dir`` (default: ``_quarantine`` in ``output_dir``), one table per
    source table: ``file``, ``row_text``, and the ``cells`` as far as they go. Columns go by place, so every file's header
    has to name them in the contract's order.

    Rows, bad cells and ragged rows are observed while the rows are written, so every
    file is read once; only a table with ragged rows to keep is read again for them.
    """
    if on_bad_cells not in ("raise", "null"):
        raise ValueError(f"on_bad_cells must be 'raise' or 'null', not {on_bad_cells!r}")
    if on_ragged_rows not in ("raise", "quarantine"):
        raise ValueError(
            f"on_ragged_rows must be 'raise' or 'quarantine', not {on_ragged_rows!r}"
        )
    counts = {}
    for table, schema in source_tables.items():
        seen = Observation(f"ingest_{table}")
        fields = _parse_datatype_string(schema).fields
        source = child(input_dir, f"{table}.csv")
        check_header(spark, source, [field.name for field in fields])
        text = ", ".join(f"{field.name} STRING" for field in fields)
        cells = spark.read.csv(
            source,
            schema=f"{text}, {_RAGGED} STRING",
            header=True,
            enforceSchema=False,
            columnNameOfCorruptRecord=_RAGGED,
        )
        is_ragged = F.col(_RAGGED).isNotNull()
        typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in fields}
        bad = [
            F.count_if(~is_ragged & (F.trim(name) != "") & value.isNull()).alias(f"bad_{name}")
            for name, value in typed.items()
        ]
        rows = cells.observe(
            seen,
            F.count_if(~is_ragged).alias("rows"),
            F.count_if(is_ragged).alias("ragged"),
            *bad,
        )
        target = child(output_dir, table)
        whole = rows.where(~is_ragged)
        write_parquet(whole.select(*[value.alias(name) for name, value in typed.items()]), target)
        counts[table] = seen.get["rows"]
        wrong = {name: seen.get[f"bad_{name}"] for name in typed if seen.get[f"bad_{name}"]}
        if wrong and on_bad_cells == "raise":
            drop_folder(spark, target)
            raise ValueError(f"cells of {table} that do not fit their type, by column: {wrong}")
        if seen.get["ragged"] and on_ragged_rows == "raise":
            drop_folder(spark, target)
            raise ValueError(
                f"{seen.get['ragged']} rows of {table} have more or fewer than {len(fields)} cells"
            )
        if seen.get["ragged"]:
            folder = quarantine_dir or child(output_dir, "_quarantine")
            kept = cells.where(is_ragged).select(
                F.input_file_name().alias("file"),
                F.col(_RAGGED).alias("row_text"),
                F.array(*typed).alias("cells"),
            )
            write_parquet(kept, child(folder, table))
    return counts


@dataclass(frozen=True)
class SourceTables:
    """The tables the feature jobs start from, as lazy DataFrames."""

    orders: DataFrame
    products: DataFrame
    prior: DataFrame
    train: DataFrame


def load_source_tables(spark: SparkSession, folder) -> SourceTables:
    return SourceTables(
        orders=read_parquet(spark, child(folder, "orders")),
        products=read_parquet(spark, child(folder, "products")),
        prior=read_parquet(spark, child(folder, "order_products__prior")),
        train=read_parquet(spark, child(folder, "order_products__train")),
    )


def split_tags(orders: DataFrame) -> DataFrame:
    """(user_id, target_eval_set) of the orders tagged as target."""
    return orders.where(F.col("eval_set").isin("train", "test")).select(
        "user_id", F.col("eval_set").alias("target_eval_set")
    )
