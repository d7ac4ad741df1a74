"""Times the headline queries over stored tables and prints one JSON line.

Stage tables are written first, once, the way the jobs write them, so that each
number is one job's work: build the plan, read the stored input, compute,
materialise every row (noop sink). One warm-up run, then the median of
BENCH_RUNS runs. Entries ending in _arrays read and write typed arrays instead
of the stored text.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketseq.operators import baskets, enrich, history, training, vocabulary
from basketseq.plans import jobs, queries as q
from basketseq.sources import files, star_schema
from basketseq.sources.shared import new_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("basketseq-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def store(df: DataFrame, path: str) -> DataFrame:
    files.write_parquet(df, path)
    return files.read_parquet(df.sparkSession, path)


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    folder = new_folder(spark, "bench")

    start = time.perf_counter()
    model = star_schema.star_schema_tables(spark, SF_DIR)
    tables = files.SourceTables(
        orders=store(model.orders, f"{folder}/orders"),
        products=store(model.products, f"{folder}/products"),
        prior=store(model.prior, f"{folder}/order_products__prior"),
        train=store(model.train, f"{folder}/order_products__train"),
    )
    items = store(enrich.enriched_items(tables), f"{folder}/order_products")
    typed_users = store(jobs.user_data(items), f"{folder}/user_arrays")
    users = store(baskets.sequence_text(typed_users), f"{folder}/user_data")
    tags = files.split_tags(tables.orders)
    pairs = store(
        history.product_history_with_none(users, tags, tables.products), f"{folder}/product_history"
    )
    typed_pairs = store(
        history.product_history_with_none(typed_users, tags, tables.products, as_text=False),
        f"{folder}/product_history_arrays",
    )
    aisles = store(history.aisle_history(users, tables.products), f"{folder}/aisle_history")
    setup = time.perf_counter() - start

    documents = files.read_parquet(spark, f"{SF_DIR}/documents.parquet").select(
        F.col("doc_id").alias("product_id"), F.col("text").alias("product_name")
    )
    headline = {
        "u2_order_products": lambda: enrich.enriched_items(tables),
        "a3_user_sequences": lambda: baskets.sequence_text(jobs.user_data(items)),
        "p_product_history": lambda: history.product_history(users, tags, tables.products),
        "p_product_history_arrays": lambda: history.product_history(
            typed_users, tags, tables.products, as_text=False
        ),
        "p_product_history_spread": lambda: history.product_history(
            typed_users, tags, tables.products, as_text=False, large_user_items=0
        ),
        "o4_product_history_all": lambda: history.product_history_with_none(
            users, tags, tables.products
        ),
        "g_aisle_history": lambda: history.aisle_history(users, tables.products),
        "t1_product_training": lambda: training.product_training(
            pairs, tables.products, q.MIN_WORD_FREQ, q.NAME_LENGTH, q.SEQUENCE_LENGTH
        ),
        "t1_product_training_arrays": lambda: training.product_training(
            typed_pairs, tables.products, q.MIN_WORD_FREQ, q.NAME_LENGTH, q.SEQUENCE_LENGTH
        ),
        "t1_product_training_of_users": lambda: training.product_training_of_users(
            typed_users, tags, tables.products, q.MIN_WORD_FREQ, q.NAME_LENGTH, q.SEQUENCE_LENGTH
        ),
        "t2b_reorder_size_training": lambda: training.reorder_size_training(
            users, q.SEQUENCE_LENGTH
        ),
        "t4_aisle_training": lambda: training.aisle_training(aisles, q.AISLE_LENGTH),
        "v1_word_index": lambda: vocabulary.word_index(documents, q.MIN_DOCUMENT_WORD_FREQ),
    }
    seconds = {}
    for name, build in headline.items():
        timed(build)
        seconds[name] = round(statistics.median(timed(build) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "setup_sec": round(setup, 1),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
