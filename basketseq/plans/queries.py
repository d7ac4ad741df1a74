"""The registered queries: one per operator of the feature pipeline.

Every query starts from the star-schema tables. The model has items of prior and
train orders only (as a source of two item files has), so item rows of test orders
take no part; ``a3_user_sequences_with_test`` takes them in as well.
Array results are emitted as text so that they compare across engines.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketseq import schemas
from basketseq.functions import cleaning
from basketseq.functions.sequences import encode_flat, encode_nested, pad, padded_length, parse_flat
from basketseq.operators import (
    baskets,
    diagnostics,
    enrich,
    history,
    incremental,
    parsing,
    reorder_size,
    sampling,
    training,
    vocabulary,
)
from basketseq.operators.ranking import rank_in_ranges
from basketseq.plans import jobs
from basketseq.sources import files, star_schema
from basketseq.sources.shared import materialise, new_folder

# Parameters of the registered queries, shared with their SQL.
MIN_WORD_FREQ = 256
MIN_DOCUMENT_WORD_FREQ = 10
NAME_LENGTH = 30
SEQUENCE_LENGTH = 100
AISLE_LENGTH = 30
SHORT_LENGTH = 7
SAMPLE_USERS = 50
SAMPLE_SEED = 7872

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


class Model:
    """The pipeline's frames over one folder of tables, built when asked for."""

    def __init__(
        self, spark: SparkSession, folder: str, test_items: bool = False, stored: bool = False
    ):
        """``stored``: orders and items are written first, for queries that read the
        items several times; a task then holds no sorted rows of several joins."""
        self.spark, self.folder, self.test_items = spark, folder, test_items
        self.derive = star_schema.stored_tables if stored else star_schema.star_schema_tables

    @functools.cached_property
    def tables(self) -> files.SourceTables:
        return self.derive(self.spark, self.folder, self.test_items)

    @property
    def orders(self) -> DataFrame:
        return star_schema.orders_model(self.spark, self.folder)

    @property
    def products(self) -> DataFrame:
        return star_schema.products_model(self.spark, self.folder)

    @property
    def documents(self) -> DataFrame:
        return files.read_parquet(self.spark, files.child(self.folder, "documents.parquet")).select(
            F.col("doc_id").alias("product_id"), F.col("text").alias("product_name")
        )

    @functools.cached_property
    def items(self) -> DataFrame:
        return enrich.all_items(self.tables.prior, self.tables.train)

    @functools.cached_property
    def baskets(self) -> DataFrame:
        return baskets.order_baskets(enrich.enriched_items(self.tables))

    @functools.cached_property
    def users(self) -> DataFrame:
        return baskets.user_sequences(self.baskets)

    @functools.cached_property
    def users_text(self) -> DataFrame:
        return baskets.sequence_text(self.users)

    @functools.cached_property
    def tags(self) -> DataFrame:
        return files.split_tags(self.orders)

    @functools.cached_property
    def product_history(self) -> DataFrame:
        return history.product_history(self.users, self.tags, self.products)

    @functools.cached_property
    def none_history(self) -> DataFrame:
        return history.none_history(self.users, self.tags)

    @functools.cached_property
    def aisle_history(self) -> DataFrame:
        return history.aisle_history(self.users, self.products)


def arrays_as_text(df: DataFrame) -> DataFrame:
    """Every array column as text, nested ones order by order."""
    texts = {}
    for name, dtype in df.dtypes:
        if dtype.startswith("array<array"):
            texts[name] = encode_nested(F.col(name))
        elif dtype.startswith("array"):
            texts[name] = encode_flat(F.col(name))
    return df.withColumns(texts) if texts else df


def _state(spark: SparkSession, folder: str) -> tuple:
    """The session, and the files below the model with their sizes and times: what
    is cached for one state serves no other."""
    files_found = []
    for name in ("orders", "lineitem", "part"):
        path = spark._jvm.org.apache.hadoop.fs.Path(files.child(folder, f"{name}.parquet"))
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in system.listStatus(path):
            files_found.append(
                (status.getPath().toString(), status.getLen(), status.getModificationTime())
            )
    return spark.sparkContext.applicationId, tuple(files_found)


@functools.cache
def _csv_source(state: tuple, spark: SparkSession, folder: str) -> str:
    """The six source tables as CSV below the shared folder, written once. Orders and
    items are derived once and stored, not again for each table made from them."""
    target = new_folder(spark, "csv")
    tables = star_schema.stored_tables(spark, folder)
    frames = {
        "orders": tables.orders,
        "products": tables.products,
        "order_products__prior": tables.prior,
        "order_products__train": tables.train,
        "aisles": star_schema.aisles_model(tables.products),
        "departments": star_schema.departments_model(tables.products),
    }
    for name, frame in frames.items():
        files.write_csv(frame, files.child(target, f"{name}.csv"))
    return target


@functools.cache
def _bronze(state: tuple, spark: SparkSession, folder: str) -> str:
    target = new_folder(spark, "bronze")
    files.ingest_csv_tables(spark, csv_source(spark, folder), target)
    return target


@functools.cache
def _job_tables(state: tuple, spark: SparkSession, folder: str) -> str:
    """Runs the stored-table jobs in order: text tables throughout."""
    raw, out = bronze(spark, folder), new_folder(spark, "jobs")
    jobs.build_order_products(spark, raw, out, check_joins=True)
    jobs.build_user_data(
        spark, files.child(out, "order_products"), files.child(out, "user_data")
    )
    jobs.build_product_history(spark, out, raw, files.child(out, "product_history_data"))
    jobs.build_aisle_history(spark, out, raw, out)
    jobs.build_product_training(spark, raw, out, out, MIN_WORD_FREQ, NAME_LENGTH, SEQUENCE_LENGTH)
    jobs.build_aisle_training(spark, out, out, AISLE_LENGTH)
    jobs.build_reorder_size_training(spark, out, out, SEQUENCE_LENGTH)
    return out


def csv_source(spark: SparkSession, folder: str) -> str:
    return _csv_source(_state(spark, folder), spark, folder)


def bronze(spark: SparkSession, folder: str) -> str:
    return _bronze(_state(spark, folder), spark, folder)


def job_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    tables = _job_tables(_state(spark, folder), spark, folder)
    return files.read_parquet(spark, files.child(tables, name))


# --- scans, sinks, ingest ---------------------------------------------------


@query
def s1_csv_scan(spark, folder):
    path = files.child(csv_source(spark, folder), "orders.csv")
    return files.read_csv(spark, path, schemas.ORDERS)


@query
def s2_parquet_scan(spark, folder):
    return Model(spark, folder).products


@query
def s3_parquet_sink(spark, folder):
    path = new_folder(spark, "products")
    files.write_parquet(Model(spark, folder).products, path)
    return files.read_parquet(spark, path)


@query
def s4_typed_ingest(spark, folder):
    """All values of the six tables, one row of text each."""
    target = bronze(spark, folder)
    return _values(
        {t: files.read_parquet(spark, files.child(target, t)) for t in schemas.SOURCE_TABLES}
    )


def _values(tables: dict[str, DataFrame]) -> DataFrame:
    """(dataset, row_values): every row of several tables as text."""
    parts = [
        table.select(
            F.lit(name).alias("dataset"),
            F.concat_ws(
                "|",
                *[
                    # Gaps are whole days; doubles print differently per engine.
                    F.coalesce(
                        (F.col(c).cast("bigint") if t == "double" else F.col(c)).cast("string"),
                        F.lit("-"),
                    )
                    for c, t in table.dtypes
                ],
            ).alias("row_values"),
        )
        for name, table in tables.items()
    ]
    return functools.reduce(DataFrame.unionAll, parts)


@query
def s5_source_tables(spark, folder):
    tables = files.load_source_tables(spark, bronze(spark, folder))
    return enrich.joined_items(tables)


@query
def s6_split_tags(spark, folder):
    return Model(spark, folder).tags


@query
def s4_quarantined_rows(spark, folder):
    """Prior items as CSV with planted rows: a tenth has a cell too many, a tenth one too
    few. Whole rows are ingested, the others kept aside as text."""
    source, target = new_folder(spark, "ragged"), new_folder(spark, "ragged-bronze")
    prior = Model(spark, folder).tables.prior
    cells = F.concat_ws(",", *(F.col(c).cast("string") for c in prior.columns[:-1]))
    last = F.col(prior.columns[-1]).cast("string")
    line = (
        F.when(F.col("order_id") % 10 == 0, F.concat_ws(",", cells, last, F.lit("9")))
        .when(F.col("order_id") % 10 == 1, cells)
        .otherwise(F.concat_ws(",", cells, last))
    )
    # Every file has to begin with the header.
    lines = prior.select(line.alias(",".join(prior.columns)))
    lines.write.option("header", True).option("quoteAll", False).option("quote", "").csv(
        files.child(source, "order_products__prior.csv"), sep="\t"
    )
    files.ingest_csv_tables(
        spark,
        source,
        target,
        {"order_products__prior": schemas.ORDER_PRODUCTS},
        on_ragged_rows="quarantine",
    )
    kept = files.read_parquet(spark, files.child(target, "_quarantine/order_products__prior"))
    whole = files.read_parquet(spark, files.child(target, "order_products__prior"))
    return kept.select(F.lit("quarantine").alias("dataset"), "row_text").unionAll(
        whole.select(
            F.lit("bronze"), F.concat_ws(",", *(F.col(c).cast("string") for c in whole.columns))
        )
    )


# --- cleaning ---------------------------------------------------------------


@query
def c1_fill_and_cast(spark, folder):
    orders = Model(spark, folder).orders.select(
        "order_id", F.col("days_since_prior_order").cast("int").cast("string").alias("gap")
    )
    return cleaning.fill_and_cast(orders, "gap", -1, "int")


@query
def c2_fill_gaps(spark, folder):
    orders = Model(spark, folder).orders.select("order_id", "days_since_prior_order")
    return cleaning.fill_gaps(orders, enrich.NULLABLE)


@query
def c7_name_words(spark, folder):
    tokens = vocabulary.name_tokens(Model(spark, folder).products)
    return tokens.where(F.col("word").isNotNull())


@query
def c8_frequent_words(spark, folder):
    counts = vocabulary.word_counts(Model(spark, folder).documents)
    return counts.where(F.col("word_count") >= MIN_DOCUMENT_WORD_FREQ)


# --- joins ------------------------------------------------------------------


@query
def j1_items_orders(spark, folder):
    model = Model(spark, folder)
    return enrich.with_orders(model.items, model.tables.orders)


@query
def j2_items_products(spark, folder):
    return enrich.joined_items(Model(spark, folder).tables)


@query
def j3_user_tags(spark, folder):
    model = Model(spark, folder)
    users = model.users.select("user_id", "eval_set")
    return users.join(model.tags, "user_id", "left")


@query
def j4_pair_products(spark, folder):
    return Model(spark, folder).product_history.select(
        "user_id", "product_id", "aisle_id", "department_id", "product_name"
    )


@query
def j5_aisle_fan_out(spark, folder):
    mixed = star_schema.products_with_mixed_aisles(spark, folder)
    return history.aisle_history(Model(spark, folder).users, mixed)


@query
def j6_token_ids(spark, folder):
    products = Model(spark, folder).products
    index = vocabulary.word_index(products, MIN_WORD_FREQ).where("word_idx > 0")
    tokens = vocabulary.name_tokens(products).where(F.col("word").isNotNull())
    return tokens.join(index, "word", "left")


@query
def j7_document_words(spark, folder):
    """Documents as names, frequent words only as index, no broadcast."""
    documents = Model(spark, folder).documents
    index = vocabulary.word_index(documents, MIN_DOCUMENT_WORD_FREQ)
    return vocabulary.encode_names(documents, index.where("word_idx > 0"))


@query
def j8_named_histories(spark, folder):
    model = Model(spark, folder)
    pairs = history.product_history_with_none(model.users, model.tags, model.products)
    table = training.product_training(
        pairs, model.products, MIN_WORD_FREQ, NAME_LENGTH, SEQUENCE_LENGTH
    )
    return arrays_as_text(
        table.select("user_id", "product_id", "product_name_encoded", "product_name_length")
    )


# --- baskets and sequences --------------------------------------------------


@query
def a1_order_sequences(spark, folder):
    return baskets.basket_text(Model(spark, folder).baskets)


@query
def a2_order_metadata(spark, folder):
    return Model(spark, folder).baskets.select(
        "user_id",
        "order_id",
        "order_number",
        "order_dow",
        "order_hour",
        "days_since_prior_order",
        "eval_set",
    )


@query
def a3_user_sequences(spark, folder):
    return Model(spark, folder).users_text


@query
def a3_incremental_users(spark, folder):
    """Half of the orders first, then the rest in three batches, whatever their age."""
    path = files.child(new_folder(spark, "users"), "user_data")
    items = enrich.enriched_items(star_schema.stored_tables(spark, folder))
    batch = F.pmod(F.xxhash64("order_id"), F.lit(6))
    first = baskets.order_baskets(items.where(batch >= 3))
    incremental.build_users(baskets.user_sequences(first), path, n_buckets=16)
    for number in range(3):
        incremental.merge_orders(spark, path, items.where(batch == number))
    return baskets.sequence_text(incremental.read_users(spark, path))


@query
def a3_user_sequences_with_test(spark, folder):
    """Test orders with items: they are the target, and their split is known."""
    model = Model(spark, folder, test_items=True)
    return model.users_text.select("user_id", "order_ids", "product_ids", "reorders", "eval_set")


@query
def a4_declared_target(spark, folder):
    """The tagged order is the target also where it has no items."""
    model = Model(spark, folder, stored=True)
    # Read twice: as they are, and for the tagged orders that are not among them.
    stored = materialise(model.baskets, "baskets")
    users = baskets.user_sequences(baskets.declared_targets(stored, model.tables.orders))
    return baskets.sequence_text(users).select("user_id", "order_ids", "product_ids", "eval_set")


@query
def a4_last_eval_set(spark, folder):
    return Model(spark, folder).users.select("user_id", "eval_set")


@query
def a5_word_count(spark, folder):
    return vocabulary.word_counts(Model(spark, folder).documents)


@query
def a7_aisle_departments(spark, folder):
    return history.aisle_departments(Model(spark, folder).products)


@query
def a8_row_counts(spark, folder):
    tables = Model(spark, folder, stored=True).tables
    return enrich.row_counts(
        order_products=enrich.all_items(tables.prior, tables.train),
        order_prior=tables.prior,
        order_train=tables.train,
        joined=enrich.joined_items(tables),
    )


@query
def w1_word_rank(spark, folder):
    counts = vocabulary.word_counts(Model(spark, folder).documents)
    frequent = counts.where(F.col("word_count") >= MIN_DOCUMENT_WORD_FREQ)
    return rank_in_ranges(frequent, [F.desc("word_count"), F.asc("word")], "word_rank")


@query
def o3_union_items(spark, folder):
    return Model(spark, folder).items


@query
def o4_product_history_all(spark, folder):
    model = Model(spark, folder)
    return history.product_history_with_none(model.users, model.tags, model.products)


@query
def o6_order_overlaps(spark, folder):
    pairs = Model(spark, folder).product_history
    return pairs.select("user_id", "history_reorder_size").distinct()


# --- sequence operators -----------------------------------------------------


@query
def q1_parse_nested(spark, folder):
    users = Model(spark, folder).users_text.select("user_id", "product_ids")
    return arrays_as_text(
        parsing.parse_orders(users, "product_ids", "products", True, item_type="bigint")
    )


@query
def q2_parse_aisles(spark, folder):
    users = Model(spark, folder).users_text.select("user_id", "aisle_ids")
    return arrays_as_text(parsing.parse_aisles(users))


@query
def q3_parse_flat(spark, folder):
    users = Model(spark, folder).users_text
    parsed = users.select("user_id", parse_flat(F.col("days_since_prior_orders")).alias("gaps"))
    total = F.aggregate("gaps", F.lit(0).cast("bigint"), lambda a, gap: a + gap)
    return parsed.select(
        "user_id", F.size("gaps").alias("n_gaps"), total.alias("total"), encode_flat(F.col("gaps")).alias("gaps")
    )


@query
def q4_pad(spark, folder):
    numbers = F.col("order_numbers")
    return Model(spark, folder).users.select(
        "user_id",
        encode_flat(pad(numbers, SHORT_LENGTH)).alias("padded"),
        padded_length(numbers, SHORT_LENGTH).alias("true_length"),
    )


@query
def q4_pad_last(spark, folder):
    numbers = F.col("order_numbers")
    return Model(spark, folder).users.select(
        "user_id", encode_flat(pad(numbers, SHORT_LENGTH, keep="last")).alias("padded")
    )


@query
def p1_history_order_size(spark, folder):
    return Model(spark, folder).product_history.select(
        "user_id", "product_id", "history_order_size"
    )


@query
def p3_pair_labels(spark, folder):
    return Model(spark, folder).product_history.select("user_id", "product_id", "label")


@query
def p4_is_ordered(spark, folder):
    return Model(spark, folder).product_history.select(
        "user_id", "product_id", "is_ordered_history"
    )


@query
def p5_position(spark, folder):
    return Model(spark, folder).product_history.select(
        "user_id", "product_id", "position_in_order_history"
    )


@query
def p_product_history(spark, folder):
    return Model(spark, folder).product_history


@query
def p_product_history_spread(spark, folder):
    """Every user on the path for large users."""
    model = Model(spark, folder)
    return history.product_history(
        model.users, model.tags, model.products, large_user_items=0
    )


@query
def g_aisle_history_spread(spark, folder):
    model = Model(spark, folder)
    return history.aisle_history(model.users, model.products, large_user_items=0)


@query
def g_mixed_aisles(spark, folder):
    return history.mixed_aisles(star_schema.products_with_mixed_aisles(spark, folder))


@query
def n_none_history(spark, folder):
    return Model(spark, folder).none_history


@query
def g_aisle_history(spark, folder):
    return Model(spark, folder).aisle_history


@query
def r_reorder_size(spark, folder):
    """From the stored text form."""
    sizes = reorder_size.reorder_size(Model(spark, folder).users_text)
    return arrays_as_text(
        sizes.select(
            "user_id", "reorders_prev", "reorders_next", "order_sizes", "reorder_sizes", "label"
        )
    )


# --- vocabulary -------------------------------------------------------------


@query
def v1_word_index(spark, folder):
    return vocabulary.word_index(Model(spark, folder).products, MIN_WORD_FREQ)


@query
def v1_document_word_index(spark, folder):
    return vocabulary.word_index(Model(spark, folder).documents, MIN_DOCUMENT_WORD_FREQ)


@query
def v2_encode_names(spark, folder):
    products = Model(spark, folder).products
    index = vocabulary.word_index(products, MIN_WORD_FREQ)
    return vocabulary.encode_names(products, index)


# --- training tables --------------------------------------------------------


@query
def t1_product_training(spark, folder):
    model = Model(spark, folder)
    return arrays_as_text(
        training.product_training_of_users(
            model.users, model.tags, model.products, MIN_WORD_FREQ, NAME_LENGTH, SEQUENCE_LENGTH
        )
    )


@query
def t2_pad_reorder_sizes(spark, folder):
    sizes = reorder_size.reorder_size(Model(spark, folder).users)
    padded = training.pad_reorder_sizes(sizes, SHORT_LENGTH)
    return arrays_as_text(
        padded.select("user_id", *schemas.TEMPORAL, "order_sizes", "reorder_sizes", "history_length")
    )


@query
def t2b_reorder_size_training(spark, folder):
    users = Model(spark, folder).users
    return arrays_as_text(training.reorder_size_training(users, SEQUENCE_LENGTH))


@query
def t4_aisle_training(spark, folder):
    model = Model(spark, folder)
    pairs = history.aisle_history(model.users, model.products, as_text=False)
    return arrays_as_text(training.aisle_training(pairs, AISLE_LENGTH))


# --- the stored-table jobs, end to end --------------------------------------


@query
def u1_user_data(spark, folder):
    return job_table(spark, folder, "user_data")


@query
def u2_order_products(spark, folder):
    return job_table(spark, folder, "order_products")


@query
def u3_product_history_data(spark, folder):
    return job_table(spark, folder, "product_history_data")


@query
def u4_aisle_history_data(spark, folder):
    return job_table(spark, folder, "aisle_history_data")


@query
def u5_product_training_data(spark, folder):
    return arrays_as_text(job_table(spark, folder, "product_training_data"))


@query
def u6_aisle_training_data(spark, folder):
    return arrays_as_text(job_table(spark, folder, "aisle_training_data"))


@query
def u7_reorder_size_training_data(spark, folder):
    return arrays_as_text(job_table(spark, folder, "reorder_size_training_data"))


# --- sampling ---------------------------------------------------------------


def _sampled_users(model: Model) -> DataFrame:
    return sampling.sample_users(model.orders, SAMPLE_USERS, SAMPLE_SEED)


@query
def m1_user_count(spark, folder):
    return sampling.user_count(Model(spark, folder).orders)


@query
def m2_sample_users(spark, folder):
    return _sampled_users(Model(spark, folder))


@query
def m3_sampled_orders(spark, folder):
    model = Model(spark, folder)
    return sampling.orders_of_users(model.orders, _sampled_users(model))


@query
def m4_sampled_items(spark, folder):
    model = Model(spark, folder)
    orders = sampling.orders_of_users(model.orders, _sampled_users(model))
    return sampling.items_of_orders(model.items, orders)


@query
def m5_sampled_dataset(spark, folder):
    """All values of the six tables the sampling job writes."""
    target = new_folder(spark, "sample")
    sampling.sample_dataset(spark, csv_source(spark, folder), target, SAMPLE_USERS, SAMPLE_SEED)
    return _values(
        {
            t: files.read_csv(spark, files.child(target, f"{t}.csv"), schema)
            for t, schema in schemas.SOURCE_TABLES.items()
        }
    )


# --- diagnostics ------------------------------------------------------------


@query
def d1_join_counts(spark, folder):
    tables = Model(spark, folder, stored=True).tables
    return enrich.join_counts(
        enrich.joined_items(tables), enrich.all_items(tables.prior, tables.train)
    )


@query
def d1_checked_write(spark, folder):
    """Both counts come from the run that wrote the table."""
    path = files.child(new_folder(spark, "checked"), "order_products")
    counts = enrich.write_enriched_items(Model(spark, folder).tables, path)
    stored = files.read_parquet(spark, path).agg(F.count(F.lit(1)).alias("stored_count"))
    return stored.select(
        *(F.lit(n).cast("bigint").alias(name) for name, n in counts.items()), "stored_count"
    )


@query
def d2_partition_distribution(spark, folder):
    """What holds for any layout: all rows are counted, each partition once."""
    layout = diagnostics.partition_distribution(Model(spark, folder).baskets)
    return layout.agg(
        F.sum("row_count").alias("n_rows"),
        (F.count_distinct("partition_id") == F.count("partition_id")).alias("ids_differ"),
        (F.min("row_count") > 0).alias("all_filled"),
    )


@query
def d3_partition_summary(spark, folder):
    """Of baskets dealt out by a known rule: odd and even orders, six partitions empty."""
    known = Model(spark, folder).baskets.select("order_id").repartitionById(
        8, F.pmod("order_id", F.lit(2)).cast("int")
    )
    return diagnostics.partition_summary(known)
