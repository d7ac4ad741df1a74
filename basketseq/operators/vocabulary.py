"""Word index over product names and the encoding of names with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketseq.operators.ranking import rank_in_ranges
from basketseq.sources.shared import materialise

# The lower 32 bits of a packed word, and what makes any int fit them unsigned.
_MASK, _HALF = (1 << 32) - 1, 1 << 31


def words(text: Column) -> Column:
    """Lower-case words split at white space; only spaces are trimmed."""
    return F.split(F.trim(F.lower(text)), r"\s+")


def word_counts(texts: DataFrame, text_column: str = "product_name") -> DataFrame:
    """(word, word_count): occurrences, counted before and after the shuffle."""
    return (
        texts.select(F.explode(words(F.col(text_column))).alias("word"))
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("word_count"))
    )


def word_index(
    texts: DataFrame, min_word_freq: int = 5, text_column: str = "product_name"
) -> DataFrame:
    """(word, word_idx): ids from 1 by falling count, then by word; rare words 0.

    The counts are written once: the frequent words are ranked range by range, the
    rare ones pass by. No size is measured; one plan serves all vocabularies.
    """
    counts = materialise(word_counts(texts, text_column), "word-counts")
    is_frequent = F.col("word_count") >= min_word_freq
    order = [F.desc("word_count"), F.asc("word")]
    frequent = rank_in_ranges(counts.where(is_frequent), order, "word_idx")
    rare = counts.where(~is_frequent).select("word", F.lit(0).alias("word_idx"))
    return frequent.select("word", F.col("word_idx").cast("int")).unionByName(rare)


def name_tokens(products: DataFrame, text_column: str = "product_name") -> DataFrame:
    """(product_id, word_pos, word): one row per word, and one without a word
    for each product whose name has none."""
    split_name = F.posexplode_outer(words(F.col(text_column))).alias("word_pos", "word")
    return products.select("product_id", split_name).withColumn(
        "word", F.nullif("word", F.lit(""))
    )


def encode_names(
    products: DataFrame, index: DataFrame, text_column: str = "product_name"
) -> DataFrame:
    """(product_id, product_name_encoded): word ids in name order, as text.

    Words outside the index leave no id; a name without words is "0". Catalyst and
    AQE go by the index's size, and a shuffled join splits frequent words.
    """
    tokens = name_tokens(products, text_column).join(index, "word", "left")
    # Position and id as one number, in the order of the pair: a collected struct takes
    # four times its bytes, in the shuffle and where the aggregation sorts its buffers.
    place = F.shiftleft(F.col("word_pos").cast("bigint"), 32)
    packed = place + F.col("word_idx").cast("int").cast("bigint") + F.lit(_HALF)
    packed_tokens = tokens.select(
        "product_id",
        packed.alias("packed"),
        F.col("word").isNotNull().alias("is_word"),
        (F.coalesce("word_pos", F.lit(0)) == 0).alias("is_first"),
    )
    encoded = packed_tokens.groupBy("product_id").agg(
        F.sort_array(F.collect_list("packed")).alias("packed"),
        F.count_if("is_word").alias("n_words"),
        # A product listed twice stays listed twice.
        F.count_if("is_first").alias("n_rows"),
    )
    ids = F.array_join(
        F.transform("packed", lambda one: one.bitwiseAND(F.lit(_MASK)) - F.lit(_HALF)).cast(
            "array<string>"
        ),
        " ",
    )
    return encoded.select(
        "product_id",
        F.when(F.col("n_words") == 0, "0").otherwise(ids).alias("product_name_encoded"),
        F.explode(F.array_repeat(F.lit(0), F.col("n_rows").cast("int"))).alias("copy"),
    ).drop("copy")
