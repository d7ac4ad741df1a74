"""Mixing sources to target weights, in words.

Sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and share
``share`` times the words there are. No source gives more than ``most`` times
its words; what that leaves over goes to the others by weight, until none is
above its limit (water filling: target = min(most * words, level * weight)).

The documents of a source get hash-random keys and are range-sorted by them;
distributed prefix sums of the word counts say where each begins. A source with
a budget of e times its words plus a rest takes every document e times and, in
one more epoch, the documents before the rest's end. The one that the end falls
into is cut there, so a source's words are its budget exactly (the target
rounded down), and no document is taken more than ``most`` times over.

Defined results: a null text has no words, and its document takes none. A source
without words has the target 0. A null source is a source of its own. Keys
depend on id and text alone, so reruns agree; repeated rows share a key and lie
next to each other, and which of them is cut makes no difference to the rows
that come out. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketseq.llm.prefix_sums import sums_before
from basketseq.llm.scratch import Scratch
from basketseq.operators.ranking import rank_in_ranges

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    scratch: Scratch,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """(source, source_size, weight, target) of a table (source, source_size)."""
    ranked = rank_in_ranges(sizes, [F.col("source").asc_nulls_last()], "place")
    cycle = F.array(*(F.lit(w) for w in weights))
    weighted = ranked.select(
        "source",
        "source_size",
        F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int"))
        .cast("long")
        .alias("weight"),
    ).withColumn("cap", F.col("source_size") * most)
    # In this order the sources at their limit come first.
    order = [
        (F.col("cap") / F.col("weight")).asc(),
        F.col("source").asc_nulls_last(),
    ]
    lined = sums_before(
        weighted, None, order, {"cap_before": "cap", "weight_before": "weight"}, scratch
    )
    whole = weighted.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.sum("weight").alias("weight")
    ).first()
    # Given that all before it are at their limit; the highest that holds is the level.
    pool = F.lit(whole["words"] * float(share))
    at = (pool - F.col("cap_before")) / (F.lit(whole["weight"]) - F.col("weight_before"))
    level = (
        lined.select(at.alias("level"), "weight", "cap")
        .where("level * weight <= cap")
        .agg(F.max("level"))
        .first()[0]
    )
    return weighted.select(
        "source",
        "source_size",
        "weight",
        F.least(
            F.col("cap").cast("double"), F.lit(float(level or 0)) * F.col("weight")
        ).alias("target"),
    )


def mixed_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep_rows: bool = False,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document, and ``row``, the
    document as a struct, if ``keep_rows``."""
    scratch = Scratch(docs.sparkSession, "mixing")
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col).cast("string"), F.md5(text)))
    sized, _ = scratch.write(
        docs.select(
            F.monotonically_increasing_id().alias("at"),
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            n_words(F.col(text_col)).alias("size"),
            key.alias("mix_key"),
            *([F.struct(*docs.columns).alias("row")] if keep_rows else []),
        ),
        "sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets, _ = scratch.write(source_targets(sizes, scratch, weights, share, most), "targets")
    lined = sums_before(
        sized.select("at", "doc_id", "source", "size", "mix_key"),
        "source",
        [F.col("mix_key"), F.col("doc_id"), F.col("size")],
        {"begin": "size"},
        scratch,
    )
    named = targets.withColumnRenamed("source", "target_source")
    epochs = F.expr("CASE WHEN source_size > 0 THEN floor(target) DIV source_size ELSE 0 END")
    rest = F.floor("target") - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("begin")))
    taken = lined.join(named, F.col("source").eqNullSafe(F.col("target_source"))).select(
        "at",
        "doc_id",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + last).cast("long").alias("taken"),
    )
    # Texts move once, after all else is decided.
    return (taken.join(sized.select("at", "row"), "at") if keep_rows else taken).drop("at")


def mixed_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: a row of ``docs`` for each time it is taken, the last one cut
    to the words that are taken of it. Documents without words are left out, since
    they add nothing to any source; so are those beyond the budget."""
    taken = mixed_words(docs, text_col=text_col, keep_rows=True, **options).where("taken > 0")
    copies = F.expr("sequence(cast(0 as bigint), (taken - 1) DIV size)")
    one = taken.select("row", "size", "taken", F.explode(copies).alias("epoch"))
    words = F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size"))
    whole = F.col("row").getField(text_col)
    # Each word with the white space before it, so that the cut text is a piece of the whole.
    pieces = F.regexp_extract_all(whole, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    text = F.when(words == F.col("size"), whole).otherwise(
        F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")
    )
    columns = [
        text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns
    ]
    return one.select(*columns)
