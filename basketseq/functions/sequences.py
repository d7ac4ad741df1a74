"""Column helpers for nested, flat and fixed-length integer sequences.

Inside the library a sequence is a typed array. The text form ("1_2 3" for two
orders) exists only in stored tables; ``parse_*`` and ``encode_*`` cross that
boundary. Parsing casts tokens with ``try_cast``, so a token that is not an
integer becomes a null element, also under ANSI mode.

Flat texts are cast token by token in ``transform``: casts of whole arrays, many
columns at once, make one generated method so long that it is compiled late or not
at all, and its loops over the tokens stay interpreted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType


def empty_array(item_type: str = "int") -> Column:
    return F.array().cast(f"array<{item_type}>")


def parse_flat(text: Column, separator: str = r"\s+", item_type: str = "int") -> Column:
    """``" 4  5 "`` -> ``[4, 5]``; null and blank text give an empty array."""
    stripped = F.trim(text)
    tokens = F.split(stripped, separator)
    return F.when(
        F.length(stripped) > 0, F.transform(tokens, lambda token: token.try_cast(item_type))
    ).otherwise(empty_array(item_type))


def parse_nested(text: Column, item_type: str = "int") -> Column:
    """``"1_2 3"`` -> ``[[1, 2], [3]]``, one inner array per order."""
    return F.transform(
        F.split(text, " "), lambda order: F.split(order, "_").try_cast(f"array<{item_type}>")
    )


def encode_flat(values: Column) -> Column:
    """``[4, 5]`` -> ``"4 5"``; null elements leave no token."""
    return F.array_join(values.cast("array<string>"), " ")


def encode_nested(orders: Column) -> Column:
    """``[[1, 2], [3]]`` -> ``"1_2 3"``; null elements leave no token."""
    return F.array_join(
        F.transform(orders, lambda order: F.array_join(order.cast("array<string>"), "_")), " "
    )


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def nested_column(df: DataFrame, name: str, item_type: str = "int") -> Column:
    """The column as array of arrays, whichever form the table stores.

    Text is read as bigint first: an integer too wide for ``item_type`` then fails
    the cast (ANSI mode) instead of passing for a token that is no integer.
    """
    if not is_text(df, name):
        return F.col(name)
    return parse_nested(F.col(name), "bigint").cast(f"array<array<{item_type}>>")


def flat_column(df: DataFrame, name: str, item_type: str = "int") -> Column:
    """The column as flat array, whichever form the table stores; null is empty."""
    if is_text(df, name):
        return parse_flat(F.col(name), item_type=item_type)
    return F.coalesce(name, F.array().cast(df.schema[name].dataType))


def before_last(orders: Column) -> Column:
    """All orders but the last; empty for an empty array."""
    return F.slice(orders, F.lit(1), F.greatest(F.size(orders) - 1, F.lit(0)))


def pad(values: Column, length: int, keep: str = "first") -> Column:
    """Exactly ``length`` elements with zeros behind: of longer sequences the
    oldest are kept, or with ``keep="last"`` the newest."""
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    zeros = F.array_repeat(F.lit(0), length)
    if keep == "last":
        start = F.greatest(F.size(values) - length, F.lit(0)) + 1
        values = F.slice(values, start, F.lit(length))
    return F.slice(F.concat(values, zeros), 1, length)


def padded_length(values: Column, length: int) -> Column:
    """How many elements of ``pad(values, length)`` are not padding."""
    return F.least(F.coalesce(F.size(values), F.lit(0)), F.lit(length)).cast("int")


def scatter_sql(visits: str, n_orders: str, field: str) -> str:
    """SQL that spreads sparse visits over a dense array of ``n_orders``.

    ``visits`` names an array of structs with an ascending, unique, 1-based
    ``idx``. Orders without a visit hold 0. The work follows the number of
    visits: gaps come from ``array_repeat``, not from a loop over orders.
    """
    before = f"coalesce(get({visits}, nth - 1).idx, 0)"
    last = f"coalesce(get({visits}, size({visits}) - 1).idx, 0)"
    piece = f"concat(array_repeat(0, one.idx - {before} - 1), array(int(one.{field})))"
    return (
        f"concat(flatten(transform({visits}, (one, nth) -> {piece})), "
        f"array_repeat(0, {n_orders} - {last}))"
    )


def flag_sum(flags: Column) -> Column:
    """Sum of a flag array, as bigint."""
    return F.aggregate(flags, F.lit(0).cast("bigint"), lambda total, flag: total + flag)
