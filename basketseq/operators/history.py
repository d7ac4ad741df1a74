"""Purchase histories: one row per (user, product), (user, aisle) and "None".

The last order of a sequence is the target, the orders before it are the
history. Every row follows from the user's own row, so beyond the join with
the split tags nothing is shuffled, except for large users, and for products
too many to broadcast: usual users then get their products' rows (``lookups``)
before they become pairs.

* Usual users: their keys are exploded and each key is looked up in every past
  basket, one native array search per order.
* Large users, for whom keys times items would explode: the baskets become one
  sorted array of (key, order, ...) visits, runs of equal keys become the
  pairs, and ``scatter`` spreads a pair's few visits over the orders. That is
  linear in the items (times a log). Their pairs are cut into chunks which are
  spread over the cluster before they are expanded, so no task writes all rows
  of a very active user.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from basketseq import schemas
from basketseq.functions.sequences import (
    before_last,
    empty_array,
    encode_flat,
    flag_sum,
    flat_column,
    is_text,
    nested_column,
    pad,
    scatter_sql,
)
from basketseq.operators.lookups import found_by_user, is_broadcast, is_same_user
from basketseq.sources.shared import materialise

# Default of ``large_user_items``: users with more items than this take the path
# for large users. Both paths give the same rows; the first is the faster one for
# short histories, the second is linear in the items.
LARGE_USER_ITEMS = 4_000
# Output cells (pairs x orders) of a large user one chunk of pairs may hold.
CELLS_PER_CHUNK = 4_000_000


# --- the two ways from users to pairs ---------------------------------------
#
# The array expressions are SQL text: one call to the JVM each, where column
# functions would take one per sub-expression.


@dataclass(frozen=True)
class PairKind:
    """What makes a pair: its key, and its sequences in both forms.

    ``prepared`` holds SQL over ``past``, computed once per user; ``looked_up`` SQL
    over ``past``, those and ``key``; ``visits`` the (key,
    idx, ...) structs of every past order, ``visited`` the visit fields to
    spread. The first sequence is the position, 0 where the key is absent.
    """

    sequence: str
    prepared: dict[str, str]
    looked_up: dict[str, str]
    visits: str
    visited: dict[str, str]


PRODUCTS = PairKind(
    sequence="product_ids",
    prepared={},
    # The index in the basket, of the first occurrence.
    looked_up={
        "position_in_order_history": "transform(past, b -> array_position(b, key))",
    },
    visits="""transform(past, (b, i) -> transform(b, (k, j) ->
        named_struct('key', k, 'idx', i + 1, 'position', j + 1)))""",
    visited={"position_in_order_history": "position"},
)
AISLES = PairKind(
    sequence="aisle_ids",
    # The rank by first appearance among the distinct aisles of the order, and the
    # items of the aisle, which stand at the same place.
    prepared={
        "ranked": "transform(past, b -> array_distinct(b))",
        "items_of_ranked": """transform(past, b -> transform(array_distinct(b),
            a -> size(b) - size(array_remove(b, a))))""",
    },
    looked_up={
        "position_in_order": "transform(ranked, r -> array_position(r, key))",
        "num_products_from_aisle": """zip_with(ranked, items_of_ranked,
            (r, n) -> coalesce(get(n, int(array_position(r, key)) - 1), 0))""",
    },
    visits="""transform(past, (b, i) -> transform(array_distinct(b), (k, j) ->
        named_struct('key', k, 'idx', i + 1, 'position', j + 1,
                     'items', size(b) - size(array_remove(b, k)))))""",
    visited={"position_in_order": "position", "num_products_from_aisle": "items"},
)


def _is_large(users: DataFrame, name: str, bound: int) -> Column:
    """Counts the items; stored text is not parsed for it."""
    items = (
        f"length({name}) - length(translate({name}, '_ ', '')) + 1"
        if is_text(users, name)
        else f"size(flatten({name}))"
    )
    return F.expr(f"coalesce({items} > {bound}, false)")


def _usual_pairs(
    users: DataFrame,
    carried: list[str],
    context: dict[str, Column],
    prepared: dict[str, str],
    has_found: bool,
) -> DataFrame:
    """``carried`` columns and ``key``, plus the baskets to look the key up in.

    With ``has_found`` the keys come from ``found``, and ``looked_up`` with them.
    """
    order_of_item = "flatten(transform(past, (b, i) -> array_repeat(i + 1, size(b))))"
    first_orders = "transform(keys, k -> get(order_of_item, int(array_position(items, k)) - 1))"
    # The outer form: a plain explode lets the optimizer infer a filter on the
    # keys and push it down with their whole expression copied into it.
    users = (
        users.selectExpr("*", "flatten(past) AS items", f"{order_of_item} AS order_of_item")
        .selectExpr("*", "array_distinct(items) AS keys")
        .selectExpr("*", f"{first_orders} AS first_orders")
        .withColumns(context | {name: F.expr(sql) for name, sql in prepared.items()})
    )
    passed_on = [*carried, "past", *prepared, "target"]
    if not has_found:
        return users.selectExpr(*passed_on, "explode_outer(keys) AS key").where("key IS NOT NULL")
    return users.selectExpr(*passed_on, "explode(found) AS one").selectExpr(
        *passed_on, "one.product_id AS key", "explode_outer(one.rows) AS looked_up"
    )


def _large_pairs(
    users: DataFrame, carried: list[str], context: dict[str, Column], visits: str
) -> DataFrame:
    """``carried`` columns, ``key``, ``n_history`` and the pair's ``visits``.

    Null keys sort first and equal the missing element before the first one,
    so they start no pair.
    """
    starts = """filter(sequence(0, greatest(size(visits) - 1, 0)),
        i -> NOT get(visits, i).key <=> get(visits, i - 1).key)"""
    pairs = """transform(starts, (start, j) ->
        slice(visits, start + 1, coalesce(get(starts, j + 1), size(visits)) - start))"""
    chunks = """transform(sequence(1, greatest(size(pairs), 1), per_chunk),
        first -> slice(pairs, first, per_chunk))"""
    # An order may hold a key twice: its first visit counts.
    first_visits = "filter(visits, (v, i) -> NOT v.idx <=> get(visits, i - 1).idx)"
    passed_on = [*carried, "target", "n_history"]
    return (
        users.selectExpr(
            "*",
            "size(past) AS n_history",
            f"sort_array(flatten({visits})) AS visits",
            f"int(greatest(floor({CELLS_PER_CHUNK} / greatest(size(past), 1)), 1)) AS per_chunk",
        )
        .selectExpr("*", f"{starts} AS starts")
        .selectExpr("*", f"{pairs} AS pairs")
        .selectExpr("*", "transform(pairs, p -> get(p, 0).idx) AS first_orders")
        .withColumns(context)
        .selectExpr(*passed_on, f"posexplode_outer({chunks}) AS (chunk, pairs)")
        .repartition("user_id", "chunk")
        .selectExpr(*passed_on, "explode_outer(pairs) AS visits")
        .where("size(visits) > 0")
        .selectExpr(
            *passed_on, "get(visits, 0).key AS key", f"{first_visits} AS visits"
        )
    )


def _pairs(
    users: DataFrame,
    kind: PairKind,
    keep: list[str],
    context: dict[str, Column],
    item_type: str,
    as_text: bool,
    large_user_items: int,
    lookup: DataFrame | None = None,
) -> DataFrame:
    """One row per user and key of the history.

    Holds the ``keep`` columns, ``context`` (computed once per user from
    ``past`` and ``first_orders``), ``key``, ``in_target``,
    ``is_ordered_history`` and the kind's sequences. A ``lookup`` by product_id
    adds its other columns, as a left join would.
    """
    carried = [*keep, *[name for name in context if name not in keep]]
    is_large = _is_large(users, kind.sequence, large_user_items)
    baskets = nested_column(users, kind.sequence, item_type).alias("baskets")
    apart = [
        "slice(baskets, 1, greatest(size(baskets) - 1, 0)) AS past",
        "try_element_at(baskets, -1) AS target",
    ]

    def parsed(some_users: DataFrame, *more: str) -> DataFrame:
        return some_users.select(*keep, *more, baskets).selectExpr(*keep, *more, *apart)

    def finished(pairs: DataFrame, sequences: dict[str, str]) -> DataFrame:
        position = next(iter(sequences))
        was_there = f"cast(cast({position} AS array<boolean>) AS array<int>)"
        typed = {"is_ordered_history": was_there, **{n: f"cast({n} AS array<int>)" for n in sequences}}
        form = "array_join(cast({} AS array<string>), ' ')" if as_text else "{}"
        return pairs.selectExpr(
            *carried,
            *looked_up,
            "key",
            "array_position(target, key) > 0 AS in_target",
            *[f"{sql} AS {name}" for name, sql in sequences.items()],
        ).selectExpr(
            *carried,
            *[f"{name}.*" for name in looked_up],
            "key",
            "in_target",
            *[f"{form.format(sql)} AS {name}" for name, sql in typed.items()],
        )

    looked_up = [] if lookup is None else ["looked_up"]
    some_users = users.where(~is_large)
    usual_users = parsed(some_users)
    large = _large_pairs(parsed(users.where(is_large)), carried, context, kind.visits)
    if lookup is not None:
        keys = usual_users.selectExpr(
            "user_id", "explode_outer(array_distinct(flatten(past))) AS product_id"
        ).where("product_id IS NOT NULL")
        # Stored text is short: users move before they are parsed.
        found = some_users.join(found_by_user(keys, lookup), is_same_user())
        usual_users = parsed(found, "found")
        columns = [name for name in lookup.columns if name != "product_id"]
        rows = lookup.select(F.col("product_id").alias("key"), F.struct(*columns).alias("looked_up"))
        large = large.join(rows, "key", "left")
    usual = _usual_pairs(usual_users, carried, context, kind.prepared, lookup is not None)
    spread = {name: scatter_sql("visits", "n_history", field) for name, field in kind.visited.items()}
    return finished(usual, kind.looked_up).unionByName(finished(large, spread))


# --- columns ----------------------------------------------------------------


def _in_form(sequence: Column, as_text: bool, padded_to: int | None = None) -> Column:
    if padded_to is not None:
        return pad(F.coalesce(sequence, empty_array()), padded_to)
    return encode_flat(sequence) if as_text else sequence


def _temporal(users: DataFrame, as_text: bool, padded_to: int | None = None) -> dict[str, Column]:
    """The temporal sequences in the wanted form, made once per user."""
    if padded_to is not None:
        return {name: pad(flat_column(users, name), padded_to) for name in schemas.TEMPORAL}
    return {
        name: encode_flat(F.col(name))
        for name in schemas.TEMPORAL
        if as_text and not is_text(users, name)
    }


def _train_label(label: Column) -> Column:
    return F.when(F.col("target_eval_set") == "train", label.cast("int")).otherwise(F.lit(-1))


def order_sizes(baskets: Column) -> Column:
    return F.transform(baskets, lambda basket: F.size(basket))


def distinct_sizes(baskets: Column) -> Column:
    return F.transform(baskets, lambda basket: F.size(F.array_distinct(basket)))


def flag_sums(orders: Column) -> Column:
    """Reordered items per order."""
    return F.transform(orders, lambda flags: flag_sum(flags).cast("int"))


def order_overlaps(baskets: str, first_orders: str) -> Column:
    """Distinct products of each order that an earlier order already had.

    ``first_orders`` names an array that holds, once per product, the 1-based
    order that brought it in. Sorted, its runs count the new products of each
    order; the runs are spread over the orders and taken off the distinct sizes.
    Linear but for the sort. A null is no product.
    """
    starts = f"""filter(sequence(0, greatest(size(firsts) - 1, 0)),
        i -> NOT get(firsts, i) <=> get(firsts, i - 1))"""
    runs = """transform(starts, (start, j) -> named_struct('idx', get(firsts, start),
        'fresh', coalesce(get(starts, j + 1), size(firsts)) - start))"""
    spread = scatter_sql("runs", f"size({baskets})", "fresh")
    # Each inner transform names one value, so that it is computed once.
    fresh = f"""transform(array(array_sort(array_compact({first_orders}))), firsts ->
        transform(array({starts}), starts -> transform(array({runs}), runs -> {spread})))"""
    return F.expr(
        f"""zip_with(transform({baskets}, b -> size(array_distinct(array_compact(b)))),
        {fresh}[0][0][0], (distinct_products, n) -> distinct_products - n)"""
    )


# Sequences of a product row that are the same for all pairs of a user.
_OF_USER = ("history_order_size", "history_reorder_size")


# --- the tables -------------------------------------------------------------


def product_history(
    users: DataFrame,
    tags: DataFrame,
    products: DataFrame,
    as_text: bool = True,
    item_type: str = "int",
    large_user_items: int = LARGE_USER_ITEMS,
    padded_to: int | None = None,
    more: tuple[str, ...] = (),
) -> DataFrame:
    """One row per user and product of the user's history.

    ``users`` holds typed or text sequences (ids in text are read as
    ``item_type``); ``tags`` is (user_id, target_eval_set). The label is 1/0
    for train users and -1 for all others. ``as_text`` gives the stored form.
    ``padded_to`` (with arrays) brings the six sequences that all pairs of a user
    share to a fixed length, once per user; the pair's own two stay as they are.
    ``more`` names further columns of ``products`` to keep. ``users`` holds a user once.
    """
    past = F.col("past")
    columns = ["product_id", "aisle_id", "department_id", "product_name", *more]
    products = products.select(columns)
    is_small = is_broadcast(products)
    pairs = _pairs(
        users.join(tags, "user_id", "left"),
        PRODUCTS,
        ["user_id", "eval_set", "target_eval_set", *schemas.TEMPORAL],
        {
            "history_order_size": _in_form(order_sizes(past), as_text, padded_to),
            "history_reorder_size": _in_form(
                order_overlaps("past", "first_orders"), as_text, padded_to
            ),
            **_temporal(users, as_text, padded_to),
        },
        item_type,
        as_text,
        large_user_items,
        None if is_small else products,
    ).withColumnRenamed("key", "product_id")
    joined = pairs.join(products, "product_id", "left") if is_small else pairs
    return joined.withColumn("label", _train_label(F.col("in_target"))).select(
        *schemas.PRODUCT_HISTORY, *more
    )


def none_history(
    users: DataFrame, tags: DataFrame, as_text: bool = True, padded_to: int | None = None
) -> DataFrame:
    """One "None" row per user: was nothing reordered?

    Product 0. Past orders are flagged 1 when they hold no reordered item, the
    label says the same of the target order. Its reorder sizes are sums of
    reordered flags, unlike the overlap counts of the product rows.
    """
    orders = F.col("orders")
    past = before_last(orders)
    # A target order without items reorders nothing.
    last = F.try_element_at(orders, F.lit(-1))
    reordered = F.when(last.isNotNull(), F.coalesce(F.array_max(last), F.lit(0)))
    sequences = {
        "is_ordered_history": F.transform(past, lambda o: (F.array_max(o) == 0).cast("int")),
        "position_in_order_history": F.transform(past, lambda o: F.lit(0)),
        "history_order_size": order_sizes(past),
        "history_reorder_size": flag_sums(past),
    }
    return (
        users.join(tags, "user_id", "left")
        .withColumn("orders", nested_column(users, "reorders"))
        .withColumns(
            {
                "product_id": F.lit(0),
                "aisle_id": F.lit(0),
                "department_id": F.lit(0),
                "product_name": F.lit(""),
                "label": _train_label(reordered == 0),
                **{
                    name: _in_form(c, as_text, padded_to if name in _OF_USER else None)
                    for name, c in sequences.items()
                },
                **_temporal(users, as_text, padded_to),
            }
        )
        .select(schemas.PRODUCT_HISTORY)
    )


def product_history_with_none(
    users: DataFrame,
    tags: DataFrame,
    products: DataFrame,
    as_text: bool = True,
    item_type: str = "int",
    padded_to: int | None = None,
) -> DataFrame:
    """The product_history table: product rows and "None" rows together."""
    pairs = product_history(
        users, tags, products, as_text, item_type, padded_to=padded_to
    )
    return pairs.unionByName(none_history(users, tags, as_text, padded_to))


def aisle_departments(products: DataFrame) -> DataFrame:
    """Distinct (aisle_id, department_id); an aisle may map to several."""
    return products.select("aisle_id", "department_id").distinct()


def mixed_aisles(products: DataFrame) -> DataFrame:
    """(aisle_id, n_departments) of the aisles in several departments: each of
    their aisle rows comes once per department."""
    return (
        aisle_departments(products)
        .groupBy("aisle_id")
        .agg(F.count(F.lit(1)).alias("n_departments"))
        .where("n_departments > 1")
    )


def check_aisles(products: DataFrame) -> None:
    """Raise when aisle rows would fan out."""
    found = mixed_aisles(products).agg(F.count(F.lit(1)), F.min("aisle_id")).first()
    if found[0]:
        raise ValueError(f"{found[0]} aisles lie in several departments, the first is {found[1]}")


def aisle_history(
    users: DataFrame,
    products: DataFrame,
    as_text: bool = True,
    item_type: str = "int",
    large_user_items: int = LARGE_USER_ITEMS,
) -> DataFrame:
    """One row per user, aisle of the user's history and department of it.

    The few aisles are written first: by the size of ``products`` Catalyst would take
    them for too many to broadcast, and move all pairs.
    """
    departments = materialise(aisle_departments(products), "aisle-departments")
    sizes = _in_form(distinct_sizes(F.col("past")), as_text)
    pairs = _pairs(
        users,
        AISLES,
        ["user_id", "eval_set", *schemas.TEMPORAL],
        {"aisle_history_size": sizes, **_temporal(users, as_text)},
        item_type,
        as_text,
        large_user_items,
    )
    return (
        pairs.withColumnRenamed("key", "aisle_id")
        .join(departments, "aisle_id", "left")
        .select(schemas.AISLE_HISTORY)
    )
