"""The registered queries in plain SQL, over the same star-schema tables.

The SQL follows the relational definitions (ranks, counts, first purchases
over item rows), not the array form the Spark operators use, so agreement
checks both.
"""

from __future__ import annotations

from basketseq.plans import queries as q

_MODEL = """
m_ordered AS (
  SELECT o_orderkey + 1 AS order_id, o_custkey + 1 AS user_id,
         CAST(o_orderdate AS DATE) AS day,
         row_number() OVER w AS order_number,
         lead(o_orderkey) OVER w IS NULL AS is_last,
         lag(CAST(o_orderdate AS DATE)) OVER w AS previous_day
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
),
m_orders AS (
  SELECT order_id, user_id,
         CASE WHEN NOT is_last THEN 'prior' WHEN user_id % 3 = 0 THEN 'test'
              ELSE 'train' END AS eval_set,
         CAST(order_number AS INTEGER) AS order_number,
         CAST(dayofweek(day) AS INTEGER) AS order_dow,
         CAST((order_id - 1) % 24 AS INTEGER) AS order_hour_of_day,
         CAST(date_diff('day', previous_day, day) AS DOUBLE) AS days_since_prior_order
  FROM m_ordered
),
m_products AS (
  SELECT p_partkey + 1 AS product_id, p_name AS product_name,
         CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS aisle_id,
         CAST(floor((CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) - 1) / 5.0) + 1
              AS INTEGER) AS department_id
  FROM part
),
m_lines AS (
  SELECT o.order_id, l.l_partkey + 1 AS product_id, l.l_linenumber AS add_to_cart_order,
         CAST(min(o.order_number) OVER (PARTITION BY o.user_id, l.l_partkey)
              < o.order_number AS INTEGER) AS reordered,
         o.eval_set
  FROM lineitem l JOIN m_orders o ON l.l_orderkey + 1 = o.order_id
),
m_items AS (
  SELECT order_id, product_id, add_to_cart_order, reordered, eval_set
  FROM m_lines WHERE eval_set IN ('prior', 'train')
),
m_joined AS (
  SELECT i.order_id, i.product_id, i.add_to_cart_order, i.reordered, o.user_id, o.eval_set,
         o.order_number, o.order_dow, o.order_hour_of_day, o.days_since_prior_order,
         p.product_name, p.aisle_id, p.department_id
  FROM m_items i JOIN m_orders o ON i.order_id = o.order_id
  JOIN m_products p ON i.product_id = p.product_id
),
m_enriched AS (
  SELECT * REPLACE (CAST(coalesce(days_since_prior_order, -1) AS INTEGER)
                    AS days_since_prior_order)
  FROM m_joined
),
m_tags AS (
  SELECT user_id, eval_set AS target_eval_set FROM m_orders WHERE eval_set IN ('train', 'test')
),
m_pos AS (
  SELECT *, row_number() OVER (
           PARTITION BY user_id, order_id
           ORDER BY add_to_cart_order, CAST(product_id AS VARCHAR), CAST(reordered AS VARCHAR),
                    CAST(department_id AS VARCHAR), CAST(aisle_id AS VARCHAR)) AS pos
  FROM m_enriched
),
m_baskets AS (
  SELECT user_id, order_id, min(order_number) AS order_number, min(order_dow) AS order_dow,
         min(order_hour_of_day) AS order_hour,
         min(days_since_prior_order) AS days_since_prior_order, min(eval_set) AS eval_set,
         string_agg(CAST(product_id AS VARCHAR), '_' ORDER BY pos) AS products,
         string_agg(CAST(reordered AS VARCHAR), '_' ORDER BY pos) AS reorders,
         string_agg(CAST(department_id AS VARCHAR), '_' ORDER BY pos) AS departments,
         string_agg(CAST(aisle_id AS VARCHAR), '_' ORDER BY pos) AS aisles
  FROM m_pos GROUP BY user_id, order_id
),
m_orders_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id
                               ORDER BY order_number, CAST(order_id AS VARCHAR)) AS idx,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM m_baskets
),
m_users AS (
  SELECT user_id,
         string_agg(CAST(order_id AS VARCHAR), ' ' ORDER BY idx) AS order_ids,
         string_agg(CAST(order_number AS VARCHAR), ' ' ORDER BY idx) AS order_numbers,
         string_agg(CAST(order_dow AS VARCHAR), ' ' ORDER BY idx) AS order_dows,
         string_agg(CAST(order_hour AS VARCHAR), ' ' ORDER BY idx) AS order_hours,
         string_agg(CAST(days_since_prior_order AS VARCHAR), ' ' ORDER BY idx)
           AS days_since_prior_orders,
         string_agg(products, ' ' ORDER BY idx) AS product_ids,
         string_agg(reorders, ' ' ORDER BY idx) AS reorders,
         string_agg(departments, ' ' ORDER BY idx) AS department_ids,
         string_agg(aisles, ' ' ORDER BY idx) AS aisle_ids,
         max(CASE WHEN idx = n THEN eval_set END) AS eval_set,
         max(n) AS n
  FROM m_orders_ranked GROUP BY user_id
),
m_seq AS (
  SELECT p.user_id, p.order_id, p.product_id, p.aisle_id, p.reordered, p.pos, r.idx, r.n
  FROM m_pos p JOIN m_orders_ranked r ON p.order_id = r.order_id AND p.user_id = r.user_id
),
m_first AS (
  SELECT user_id, product_id, min(idx) AS first_idx, max(idx) AS last_idx, max(n) AS n
  FROM m_seq GROUP BY user_id, product_id
),
m_order_sizes AS (
  SELECT s.user_id, s.idx, max(s.n) AS n, count(*) AS n_items, sum(s.reordered) AS n_flags,
         count(DISTINCT CASE WHEN f.first_idx < s.idx THEN s.product_id END) AS n_again,
         count(DISTINCT s.aisle_id) AS n_aisles
  FROM m_seq s JOIN m_first f ON s.user_id = f.user_id AND s.product_id = f.product_id
  GROUP BY s.user_id, s.idx
),
m_past AS (
  SELECT user_id,
         string_agg(CAST(n_items AS VARCHAR), ' ' ORDER BY idx) AS order_size,
         string_agg(CAST(n_flags AS VARCHAR), ' ' ORDER BY idx) AS flag_size,
         string_agg(CAST(n_again AS VARCHAR), ' ' ORDER BY idx) AS again_size,
         string_agg(CAST(n_aisles AS VARCHAR), ' ' ORDER BY idx) AS aisle_size,
         string_agg(CASE WHEN n_flags = 0 THEN '1' ELSE '0' END, ' ' ORDER BY idx) AS is_none,
         string_agg('0', ' ' ORDER BY idx) AS zeros
  FROM m_order_sizes WHERE idx < n GROUP BY user_id
),
m_pair_orders AS (
  SELECT user_id, product_id, idx, min(pos) AS pos FROM m_seq GROUP BY user_id, product_id, idx
),
m_pairs AS (
  SELECT f.user_id, f.product_id, max(f.last_idx) AS last_idx, max(f.n) AS n,
         string_agg(CASE WHEN o.pos IS NULL THEN '0' ELSE '1' END, ' ' ORDER BY g.idx)
           AS is_ordered,
         string_agg(CAST(coalesce(o.pos, 0) AS VARCHAR), ' ' ORDER BY g.idx) AS positions
  FROM m_first f
  JOIN m_order_sizes g ON f.user_id = g.user_id AND g.idx < g.n
  LEFT JOIN m_pair_orders o
    ON f.user_id = o.user_id AND f.product_id = o.product_id AND g.idx = o.idx
  WHERE f.first_idx < f.n
  GROUP BY f.user_id, f.product_id
),
m_product_history AS (
  SELECT a.user_id, a.product_id,
         CASE WHEN t.target_eval_set = 'train' THEN CAST(a.last_idx = a.n AS INTEGER)
              ELSE -1 END AS label,
         p.aisle_id, p.department_id, p.product_name, u.eval_set,
         a.is_ordered AS is_ordered_history, a.positions AS position_in_order_history,
         h.order_size AS history_order_size, h.again_size AS history_reorder_size,
         u.order_dows, u.order_hours, u.days_since_prior_orders, u.order_numbers
  FROM m_pairs a JOIN m_users u ON a.user_id = u.user_id
  JOIN m_past h ON a.user_id = h.user_id
  LEFT JOIN m_tags t ON a.user_id = t.user_id
  LEFT JOIN m_products p ON a.product_id = p.product_id
),
m_none_history AS (
  SELECT u.user_id, 0 AS product_id,
         CASE WHEN t.target_eval_set = 'train' THEN CAST(s.n_flags = 0 AS INTEGER)
              ELSE -1 END AS label,
         0 AS aisle_id, 0 AS department_id, '' AS product_name, u.eval_set,
         coalesce(h.is_none, '') AS is_ordered_history,
         coalesce(h.zeros, '') AS position_in_order_history,
         coalesce(h.order_size, '') AS history_order_size,
         coalesce(h.flag_size, '') AS history_reorder_size,
         u.order_dows, u.order_hours, u.days_since_prior_orders, u.order_numbers
  FROM m_users u JOIN m_order_sizes s ON u.user_id = s.user_id AND s.idx = s.n
  LEFT JOIN m_past h ON u.user_id = h.user_id
  LEFT JOIN m_tags t ON u.user_id = t.user_id
),
m_all_history AS (
  SELECT * FROM m_product_history UNION ALL SELECT * FROM m_none_history
),
m_aisle_orders AS (
  SELECT user_id, aisle_id, idx, count(*) AS n_items, max(n) AS n,
         row_number() OVER (PARTITION BY user_id, idx ORDER BY min(pos)) AS rank
  FROM m_seq GROUP BY user_id, aisle_id, idx
),
m_aisle_pairs AS (
  SELECT a.user_id, a.aisle_id,
         string_agg(CASE WHEN o.rank IS NULL THEN '0' ELSE '1' END, ' ' ORDER BY g.idx)
           AS is_ordered_history,
         string_agg(CAST(coalesce(o.rank, 0) AS VARCHAR), ' ' ORDER BY g.idx)
           AS position_in_order,
         string_agg(CAST(coalesce(o.n_items, 0) AS VARCHAR), ' ' ORDER BY g.idx)
           AS num_products_from_aisle
  FROM (SELECT user_id, aisle_id FROM m_aisle_orders GROUP BY user_id, aisle_id
        HAVING min(idx) < max(n)) a
  JOIN m_order_sizes g ON a.user_id = g.user_id AND g.idx < g.n
  LEFT JOIN m_aisle_orders o
    ON a.user_id = o.user_id AND a.aisle_id = o.aisle_id AND g.idx = o.idx
  GROUP BY a.user_id, a.aisle_id
),
m_aisle_departments AS (SELECT DISTINCT aisle_id, department_id FROM m_products),
m_mixed_departments AS (
  SELECT DISTINCT m.aisle_id, CAST(ascii(p.p_type) % 5 + 1 AS INTEGER) AS department_id
  FROM part p JOIN m_products m ON p.p_partkey + 1 = m.product_id
)
"""

_AISLE_HISTORY = """
SELECT a.user_id, a.aisle_id, d.department_id, u.eval_set, a.is_ordered_history,
       a.position_in_order, a.num_products_from_aisle, h.aisle_size AS aisle_history_size,
       u.order_dows, u.order_hours, u.days_since_prior_orders, u.order_numbers
FROM m_aisle_pairs a JOIN m_users u ON a.user_id = u.user_id
JOIN m_past h ON a.user_id = h.user_id
LEFT JOIN {departments} d ON a.aisle_id = d.aisle_id
"""

# Reorder-size features: with one order only, that order is the history.
_SIZES = """
m_sizes AS (
  SELECT user_id,
         coalesce(string_agg(CASE WHEN idx < n OR n = 1 THEN CAST(n_items AS VARCHAR) END,
                             ' ' ORDER BY idx), '') AS order_sizes,
         coalesce(string_agg(CASE WHEN idx < n OR n = 1 THEN CAST(n_flags AS VARCHAR) END,
                             ' ' ORDER BY idx), '') AS reorder_sizes,
         CAST(sum(CASE WHEN idx = n AND n > 1 THEN n_flags ELSE 0 END) AS INTEGER) AS label
  FROM m_order_sizes GROUP BY user_id
)
"""


def _words(table: str, key: str, text: str) -> str:
    """Words of a text column with their 0-based place in the text."""
    return f"""
m_split AS (
  SELECT {key} AS product_id, string_split_regex(trim(lower({text}), ' '), '\\s+') AS parts
  FROM {table}
),
m_tokens AS (
  SELECT product_id, word_pos, word FROM (
    SELECT product_id, CAST(unnest(range(len(parts))) AS INTEGER) AS word_pos,
           unnest(parts) AS word
    FROM m_split
  ) WHERE word <> ''
),
m_counts AS (SELECT word, count(*) AS word_count FROM m_tokens GROUP BY word)
"""


def _index(min_freq: int) -> str:
    return f"""
m_index AS (
  SELECT word, CAST(CASE WHEN word_count >= {min_freq}
                         THEN row_number() OVER (ORDER BY word_count DESC, word)
                         ELSE 0 END AS INTEGER) AS word_idx
  FROM m_counts
)
"""


def _encoded(source: str, index: str) -> str:
    """Word ids per name; "0" for a name without words."""
    return f"""
m_encoded AS (
  SELECT s.product_id,
         CASE WHEN t.product_id IS NULL THEN '0' ELSE coalesce(t.ids, '') END
           AS product_name_encoded
  FROM {source} s
  LEFT JOIN (
    SELECT k.product_id, string_agg(CAST(i.word_idx AS VARCHAR), ' ' ORDER BY k.word_pos) AS ids
    FROM m_tokens k LEFT JOIN {index} i ON k.word = i.word GROUP BY k.product_id
  ) t ON s.product_id = t.product_id
)
"""


_PRODUCT_WORDS = _words("m_products", "product_id", "product_name")
_DOCUMENT_WORDS = _words("documents", "doc_id", "text")


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + select


def _model(select: str, *more: str) -> str:
    return _with(_MODEL, *more, select=select)


def _padded(text: str, length: int) -> str:
    """Space-joined text cut or zero-filled to ``length`` tokens."""
    tokens = f"(CASE WHEN {text} = '' THEN [] ELSE string_split({text}, ' ') END)"
    zeros = f"string_split(rtrim(repeat('0 ', {length})), ' ')"
    return f"array_to_string(list_concat({tokens}, {zeros})[1:{length}], ' ')"


def _length(text: str, length: int) -> str:
    tokens = f"(CASE WHEN {text} = '' THEN 0 ELSE len(string_split({text}, ' ')) END)"
    return f"CAST(least({tokens}, {length}) AS INTEGER)"


def _padded_columns(names: list[str], length: int) -> str:
    return ", ".join(f"{_padded(name, length)} AS {name}" for name in names)


_TEMPORAL = ["order_dows", "order_hours", "days_since_prior_orders", "order_numbers"]

_T1 = f"""
SELECT h.user_id, h.product_id, h.eval_set, h.label,
       {_padded("coalesce(e.product_name_encoded, '')", q.NAME_LENGTH)} AS product_name_encoded,
       {_padded_columns(["is_ordered_history", "position_in_order_history",
                         "history_order_size", "history_reorder_size", *_TEMPORAL],
                        q.SEQUENCE_LENGTH)},
       {_length("h.is_ordered_history", q.SEQUENCE_LENGTH)} AS history_length,
       {_length("coalesce(e.product_name_encoded, '')", q.NAME_LENGTH)} AS product_name_length
FROM m_all_history h LEFT JOIN m_encoded e ON h.product_id = e.product_id
"""
_T1_PARTS = (
    _PRODUCT_WORDS,
    _index(q.MIN_WORD_FREQ),
    _encoded("m_products", "m_index"),
)
_T4 = f"""
SELECT user_id, aisle_id, department_id, eval_set,
       {_padded_columns(["is_ordered_history", "position_in_order", "num_products_from_aisle",
                         "aisle_history_size", *_TEMPORAL], q.AISLE_LENGTH)},
       {_length("is_ordered_history", q.AISLE_LENGTH)} AS history_length
FROM m_aisle_history
"""
_AISLE_PART = (
    "m_aisle_history AS (" + _AISLE_HISTORY.format(departments="m_aisle_departments") + ")"
)
_SIZE_COLUMNS = ["order_sizes", "reorder_sizes", *_TEMPORAL]
_T2B = f"""
SELECT u.user_id, u.eval_set, {_padded_columns(_SIZE_COLUMNS, q.SEQUENCE_LENGTH)}, s.label,
       {_length("reorder_sizes", q.SEQUENCE_LENGTH)} AS history_length
FROM m_users u JOIN m_sizes s ON u.user_id = s.user_id
"""
_DRAW = f"""
m_draw AS (
  SELECT user_id FROM (SELECT DISTINCT user_id FROM m_orders)
  ORDER BY md5('{q.SAMPLE_SEED}:' || CAST(user_id AS VARCHAR)), user_id LIMIT {q.SAMPLE_USERS}
)
"""
_BRONZE_TYPES = """
  CAST(order_id AS INTEGER) AS order_id, CAST(user_id AS INTEGER) AS user_id, eval_set,
  CAST(order_number AS TINYINT) AS order_number, CAST(order_dow AS TINYINT) AS order_dow,
  CAST(order_hour_of_day AS TINYINT) AS order_hour_of_day, days_since_prior_order
"""
_NARROW_ITEM = """
  CAST(product_id AS INTEGER) AS product_id, CAST(order_id AS INTEGER) AS order_id,
  CAST(add_to_cart_order AS SMALLINT) AS add_to_cart_order,
  CAST(reordered AS TINYINT) AS reordered, CAST(user_id AS INTEGER) AS user_id, eval_set,
  CAST(order_number AS TINYINT) AS order_number, CAST(order_dow AS TINYINT) AS order_dow,
  CAST(order_hour_of_day AS TINYINT) AS order_hour_of_day, days_since_prior_order,
  product_name, CAST(aisle_id AS SMALLINT) AS aisle_id,
  CAST(department_id AS TINYINT) AS department_id
"""


def _narrow(*names: str) -> str:
    return "REPLACE (" + ", ".join(f"CAST({n} AS INTEGER) AS {n}" for n in names) + ")"


def _prev(text: str) -> str:
    return f"array_to_string(string_split({text}, ' ')[1:len(string_split({text}, ' ')) - 1], ' ')"


def _last(text: str) -> str:
    return f"string_split({text}, ' ')[len(string_split({text}, ' '))]"


def _distinct(key: str, where: str) -> str:
    """Distinct ids of a user's orders in first-seen order."""
    return f"""(
  SELECT user_id, string_agg(CAST(k AS VARCHAR), ' ' ORDER BY i, p) AS ids FROM (
    SELECT user_id, {key} AS k, min(idx * 100000 + pos) AS p, 0 AS i
    FROM m_seq WHERE {where} GROUP BY user_id, {key}
  ) GROUP BY user_id
)"""


def _parsed(text: str, key: str, raw: str, prev: str, every: str, last: str, extra: str = "") -> str:
    return f"""
SELECT u.user_id, u.{text}, u.{text} AS {raw}, {_prev(f"u.{text}")} AS {prev},
       {_prev(f"u.{text}")} AS {every}, {_last(f"u.{text}")} AS {last}, {extra}
       coalesce(h.ids, '') AS {every.replace("_all", "_set")},
       t.ids AS next_{every.replace("_all", "_set")}
FROM m_users u LEFT JOIN {_distinct(key, "idx < n")} h ON u.user_id = h.user_id
JOIN {_distinct(key, "idx = n")} t ON u.user_id = t.user_id
"""


def _table_values(orders: str, items: str) -> str:
    """Every row of the six source tables as text."""
    of_item = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    tables = {
        "orders": (
            [
                "order_id", "user_id", "eval_set", "order_number", "order_dow",
                "order_hour_of_day", "CAST(days_since_prior_order AS BIGINT)",
            ],
            orders,
        ),
        "products": (["product_id", "product_name", "aisle_id", "department_id"], "m_products"),
        "order_products__prior": (of_item, f"({items} WHERE eval_set = 'prior')"),
        "order_products__train": (of_item, f"({items} WHERE eval_set = 'train')"),
        "aisles": (
            ["aisle_id", "'aisle ' || aisle_id"],
            "(SELECT DISTINCT aisle_id FROM m_products)",
        ),
        "departments": (
            ["department_id", "'department ' || department_id"],
            "(SELECT DISTINCT department_id FROM m_products)",
        ),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, concat_ws('|', "
        + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
        + f") AS row_values FROM {source}"
        for name, (columns, source) in tables.items()
    )


_VALUES = _table_values("m_orders", "SELECT * FROM m_items")
_SAMPLED_VALUES = _table_values(
    "m_sampled",
    "SELECT * FROM (SELECT * FROM m_items WHERE order_id IN (SELECT order_id FROM m_sampled))",
)
_SAMPLED = "m_sampled AS (SELECT * FROM m_orders WHERE user_id IN (SELECT user_id FROM m_draw))"
_USER_COLUMNS = (
    "user_id, order_ids, order_numbers, order_dows, order_hours, days_since_prior_orders, "
    "product_ids, reorders, department_ids, aisle_ids, eval_set"
)
_FREQUENT_INDEX = "m_frequent AS (SELECT * FROM m_index WHERE word_idx > 0)"
_ITEM = "order_id, product_id, add_to_cart_order, reordered"


def _newest(text: str, length: int) -> str:
    words = f"string_split({text}, ' ')"
    return f"array_to_string({words}[greatest(len({words}) - {length}, 0) + 1:], ' ')"


def _changed_model(old: str, new: str, select: str) -> str:
    """A query over the model with one of its definitions changed."""
    query = _model(select)
    if old not in query:
        raise ValueError(f"the model has no {old!r}")
    return query.replace(old, new)


def _with_test_items(select: str) -> str:
    return _changed_model("FROM m_lines WHERE eval_set IN ('prior', 'train')", "FROM m_lines", select)


def _declared_target(select: str) -> str:
    """Tagged orders without items count as empty baskets."""
    old = "  FROM m_pos GROUP BY user_id, order_id\n),"
    new = """  FROM m_pos GROUP BY user_id, order_id
  UNION ALL
  SELECT user_id, order_id, order_number, order_dow, order_hour_of_day,
         CAST(coalesce(days_since_prior_order, -1) AS INTEGER), eval_set, '', '', '', ''
  FROM m_orders
  WHERE eval_set <> 'prior' AND order_id NOT IN (SELECT order_id FROM m_pos)
),"""
    return _changed_model(old, new, select)


def oracle_sql() -> dict[str, str]:
    """SQL per registered query."""
    return {
        "s1_csv_scan": _model(f"SELECT {_BRONZE_TYPES} FROM m_orders"),
        "s2_parquet_scan": _model("SELECT * FROM m_products"),
        "s3_parquet_sink": _model("SELECT * FROM m_products"),
        "s4_typed_ingest": _model(_VALUES),
        "s4_quarantined_rows": _model(
            "SELECT CASE WHEN order_id % 10 < 2 THEN 'quarantine' ELSE 'bronze' END AS dataset, "
            "order_id || ',' || product_id || ',' || add_to_cart_order "
            "|| CASE WHEN order_id % 10 = 1 THEN '' ELSE ',' || reordered END "
            "|| CASE WHEN order_id % 10 = 0 THEN ',9' ELSE '' END AS row_text "
            "FROM m_items WHERE eval_set = 'prior'"
        ),
        "s5_source_tables": _model(f"SELECT {_NARROW_ITEM} FROM m_joined"),
        "s6_split_tags": _model("SELECT * FROM m_tags"),
        "c1_fill_and_cast": _model(
            "SELECT order_id, CAST(coalesce(days_since_prior_order, -1) AS INTEGER) AS gap "
            "FROM m_orders"
        ),
        "c2_fill_gaps": _model(
            "SELECT order_id, CAST(coalesce(days_since_prior_order, -1) AS INTEGER) "
            "AS days_since_prior_order FROM m_orders"
        ),
        "c7_name_words": _model("SELECT * FROM m_tokens", _PRODUCT_WORDS),
        "c8_frequent_words": _with(
            _DOCUMENT_WORDS,
            select=f"SELECT * FROM m_counts WHERE word_count >= {q.MIN_DOCUMENT_WORD_FREQ}",
        ),
        "j1_items_orders": _model(
            f"SELECT {_ITEM}, user_id, eval_set, order_number, order_dow, order_hour_of_day, "
            "days_since_prior_order FROM m_joined"
        ),
        "j2_items_products": _model("SELECT * FROM m_joined"),
        "j3_user_tags": _model(
            "SELECT u.user_id, u.eval_set, t.target_eval_set "
            "FROM m_users u LEFT JOIN m_tags t ON u.user_id = t.user_id"
        ),
        "j4_pair_products": _model(
            "SELECT user_id, product_id, aisle_id, department_id, product_name "
            "FROM m_product_history"
        ),
        "j5_aisle_fan_out": _model(_AISLE_HISTORY.format(departments="m_mixed_departments")),
        "j6_token_ids": _model(
            "SELECT t.product_id, t.word_pos, t.word, i.word_idx "
            "FROM m_tokens t LEFT JOIN m_frequent i ON t.word = i.word",
            _PRODUCT_WORDS,
            _index(q.MIN_WORD_FREQ),
            _FREQUENT_INDEX,
        ),
        "j7_document_words": _with(
            _DOCUMENT_WORDS,
            _index(q.MIN_DOCUMENT_WORD_FREQ),
            _FREQUENT_INDEX,
            _encoded("m_split", "m_frequent"),
            select="SELECT * FROM m_encoded",
        ),
        "j8_named_histories": _model(
            "SELECT user_id, product_id, product_name_encoded, product_name_length "
            f"FROM ({_T1})",
            *_T1_PARTS,
        ),
        "a1_order_sequences": _model("SELECT * FROM m_baskets"),
        "a2_order_metadata": _model(
            "SELECT user_id, order_id, order_number, order_dow, order_hour, "
            "days_since_prior_order, eval_set FROM m_baskets"
        ),
        "a3_user_sequences": _model(f"SELECT {_USER_COLUMNS} FROM m_users"),
        "a3_incremental_users": _model(f"SELECT {_USER_COLUMNS} FROM m_users"),
        "a4_last_eval_set": _model("SELECT user_id, eval_set FROM m_users"),
        "a5_word_count": _with(_DOCUMENT_WORDS, select="SELECT * FROM m_counts"),
        "a7_aisle_departments": _model("SELECT * FROM m_aisle_departments"),
        "a8_row_counts": _model(
            "SELECT 'order_products' AS dataset, count(*) AS row_count FROM m_items UNION ALL "
            "SELECT 'order_prior', count(*) FROM m_items WHERE eval_set = 'prior' UNION ALL "
            "SELECT 'order_train', count(*) FROM m_items WHERE eval_set = 'train' UNION ALL "
            "SELECT 'joined', count(*) FROM m_joined"
        ),
        "w1_word_rank": _with(
            _DOCUMENT_WORDS,
            select="SELECT word, word_count, row_number() OVER (ORDER BY word_count DESC, word) "
            f"AS word_rank FROM m_counts WHERE word_count >= {q.MIN_DOCUMENT_WORD_FREQ}",
        ),
        "o3_union_items": _model(f"SELECT {_ITEM} FROM m_items"),
        "o4_product_history_all": _model("SELECT * FROM m_all_history"),
        "o6_order_overlaps": _model(
            "SELECT DISTINCT user_id, history_reorder_size FROM m_product_history"
        ),
        "q1_parse_nested": _model(
            _parsed(
                "product_ids", "product_id", "products_raw", "products_prev", "products_all",
                "next_products",
                extra=f"replace({_last('u.product_ids')}, '_', ' ') AS next_products_int,",
            )
        ),
        "q2_parse_aisles": _model(
            _parsed("aisle_ids", "aisle_id", "aisle_raw", "aisle_prev", "aisle_all", "aisle_next")
        ),
        "q3_parse_flat": _model(
            "SELECT user_id, CAST(count(*) AS INTEGER) AS n_gaps, "
            "CAST(sum(days_since_prior_order) AS BIGINT) AS total, "
            "string_agg(CAST(days_since_prior_order AS VARCHAR), ' ' ORDER BY idx) AS gaps "
            "FROM m_orders_ranked GROUP BY user_id"
        ),
        "q4_pad": _model(
            f"SELECT user_id, {_padded('order_numbers', q.SHORT_LENGTH)} AS padded, "
            f"{_length('order_numbers', q.SHORT_LENGTH)} AS true_length FROM m_users"
        ),
        "p1_history_order_size": _model(
            "SELECT user_id, product_id, history_order_size FROM m_product_history"
        ),
        "p3_pair_labels": _model("SELECT user_id, product_id, label FROM m_product_history"),
        "p4_is_ordered": _model(
            "SELECT user_id, product_id, is_ordered_history FROM m_product_history"
        ),
        "p5_position": _model(
            "SELECT user_id, product_id, position_in_order_history FROM m_product_history"
        ),
        "p_product_history_spread": _model("SELECT * FROM m_product_history"),
        "g_aisle_history_spread": _model(_AISLE_HISTORY.format(departments="m_aisle_departments")),
        "g_mixed_aisles": _model(
            "SELECT aisle_id, count(*) AS n_departments FROM m_mixed_departments "
            "GROUP BY aisle_id HAVING count(*) > 1"
        ),
        "q4_pad_last": _model(
            f"SELECT user_id, {_padded(_newest('order_numbers', q.SHORT_LENGTH), q.SHORT_LENGTH)} "
            "AS padded FROM m_users"
        ),
        "a3_user_sequences_with_test": _with_test_items(
            "SELECT user_id, order_ids, product_ids, reorders, eval_set FROM m_users"
        ),
        "a4_declared_target": _declared_target(
            "SELECT user_id, order_ids, product_ids, eval_set FROM m_users"
        ),
        "d2_partition_distribution": _model(
            "SELECT count(*) AS n_rows, true AS ids_differ, true AS all_filled FROM m_baskets"
        ),
        "d3_partition_summary": _model(
            "SELECT CAST(8 AS INTEGER) AS n_partitions, count(*) AS n_rows, "
            "greatest(count(*) FILTER (order_id % 2 = 0), count(*) FILTER (order_id % 2 = 1)) "
            "AS max_rows, CAST(0 AS BIGINT) AS min_rows FROM m_baskets"
        ),
        "p_product_history": _model("SELECT * FROM m_product_history"),
        "n_none_history": _model("SELECT * FROM m_none_history"),
        "g_aisle_history": _model(_AISLE_HISTORY.format(departments="m_aisle_departments")),
        "r_reorder_size": _model(
            f"SELECT u.user_id, CASE WHEN u.n = 1 THEN u.reorders ELSE {_prev('u.reorders')} END "
            "AS reorders_prev, CASE WHEN u.n = 1 THEN '' "
            f"ELSE replace({_last('u.reorders')}, '_', ' ') END AS reorders_next, "
            "s.order_sizes, s.reorder_sizes, s.label "
            "FROM m_users u JOIN m_sizes s ON u.user_id = s.user_id",
            _SIZES,
        ),
        "v1_word_index": _model(
            "SELECT * FROM m_index", _PRODUCT_WORDS, _index(q.MIN_WORD_FREQ)
        ),
        "v1_document_word_index": _with(
            _DOCUMENT_WORDS, _index(q.MIN_DOCUMENT_WORD_FREQ), select="SELECT * FROM m_index"
        ),
        "v2_encode_names": _model("SELECT * FROM m_encoded", *_T1_PARTS),
        "t1_product_training": _model(_T1, *_T1_PARTS),
        "t2_pad_reorder_sizes": _model(
            f"SELECT u.user_id, {_padded_columns(_SIZE_COLUMNS, q.SHORT_LENGTH)}, "
            f"{_length('reorder_sizes', q.SHORT_LENGTH)} AS history_length "
            "FROM m_users u JOIN m_sizes s ON u.user_id = s.user_id",
            _SIZES,
        ),
        "t2b_reorder_size_training": _model(_T2B, _SIZES),
        "t4_aisle_training": _model(_T4, _AISLE_PART),
        "u1_user_data": _model(
            f"SELECT * {_narrow('user_id')} FROM (SELECT {_USER_COLUMNS} FROM m_users)"
        ),
        "u2_order_products": _model(f"SELECT {_NARROW_ITEM} FROM m_enriched"),
        "u3_product_history_data": _model(
            f"SELECT * {_narrow('user_id', 'product_id')} FROM m_all_history"
        ),
        "u4_aisle_history_data": _model(
            f"SELECT * {_narrow('user_id')} FROM (SELECT * REPLACE (CAST(department_id AS TINYINT) "
            "AS department_id) FROM m_aisle_history)",
            _AISLE_PART,
        ),
        "u5_product_training_data": _model(
            f"SELECT * {_narrow('user_id', 'product_id')} FROM ({_T1})", *_T1_PARTS
        ),
        "u6_aisle_training_data": _model(
            f"SELECT * {_narrow('user_id')} FROM (SELECT * REPLACE (CAST(department_id AS TINYINT) "
            f"AS department_id) FROM ({_T4}))",
            _AISLE_PART,
        ),
        "u7_reorder_size_training_data": _model(
            f"SELECT * {_narrow('user_id')} FROM ({_T2B})", _SIZES
        ),
        "m1_user_count": _model("SELECT count(DISTINCT user_id) AS n_users FROM m_orders"),
        "m2_sample_users": _model("SELECT user_id FROM m_draw", _DRAW),
        "m3_sampled_orders": _model("SELECT * FROM m_sampled", _DRAW, _SAMPLED),
        "m4_sampled_items": _model(
            f"SELECT {_ITEM} FROM m_items WHERE order_id IN (SELECT order_id FROM m_sampled)",
            _DRAW,
            _SAMPLED,
        ),
        "m5_sampled_dataset": _model(_SAMPLED_VALUES, _DRAW, _SAMPLED),
        "d1_join_counts": _model(
            "SELECT (SELECT count(*) FROM m_joined) AS joined_count, "
            "(SELECT count(*) FROM m_items) AS raw_count"
        ),
        "d1_checked_write": _model(
            "SELECT (SELECT count(*) FROM m_joined) AS joined_count, "
            "(SELECT count(*) FROM m_items) AS raw_count, "
            "(SELECT count(*) FROM m_joined) AS stored_count"
        ),
    }
