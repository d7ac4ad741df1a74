"""The registered queries of this package and their SQL.

Each query applies one operator, with its production parameters, to its whole
table. Where SQL can express the operator its SQL is here; where it can't
(hash functions, compression, tokenizers, models, drawn orders) the tests hold
the query against a brute-force version.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import pandas as pd
import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketseq.llm import (
    alignment,
    chat,
    co_training,
    collocations,
    mixing,
    near_dedup,
    neighbours,
    packing,
    pii,
    quality,
    secret_scan,
    sharding,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Rows that a Python worker gets at once: whole texts can be long.
BATCH_ROWS = 1_000


def ship_package(spark: SparkSession | None = None) -> None:
    """Send this package's functions along with the tasks that call them, and
    bound the rows of a batch. Executors then need no copy of the repository."""
    cloudpickle.register_pickle_by_value(sys.modules["basketseq.llm"])
    if spark is not None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.col("id") % 50 == 0, k=5)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op4_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, with_ids=False)


def op5_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.sharded(docs)
    text = F.col("row.text")
    return placed.select(
        "row.doc_id",
        sharding.text_bytes(text).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What the formatted conversations and their masks say."""
    for batch in batches:
        rows = []
        for key, formatted, spans in zip(
            batch["conv_id"], batch["formatted"], batch["loss_spans"], strict=True
        ):
            turns = chat.parse(formatted)
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            loss = "".join(chat.unescaped(formatted[s["begin"] : s["end"]]) for s in spans)
            rows.append(
                (
                    key,
                    len(turns),
                    hashlib.sha256(whole.encode("utf-8", "replace")).hexdigest(),
                    len(loss),
                    hashlib.sha256(loss.encode("utf-8", "replace")).hexdigest(),
                    len(formatted),
                )
            )
        yield pd.DataFrame(rows, columns=_READ_BACK)


_READ_BACK = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def op6_chat_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    formatted = chat.formatted_conversations(turns.unionByName(control), TOKENIZER)
    named = formatted.select(F.col("conv_id").cast("string"), "formatted", "loss_spans")
    return named.mapInPandas(
        _read_back,
        "conv_id string, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    ).withColumn("conv_id", F.col("conv_id").cast("long"))


def op7_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = co_training.with_scores(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", "text_score", "meta_score", "score", "kept")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.judged_urls(pages)
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "probability")


def op9_chosen_path_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_dedup.near_duplicates(docs, shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.with_quality(docs).drop("text")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.span_digests(secret_scan.with_secrets(docs))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.link_scores(docs, TOKENIZER, PIECES)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP3_SQL = r"""
WITH docs AS (
    SELECT doc_id, source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5(concat_ws('|', 'mix', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS mix_key
    FROM documents
),
sources AS (
    SELECT source, source_size, 2 * source_size AS cap,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source)
),
lined AS (
    SELECT *,
           coalesce(sum(cap) OVER before, 0) AS cap_before,
           coalesce(sum(weight) OVER before, 0) AS weight_before
    FROM sources
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
levels AS (
    SELECT max(level) AS level
    FROM (SELECT weight, cap,
                 (CAST((SELECT sum(source_size) FROM sources) AS DOUBLE) * 1.5 - cap_before)
                 / ((SELECT sum(weight) FROM sources) - weight_before) AS level
          FROM lined)
    WHERE level * weight <= cap
),
targets AS (
    SELECT source, source_size,
           least(CAST(cap AS DOUBLE), coalesce((SELECT level FROM levels), 0) * weight) AS target
    FROM sources
),
placed AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
           CAST(floor(t.target) AS BIGINT) AS budget,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY mix_key, doc_id, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE
            (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - begin)) END AS BIGINT) AS taken
FROM placed
"""


OP6_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
    SELECT *, length('<|turn|>')
              + length(replace(replace(replace(role, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'),
                               chr(10), chr(92) || 'n')) + 1
              + length(replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'))
              + length('<|end|>') + 1
              AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
                         ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP9_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(
        CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1),
                                                  lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM words
),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS u, b.doc_id AS v
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 85 * (min(a.n) + min(b.n) - count(*))
),
reached(u, v) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id,
       s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT u, min(v) AS component_id FROM reached GROUP BY u) c ON s.doc_id = c.u
"""


# The rules again, as regular expressions of their own: kind, pattern, group that the
# least length is for, that length.
_SECRETS_IN_SQL = (
    (
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["\x27]?\x20*[:=]\x20*["\x27]?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("github", "gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    ("slack", "xox[abeoprs]-[A-Za-z0-9-]+", 0, 24),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    ("private", r"-----BEGIN\x20([A-Z0-9]+\x20)*PRIVATE\x20KEY-----", 0, 27),
)


def _op11_sql() -> str:
    kinds = " UNION ALL ".join(
        f"""SELECT doc_id, '{kind}' AS kind, {number} AS kind_at,
                   regexp_extract_all(text, '{pattern}') AS found,
                   regexp_extract_all(text, '{pattern}', {group}) AS value,
                   string_split_regex(text, '{pattern}') AS gaps, {least} AS least
            FROM docs"""
        for number, (kind, pattern, group, least) in enumerate(_SECRETS_IN_SQL)
    )
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({kinds}),
numbered AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM matches),
placed AS (
    SELECT doc_id, kind, kind_at, length(found[i]) AS size, least, length(value[i]) AS value_size,
           list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
    FROM numbered
),
spans AS (
    SELECT doc_id, kind, kind_at, CAST(start AS BIGINT) AS start,
           kind || ':' || CAST(CAST(start AS BIGINT) AS VARCHAR) || ':'
           || CAST(CAST(start + size AS BIGINT) AS VARCHAR) AS span
    FROM placed WHERE value_size >= least
)
SELECT d.doc_id,
       count(*) FILTER (kind = 'assign') AS n_assign,
       count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, kind_at)
                       FILTER (kind_at < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, kind_at), '') AS spans
FROM docs d LEFT JOIN spans s ON d.doc_id = s.doc_id
GROUP BY d.doc_id
"""


OP11_SQL = _op11_sql()

OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
           unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
),
grams AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
    FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words)
    CROSS JOIN (SELECT unnest([1, 2, 3]) AS size)
    WHERE i + size - 1 <= len(w)
),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w
    FROM counts WHERE size > 1 AND f >= 10
),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r,
           CAST(1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN counts l ON l.lang = c.lang AND l.size = k AND l.phrase = array_to_string(w[1:k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.size = c.size - k
                     AND r.phrase = array_to_string(w[k + 1:], ' ')
),
lowest AS (
    SELECT * FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
longer AS (
    SELECT lang, part, max(a) AS a
    FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part
          FROM candidates WHERE size = 3)
    GROUP BY lang, part
),
kept AS (
    SELECT lowest.* FROM lowest
    LEFT JOIN longer ON longer.lang = lowest.lang AND longer.part = lowest.phrase
    WHERE longer.a IS NULL OR 100 * longer.a < 50 * lowest.a
)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN sizes ON sizes.lang = kept.lang
QUALIFY rank <= 2000
"""


def queries() -> dict[str, Query]:
    ship_package()
    return {
        query.__name__: query
        for query in (
            op1_feistel_pseudonyms,
            op2_projected_neighbours,
            op3_source_mixing,
            op4_sum_of_squares_packing,
            op5_external_shuffle,
            op6_chat_masks,
            op7_co_training,
            op8_url_filter,
            op9_chosen_path_dedup,
            op10_compression_bands,
            op11_secret_scan,
            op12_token_alignment,
            op13_collocations,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_source_mixing": OP3_SQL,
        "op6_chat_masks": OP6_SQL,
        "op9_chosen_path_dedup": OP9_SQL,
        "op11_secret_scan": OP11_SQL,
        "op13_collocations": OP13_SQL,
    }
