"""Alignment of two tokenizers over the same texts, by interval coalescing.

Both tokenizers cut the bytes of a space and the text; each token is an interval of
bytes. All tokens of a chunk of documents are sorted by their start (``lexsort``); a
group breaks where a start reaches the running maximum of the ends so far
(``maximum.accumulate``). Within groups, overlaps are expanded: the bytes between two
neighbouring cuts belong to one token of each side, so every overlapping pair comes
once. Pairs whose intervals end together are links.

Corpus counts of linked id pairs: tasks cut their documents into chunks of a bounded
number of tokens; each chunk lists its distinct pairs with their number. The lists
are summed by pair, and each chunk gets the totals of its own pairs back. So neither
documents nor single links are shuffled by pair, and no task holds more than a chunk.
The highest count of each B id has a row per id of a vocabulary, which bounds what is
broadcast. A chunk holds one document at least, whole, however long.

A is a byte-level BPE file; it is read through ``tiktoken`` ranks, and through
``tokenizers`` where a run of one kind is too long for their pattern. B is a piece
model, which adds the space itself. Strings of special tokens are plain text.

Defined results: a text that is null, empty, or not given back exactly by both
tokenizers (B's normalisation changes some characters) has no tokens. Repeated rows
count each. An empty table gives an empty table. Ids may be null or repeat; other
columns stay outside.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from basketseq.llm import packing
from basketseq.llm.scratch import Scratch
from basketseq.llm.words import utf8
from basketseq.llm.worker import kept

#: Tokens of both sides after which a chunk ends.
CHUNK_TOKENS = 1 << 19
_SIDE = "array<int>"
ALIGNED = (
    f"a_ids {_SIDE}, b_ids {_SIDE}, a_groups {_SIDE}, b_groups {_SIDE}, "
    "overlaps array<struct<a int, b int, ends_together boolean>>"
)
#: A chunk's rows: its documents, then one row with its pairs.
_STORED = (
    "chunk long, id string, n_a long, n_b long, n_groups long, groups_sha256 string, "
    "links array<long>, counts array<long>"
)


class Tokenizers:
    """Both vocabularies, with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        self.fast, _ = packing.encoders(a_path)
        self.exact = Tokenizer.from_file(a_path)
        self.exact.encode_special_tokens = True
        size = self.exact.get_vocab_size()
        byte = packing._byte_of_character()
        self.a_bytes = [
            bytes(byte[c] for c in self.exact.id_to_token(i)) for i in range(size)
        ]
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [self._piece_bytes(i) for i in range(self.pieces.get_piece_size())]
        self.a_sizes, self.b_sizes = (
            np.array([len(b) for b in side]) for side in (self.a_bytes, self.b_bytes)
        )

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        if self.pieces.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encoded(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides; none where a side doesn't give the text back."""
        known = [t or "" for t in texts]
        found = []
        for text, b in zip(known, self.pieces.encode(known, num_threads=1), strict=True):
            a, whole = [], f" {text}"
            if text:
                a = (
                    self.exact.encode(whole, add_special_tokens=False).ids
                    if packing.LONG_RUN.search(whole)
                    else self.fast.encode_ordinary(whole)
                )
            raw = utf8(whole)
            same = (
                b"".join([self.a_bytes[i] for i in a]) == raw
                and b"".join([self.b_bytes[i] for i in b]) == raw
            )
            found.append((a, b) if text and same else ([], []))
        return found


class Aligned:
    """Groups and overlaps of the documents of a chunk.

    Documents lie behind each other on one byte axis. ``a``, ``b``: ids; ``a_doc``,
    ``b_doc``: whose they are; ``a_group``, ``b_group``: the group within the chunk.
    Overlaps: places in ``a`` and ``b``, and whether both end there.
    """

    def __init__(self, documents: list[tuple[list[int], list[int]]], sizes):
        self.a, self.a_doc = _flat([a for a, _ in documents])
        self.b, self.b_doc = _flat([b for _, b in documents])
        a_end, b_end = np.cumsum(sizes[0][self.a]), np.cumsum(sizes[1][self.b])
        start = np.concatenate([a_end - sizes[0][self.a], b_end - sizes[1][self.b]])
        end = np.concatenate([a_end, b_end])
        order = np.lexsort((end, start))
        reached = np.maximum.accumulate(end[order])
        breaks = np.ones(len(order), dtype=bool)
        breaks[1:] = start[order][1:] >= reached[:-1]
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.cumsum(breaks) - 1
        self.a_group, self.b_group = group[: len(self.a)], group[len(self.a) :]
        cuts = np.union1d(a_end, b_end)
        self.over_a = np.searchsorted(a_end, cuts)
        self.over_b = np.searchsorted(b_end, cuts)
        self.ends_together = a_end[self.over_a] == b_end[self.over_b]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    ids = np.fromiter(itertools.chain.from_iterable(lists), dtype=np.int64)
    return ids, np.repeat(np.arange(len(lists)), [len(one) for one in lists])


class GroupText:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``: each token once, with what follows it."""

    def __init__(self, a_size: int, b_size: int):
        self.a_size, self.b_size = a_size, b_size
        self.written = [
            f"{i}{after}" for n, afters in ((a_size, ",|"), (b_size, ",;"))
            for after in afters for i in range(n)
        ]

    def places(self, found: Aligned) -> np.ndarray:
        """Where in ``written`` the tokens of a chunk stand, in the order of the text."""
        sides = (found.a, found.a_group, self.a_size), (found.b, found.b_group, self.b_size)
        places = []
        for ids, groups, size in sides:
            last = np.ones(len(ids), dtype=bool)
            last[:-1] = groups[1:] != groups[:-1]
            places.append(ids + size * last)
        places[1] += 2 * self.a_size
        order = np.argsort(
            np.concatenate([2 * found.a_group, 2 * found.b_group + 1]), kind="stable"
        )
        return np.concatenate(places)[order]

    def digest(self, places: np.ndarray) -> str:
        """Hash of one document's groups; '' without tokens."""
        text = "".join([self.written[i] for i in places.tolist()])
        return hashlib.sha256(text[:-1].encode()).hexdigest() if text else ""


def aligned(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document the ids of both sides, each token's group, and all overlaps."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = kept(("alignment", a_path, b_path), lambda: Tokenizers(a_path, b_path))
        for batch in batches:
            rows = []
            for key, text in zip(batch["id"], batch["text"], strict=True):
                one = Aligned(both.encoded([text]), (both.a_sizes, both.b_sizes))
                pairs = zip(
                    one.over_a.tolist(), one.over_b.tolist(), one.ends_together.tolist(),
                    strict=True,
                )
                overlaps = [{"a": a, "b": b, "ends_together": e} for a, b, e in pairs]
                rows.append((key, one.a, one.b, one.a_group, one.b_group, overlaps))
            yield pd.DataFrame(
                rows, columns=["id", "a_ids", "b_ids", "a_groups", "b_groups", "overlaps"]
            )

    out = _named(docs, id_col, text_col).mapInPandas(walk, f"id string, {ALIGNED}")
    own_type = docs.schema[id_col].dataType
    return out.withColumn("id", F.col("id").cast(own_type)).withColumnRenamed("id", id_col)


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    # Ids travel as text: pandas would make floats of integers beside nulls.
    return docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))


def _chunk_rows(
    chunk: int, keys: list, documents: list, sizes: tuple, group_text: GroupText
) -> pd.DataFrame:
    found = Aligned(documents, sizes)
    numbers = np.arange(len(keys) + 1)
    a_at, b_at = np.searchsorted(found.a_doc, numbers), np.searchsorted(found.b_doc, numbers)
    together = found.ends_together
    a, b = found.over_a[together], found.over_b[together]
    links = found.a[a] << 32 | found.b[b]
    link_at = np.searchsorted(found.a_doc[a], numbers)
    places, rows = group_text.places(found), []
    for i, key in enumerate(keys):
        groups = found.a_group[a_at[i] : a_at[i + 1]]
        n_groups = int(groups[-1] - groups[0] + 1) if len(groups) else 0
        digest = group_text.digest(places[a_at[i] + b_at[i] : a_at[i + 1] + b_at[i + 1]])
        own = links[link_at[i] : link_at[i + 1]]
        rows.append((chunk, key, len(groups), b_at[i + 1] - b_at[i], n_groups, digest, own, None))
    pairs, counts = np.unique(links, return_counts=True)
    rows.append((chunk, None, 0, 0, 0, None, pairs, counts))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _STORED.split(", ")])


def _chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = kept(("alignment", a_path, b_path), lambda: Tokenizers(a_path, b_path))
        sizes = (both.a_sizes, both.b_sizes)
        group_text = GroupText(len(both.a_bytes), len(both.b_bytes))
        context = TaskContext.get()
        chunk = (context.partitionId() if context else 0) << 32
        keys, documents, held = [], [], 0
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.iloc[at : at + 64]
                for key, found in zip(part["id"], both.encoded(part["text"].tolist()), strict=True):
                    keys.append(key)
                    documents.append(found)
                    held += len(found[0]) + len(found[1])
                    if held >= CHUNK_TOKENS:
                        yield _chunk_rows(chunk, keys, documents, sizes, group_text)
                        chunk, keys, documents, held = chunk + 1, [], [], 0
        if keys:
            yield _chunk_rows(chunk, keys, documents, sizes, group_text)

    return docs.mapInPandas(walk, _STORED)


def pair_counts(lists: DataFrame) -> DataFrame:
    """(pair, total, best): corpus-wide links of each id pair, and whether no pair of its
    B id has more. ``lists`` holds (pair, n) of parts of the corpus."""
    totals = lists.groupBy("pair").agg(F.sum("n").alias("total"))
    b_id = F.expr("cast(pair & 4294967295L as int)")
    # One row per id of B's vocabulary at most.
    highest = totals.groupBy(b_id.alias("b")).agg(F.max("total").alias("highest"))
    return totals.join(F.broadcast(highest), b_id == F.col("b")).select(
        "pair", "total", (F.col("total") == F.col("highest")).alias("best")
    )


def link_scores(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: tokens, groups and links, how many links are their B id's most
    frequent ones in the corpus, the sum of the links' counts, and a digest of the groups."""
    scratch = Scratch(docs.sparkSession, "alignment")
    stored, _ = scratch.write(_chunks(_named(docs, id_col, text_col), a_path, b_path), "chunks")
    listed = F.explode(F.arrays_zip(F.col("links").alias("pair"), F.col("counts").alias("n")))
    lists = (
        stored.where("counts is not null")
        .select(F.col("chunk").alias("of_chunk"), listed.alias("listed"))
        .select("of_chunk", "listed.pair", "listed.n")
    )
    totals, _ = scratch.write(pair_counts(lists), "pairs")
    known = lists.select("of_chunk", "pair").join(totals, "pair")

    def score(documents: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        pairs = pairs.sort_values("pair")
        listed, total = pairs["pair"].to_numpy(), pairs["total"].to_numpy()
        best = pairs["best"].to_numpy(dtype=bool)
        n_best, count_sum = [], []
        for links in documents["links"]:
            at = np.searchsorted(listed, links)
            n_best.append(int(best[at].sum()))
            count_sum.append(int(total[at].sum()))
        scored = documents.drop(columns=["chunk", "links"])
        return scored.assign(n_best=n_best, count_sum=count_sum)

    columns = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    documents = stored.where("counts is null").withColumn(
        "n_links", F.size("links").cast("long")
    )
    out = (
        documents.select("chunk", *columns, "links")
        .groupBy("chunk")
        .cogroup(known.groupBy("of_chunk"))
        .applyInPandas(
            score,
            "id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "n_best long, count_sum long",
        )
    )
    own_type = docs.schema[id_col].dataType
    return out.select(
        F.col("id").cast(own_type).alias(id_col),
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    )
