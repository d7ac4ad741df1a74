"""Packing tokenised documents into training sequences, by the sum-of-squares rule.

Each task packs the rows it reads as they come. A window is at a level, the
tokens it holds; an array counts the open windows of each level. A piece of s
tokens goes to the level h (0: a new window) for which the sum of the squared
counts afterwards is smallest: h loses a window, h + s gains one, a full window
counts no more. This keeps all levels about equally frequent, so that a fitting
gap is there for whatever length comes next. Ties go to the fullest window.

Documents longer than a window give full windows first, and their rest goes
through the rule. When a task has read its rows, what the open windows hold is
cut to fill gaps of the others (fullest first), so at most one window per task
is padded. Only open windows are held in memory: at most some per level.

Token ids are those of ``tokenizers`` for the given JSON file; each document
ends with ``end_id``. The encoding itself runs through the same vocabulary as
ranks of ``tiktoken``, which gives the same ids several times faster; texts with
a white-space run too long for its pattern go to ``tokenizers``.

Defined results: a null or empty text is one document of one token, ``end_id``.
Repeated rows are packed as documents of their own. Texts are packed whole,
whatever their length. An empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

WINDOW = 2048
END_ID = 1
#: What the byte-level pre-tokenizer of the vocabulary splits by (fixed).
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
LONG_RUN = re.compile(r"\s{2000}|\S{20000}")
SCHEMA = (
    "id string, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def _byte_of_character() -> dict[str, int]:
    """How a byte-level vocabulary writes bytes: printable ones as they are, the
    others in order from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_loaded: dict[str, tuple[tiktoken.Encoding, Tokenizer]] = {}


def encoders(path: str) -> tuple[tiktoken.Encoding, Tokenizer]:
    """Once per Python worker."""
    if path not in _loaded:
        _loaded[path] = _load(path)
    return _loaded[path]


def _load(path: str) -> tuple[tiktoken.Encoding, Tokenizer]:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    byte = _byte_of_character()
    ranks = {
        bytes(byte[c] for c in token): rank
        for token, rank in content["model"]["vocab"].items()
        if token not in special
    }
    fast = tiktoken.Encoding(
        "vocabulary", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=special
    )
    return fast, Tokenizer.from_file(path)


def token_ids(text: str | None, path: str) -> list[int]:
    fast, exact = encoders(path)
    if not text:
        return []
    if LONG_RUN.search(text):
        return exact.encode(text, add_special_tokens=False).ids
    return fast.encode(text, allowed_special="all")


class Packer:
    """Places pieces of documents into windows of one task."""

    def __init__(self, window: int, first_sequence: int):
        self.window = window
        self.next_sequence = first_sequence
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[tuple[int, list]]] = [[] for _ in range(window)]

    def _new(self) -> int:
        self.next_sequence += 1
        return self.next_sequence - 1

    def level_for(self, size: int) -> int:
        """The level that leaves the smallest sum of squared counts."""
        counts, full = self.counts, self.window - size
        levels = np.arange(full + 1)
        # Change of the sum: -2 N(h) + 1 where a window leaves, 2 N(h + s) + 1
        # where one arrives; nothing arrives at a full window's level.
        change = np.where(levels > 0, 1 - 2 * counts[: full + 1], 0)
        change += np.where(levels < full, 1 + 2 * counts[size:], 0)
        change[(counts[: full + 1] == 0) & (levels > 0)] = np.iinfo(np.int64).max
        return int(full - np.argmin(change[::-1]))

    def place(self, piece: tuple, size: int) -> list[tuple]:
        """Puts a piece away; gives (sequence, pieces) of the window if it is full."""
        if size == self.window:
            return [(self._new(), [piece])]
        level = self.level_for(size)
        if level:
            self.counts[level] -= 1
            sequence, pieces = self.open[level].pop()
        else:
            sequence, pieces = self._new(), []
        pieces.append(piece)
        if level + size == self.window:
            return [(sequence, pieces)]
        self.counts[level + size] += 1
        self.open[level + size].append((sequence, pieces))
        return []

    def close(self) -> list[tuple]:
        """Cuts the emptiest windows' pieces to fill the others; all windows."""
        windows = [
            [level, sequence, pieces]
            for level in range(self.window)
            for sequence, pieces in self.open[level]
        ]
        done, low, high = [], 0, len(windows) - 1
        while low < high:
            level, sequence, pieces = windows[high]
            gap = self.window - level
            while gap and low < high:
                doc, start, ids = windows[low][2].pop()
                taken, left = ids[:gap], ids[gap:]
                pieces.append((doc, start, taken))
                if left:
                    windows[low][2].append((doc, start + len(taken), left))
                gap -= len(taken)
                low += not windows[low][2]
            windows[high][0] = self.window - gap
            done.append((sequence, pieces))
            high -= 1
        if low == high:
            done.append((windows[low][1], windows[low][2]))
        return [w for w in done if w[1]]


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """A row for each piece: where it is in its document (``start``), where in the
    sequences (``sequence_id``, ``offset``), and ``ids`` themselves if ``with_ids``.

    Sequence ids are unique, not gapless: the task in the upper bits, a counter
    below. ``tokenizer`` is the path of a byte-level BPE file, the same on all
    machines. No row is shuffled.
    """
    columns = SCHEMA + (", ids array<int>" if with_ids else "")
    names = [column.split()[0] for column in columns.split(", ")]

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        packer = Packer(window, (context.partitionId() if context else 0) << 32)

        def rows(windows: list[tuple]) -> Iterator[tuple]:
            for sequence, pieces in windows:
                offset = 0
                for (doc, total), start, ids in pieces:
                    raw = np.asarray(ids, dtype="<u4")
                    place = (doc, start, len(ids), zlib.crc32(raw.tobytes()), total)
                    tail = (raw.astype(np.int32),) if with_ids else ()
                    yield (*place, sequence, offset, *tail)
                    offset += len(ids)

        for batch in batches:
            found: list[tuple] = []
            for doc, text in zip(batch["id"], batch["text"], strict=True):
                ids = [*token_ids(text, tokenizer), end_id]
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    found.extend(
                        rows(packer.place(((doc, len(ids)), start, piece), len(piece)))
                    )
                if len(found) > 500:
                    yield pd.DataFrame(found, columns=names)
                    found = []
            yield pd.DataFrame(found, columns=names)
        yield pd.DataFrame(list(rows(packer.close())), columns=names)

    # Ids travel as text: pandas would make floats of integers beside nulls.
    named = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    out = named.mapInPandas(packed, columns)
    own_type = docs.schema[id_col].dataType
    return out.select(F.col("id").cast(own_type).alias(id_col), *out.columns[1:])
