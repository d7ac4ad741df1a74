"""Quality rules by compression bands.

A text that says the same thing again compresses too well, random characters
hardly at all. Each text is compressed whole with zstandard, and once more in
fixed chunks, so that a repetitive passage inside a long text shows too. The
ratio (compressed / raw bytes) has to lie inside a band that depends on the
length, since short texts compress less.

Defined results: a null text counts as empty. A text without words has zero
counts and fails the base rule. Lengths are bytes of UTF-8; no text is cut.
Rows are judged one by one, so repeated rows and ties get equal verdicts. Other
columns pass through untouched, also where they share a name with a verdict
column (the verdict then replaces them).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from basketseq.llm.words import utf8, window_hashes, word_hashes

#: (from this many bytes, lowest, highest whole-text ratio). Below the first
#: length nothing can be said; frame overhead alone is a large share there.
#: The upper limits lie below 0.745, what base64 in words comes to, as soon as the
#: frame's share allows, and above what letters of any script come to.
WHOLE_BANDS = (
    (150, 0.40, 1.00),
    (300, 0.40, 0.92),
    (600, 0.36, 0.80),
    (1_200, 0.34, 0.75),
    (2_500, 0.32, 0.74),
    (5_000, 0.30, 0.74),
    (10_000, 0.28, 0.74),
)
CHUNK_BYTES = 4_096
#: Ratios that every chunk of at least half that size has to keep. A shorter last
#: chunk is judged together with what precedes it, half a chunk in all.
CHUNK_BAND = (0.25, 0.745)
LEVEL = 3
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "whole_ratio double, lowest_chunk_ratio double, highest_chunk_ratio double, "
    "base_failed boolean, kept boolean"
)


def repeated_words(words: np.ndarray, size: int = REPEAT_WINDOW) -> int:
    """Words inside windows that occur at least twice, the first time included."""
    windows = window_hashes(words, size)
    if not len(windows):
        return 0
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(counts[place] > 1)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + size, -1)
    return int(np.count_nonzero(np.cumsum(change[:-1])))


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            repeats += line in seen
            seen.add(line)
    return repeats


def ratios(raw: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, float, float]:
    """Whole ratio and the lowest and highest chunk ratio (NaN where undefined)."""
    if not raw:
        return np.nan, np.nan, np.nan
    whole = len(packer.compress(raw)) / len(raw)
    half = CHUNK_BYTES // 2
    pieces = [raw[i : i + CHUNK_BYTES] for i in range(0, len(raw), CHUNK_BYTES)]
    if len(pieces) > 1 and len(pieces[-1]) < half:
        pieces[-1] = raw[-half:]
    chunks = [len(packer.compress(p)) / len(p) for p in pieces if len(p) >= half]
    return (whole, min(chunks), max(chunks)) if chunks else (whole, np.nan, np.nan)


def inside_bands(
    n_bytes: int,
    whole: float,
    lowest: float,
    highest: float,
    bands: Sequence[tuple[int, float, float]] = WHOLE_BANDS,
    chunk_band: tuple[float, float] = CHUNK_BAND,
) -> bool:
    band = next((b for b in reversed(bands) if n_bytes >= b[0]), None)
    if band and not band[1] <= whole <= band[2]:
        return False
    return not (lowest < chunk_band[0] or highest > chunk_band[1])


def judge(text: str | None, packer: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    raw = utf8(text)
    words = word_hashes(raw)
    n = len(words)
    gaps = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    repeats = repeated_words(words)
    whole, lowest, highest = ratios(raw, packer)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    return (
        n,
        len(text) - gaps,
        sum(text.count(c) for c in SYMBOLS),
        repeated_lines(text),
        repeats,
        whole,
        lowest,
        highest,
        failed,
        not failed and inside_bands(len(raw), whole, lowest, highest),
    )


def quality_verdict(text: Column) -> Column:
    names = [column.split()[0] for column in VERDICT.split(", ")]

    @F.pandas_udf(VERDICT)
    def verdicts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for texts in batches:
            yield pd.DataFrame([judge(text, packer) for text in texts], columns=names)

    return verdicts(text)


def with_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the verdict columns; row by row, without a shuffle."""
    verdict = quality_verdict(F.col(text_col))
    names = [column.split()[0] for column in VERDICT.split(", ")]
    # Inside structs no name of ``docs`` can clash with a helper's.
    rest = [c for c in docs.columns if c not in names]
    judged = docs.select(F.struct(*rest).alias("row"), verdict.alias("verdict"))
    return judged.select("row.*", "verdict.*")


def keep_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    judged = docs.select(
        F.struct(*docs.columns).alias("row"), quality_verdict(F.col(text_col)).alias("verdict")
    )
    return judged.where("verdict.kept").select("row.*")
