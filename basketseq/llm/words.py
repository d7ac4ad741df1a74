"""Words and word windows of one text as numpy arrays of 64-bit hashes.

A word is a longest run of characters other than the six ASCII white-space
characters (0x20, 0x09-0x0D). In UTF-8 those bytes stand for nothing else, so
bytes and characters cut the text alike. Every function takes whole texts and
costs a fixed number of passes over them.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers = {}


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < length + 1:
        size = 1 << (length + 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "replace")


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word."""
    gap = np.ones(len(data) + 2, dtype=np.int8)
    gap[1:-1] = SPACE[data]
    edges = np.flatnonzero(np.diff(gap))
    return edges[0::2], edges[1::2]


def word_hashes(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    # The sum over a word, moved to where a word at byte 0 would be.
    spans = (sums[ends] - sums[starts]) * down[starts]
    return mixed(spans + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` words, in text order; shorter: none."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        total += words[i : i + n] * _WINDOW[i]
    return mixed(total)


def shingle_set(raw: bytes, size: int) -> np.ndarray:
    """Sorted distinct windows; a text of fewer words is one window as a whole."""
    words = word_hashes(raw)
    return np.unique(window_hashes(words, min(size, len(words)) or size))
