import base64
import collections
import random
import re

import pytest
import zstandard

from basketseq.llm import quality
from tests.llm import edge


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in collections.Counter(windows).items() if n > 1}
    inside = {i + j for i, w in enumerate(windows) if w in often for j in range(3)}
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    raw = text.encode()
    packer = zstandard.ZstdCompressor(level=3)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    kept = not failed
    if kept:
        ratio = len(packer.compress(raw)) / len(raw)
        for start, low, high in quality.WHOLE_BANDS:
            if len(raw) >= start:
                inside_band = low <= ratio <= high
        pieces = [raw[i : i + 4096] for i in range(0, len(raw), 4096)]
        kept = len(raw) < 150 or inside_band
        for piece in pieces:
            if len(piece) < 2048 < len(raw):
                piece = raw[-2048:]
            if len(piece) >= 2048:
                kept &= 0.25 <= len(packer.compress(piece)) / len(piece) <= 0.745
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "base_failed": failed,
        "kept": kept,
    }


def base64_words(n, seed):
    rng = random.Random(seed)
    return " ".join(base64.b64encode(rng.randbytes(9)).decode() for _ in range(n))


def han_words(n, seed):
    rng = random.Random(seed)
    letters = [chr(0x4E00 + rng.randrange(20_000)) for _ in range(1_500)]
    weights = [1 / (i + 10) for i in range(len(letters))]
    return " ".join("".join(rng.choices(letters, weights, k=rng.randint(2, 6))) for _ in range(n))


def checked(df):
    found = df.collect()
    for row in found:
        assert {k: row[k] for k in brute(row.text)} == brute(row.text), row.doc_id
    return found


def test_equals_brute_force_on_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = checked(quality.with_quality(docs.select("doc_id", "text")))
    assert len(found) == docs.count()
    assert 0.5 < sum(r.kept for r in found) / len(found) < 1


def test_edge_rows(spark):
    docs = edge.frame(spark)
    found = checked(quality.with_quality(docs))
    assert len(found) == len(edge.ROWS)
    assert {r.doc_id for r in found if r.kept} >= {6, 7, 8, 9, 12}
    assert [r.size for r in found] == ["x"] * len(found)
    kept = quality.keep_quality(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in found)
    assert quality.with_quality(edge.empty(spark)).count() == 0
    assert quality.keep_quality(edge.empty(spark)).count() == 0


@pytest.mark.parametrize(
    ("text", "kept"),
    [
        (edge.words(500, 3), True),
        # No window occurs twice, but the letters do: only compression shows it.
        (" ".join(f"{i:06d}abcdefghijklmnopqrstuvwxyz" * 2 for i in range(400)), False),
        ("".join(random.Random(1).choices([chr(c) for c in range(33, 127)] + [" "], k=9000)), False),
        # Six random bits a byte, in words; from 1,200 bytes on, or filling a chunk.
        (base64_words(100, 1), False),
        (base64_words(250, 2), False),
        (base64_words(900, 3), False),
        (edge.words(3000, 4) + " " + base64_words(700, 4) + " " + edge.words(3000, 6), False),
        # Three bytes a character, some of them frequent.
        (han_words(500, 1), True),
        (han_words(3000, 2), True),
        # A repetitive passage inside a long ordinary text.
        (edge.words(3000, 4) + " " + "".join(f"{i % 10}" for i in range(9000)) + edge.words(3000, 6), False),
        # The same at the end, shorter than half a chunk.
        (edge.words(3000, 4)[:8191] + " " + "a" * 2000, False),
        (edge.words(3000, 4)[:8191] + " " + edge.words(30, 5), True),
    ],
)
def test_bands(spark, text, kept):
    row = quality.with_quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert not row.base_failed
    assert row.kept is kept
