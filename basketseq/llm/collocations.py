"""Collocations: phrases of two or three words that occur together more than apart.

1. Word counts per language, summed within chunks of a task first. Their order by
   (language, word) is cut into ranges of about ``RANGE_WORDS`` occurrences; only the
   bounds of the ranges reach the driver (``MAX_RANGES`` at most, ``BOUND_BYTES`` each).
2. Each chunk of a task counts its n-grams of one to three words and writes them as
   weighted acyclic automata (``transducers``), one per language and prefix range:
   the range of the first word, then, where that range is heavy (a hot word), that of
   the second one, then likewise the third. So a hot prefix spreads over ranges, and
   an n-gram itself weighs one entry per chunk.
3. Automata of the same prefix range are united and their weights summed. Sequences
   below the least count are left out then: what is too rare can neither be a
   candidate nor be a part of one, since parts occur at least as often.
4. Candidates are read from the united automata; their parts go to the range of each
   part and are composed with the automaton there, which gives their counts.
5. The lowest-scoring cut counts; candidates that a longer one contains in half of
   their occurrences or more are dropped; each language keeps its highest-scoring ones
   (Spark limits the rank before it shuffles).

Defined results: texts are lower-cased (A-Z), cut at ``.,;:!?`` and line breaks into
pieces, those at spaces and tabs into words. A null or empty text has no words. A null
language is ``und``. Repeated rows count each. Whole texts are counted, whatever their
length: a long one is counted in several chunks that overlap by two words. An empty
table gives an empty table. Other columns stay outside.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import count as counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from basketseq.llm.prefix_sums import sums_before
from basketseq.llm.scratch import Scratch
from basketseq.llm.transducers import DEPTH, Transducer, code_of, of_groups, union, words_of
from basketseq.llm.words import utf8

#: Word occurrences that a chunk counts at once, and that a prefix range is about.
CHUNK_WORDS = 1 << 20
RANGE_WORDS = 1 << 20
#: Sequences whose automata are built at once, about.
BLOCK_SEQUENCES = 1 << 18
MAX_RANGES = 1 << 14
BOUND_BYTES = 32
LEAST_COUNT = 10
TOP = 2_000
SCALE = 1_000_000
#: A longer candidate with this share (in percent) of the occurrences drops a shorter one.
COVERED_PERCENT = 50
UNKNOWN = "und"

#: No byte of UTF-8: the mark between pieces.
_CUT = 0xFF
_READ = bytes(
    _CUT if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else 32 if c == 9 else c
    for c in range(256)
)
_MARK = bytes([_CUT])
_SPACED = b" \xff "


def tokens(text: str | None) -> list[bytes]:
    """Words in order, with marks between pieces."""
    return utf8(text).translate(_READ).replace(_MARK, _SPACED).split()


class Chunk:
    """Words of one language, as numbers by first appearance; 0 is a mark."""

    def __init__(self):
        self.number: dict[bytes, int] = defaultdict(counter().__next__)
        self.number[_MARK]
        self.parts: list[tuple[np.ndarray, int]] = []
        self.size = 0

    def add(self, words: list[bytes], counted: int) -> None:
        """The first ``counted`` words start n-grams, the others only continue them."""
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        self.parts.append((numbers, counted))
        self.size += len(words)

    def counted(self, depth: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words sorted by their bytes, codes of all n-grams over them, and counts."""
        names = list(self.number)[1:]
        order = sorted(range(len(names)), key=names.__getitem__)
        rank = np.zeros(len(names) + 1, dtype=np.int64)
        rank[np.array(order, dtype=np.int64) + 1] = np.arange(1, len(names) + 1)
        gap = np.zeros(DEPTH - 1, dtype=np.int32)
        ids = np.concatenate([piece for part, _ in self.parts for piece in (part, gap)])
        starts = np.zeros(len(ids), dtype=bool)
        at = 0
        for part, counted in self.parts:
            starts[at : at + counted] = True
            at += len(part) + len(gap)
        ranked = rank[ids]
        columns, codes, alive = [], [], starts
        for place in range(depth):
            moved = np.zeros(len(ids), dtype=np.int64)
            moved[: len(ids) - place] = ranked[place:]
            columns.append(moved)
            alive = alive & (moved > 0)
            codes.append(code_of([c[alive] for c in columns]))
        codes, counts = np.unique(np.concatenate(codes), return_counts=True)
        return [names[i] for i in order], codes, counts


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Chunk]]:
    """Chunks of a task's texts per language, each as soon as it is full."""
    held: dict[str, Chunk] = {}
    # Words held, and those of them that differ, which take more memory.
    total = names = 0
    # Below the words that an automaton can tell apart, also for a chunk nearly full.
    most = max(1, CHUNK_WORDS // 2)
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            words = tokens(text)
            for at in range(0, len(words), most):
                part = words[at : at + most + DEPTH - 1]
                chunk = held.setdefault(lang, Chunk())
                known = len(chunk.number)
                chunk.add(part, min(most, len(part)))
                total, names = total + len(part), names + len(chunk.number) - known
                full = [lang] if chunk.size >= CHUNK_WORDS else []
                # Many languages at once: none may be full, but all together are.
                if total >= 4 * CHUNK_WORDS or names >= CHUNK_WORDS:
                    by_size = sorted(held, key=lambda lang: held[lang].size, reverse=True)
                    full = by_size[: -(-len(by_size) // 4)]
                for one in full:
                    chunk = held.pop(one)
                    total, names = total - chunk.size, names - len(chunk.number) + 1
                    yield one, chunk
    yield from held.items()


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text")
    ).where("length(text) > 0")


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, f)"""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, chunk in _chunks(batches):
            words, codes, counts = chunk.counted(1)
            if len(counts):
                names = [word.decode("utf-8", "replace") for word in words]
                found = np.array(names, dtype=object)[words_of(codes)[:, 0] - 1]
                yield pd.DataFrame({"lang": lang, "word": found, "f": counts})

    counted = texts.mapInPandas(walk, "lang string, word string, f long")
    return counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))


class Ranges:
    """Bounds over (language, word), and which ranges are heavy."""

    def __init__(self, bounds: list[tuple[bytes, bytes]], heavy: list[bool]):
        self.bounds, self.heavy = bounds, heavy

    @classmethod
    def of(cls, words: DataFrame, scratch: Scratch) -> Ranges:
        """From word counts: about ``RANGE_WORDS`` occurrences each, more where that
        would be more than ``MAX_RANGES`` ranges."""
        total = words.agg(F.sum("f")).first()[0] or 0
        size = max(RANGE_WORDS, -(-total // (MAX_RANGES - 1)))
        summed = sums_before(
            words, None, [F.asc("lang"), F.asc("word")], {"before": "f"}, scratch
        )
        first = F.min(F.struct("lang", "word"))
        found = (
            summed.groupBy(F.expr(f"before div {size}").alias("range"))
            .agg(first.alias("first"), F.sum("f").alias("weight"))
            .select(
                F.substring(F.encode("first.lang", "UTF-8"), 1, BOUND_BYTES).alias("lang"),
                F.substring(F.encode("first.word", "UTF-8"), 1, BOUND_BYTES).alias("word"),
                (F.col("weight") > 2 * size).alias("heavy"),
            )
            .orderBy("range")
            .collect()
        )
        return cls([(bytes(r.lang), bytes(r.word)) for r in found], [r.heavy for r in found])

    def of_words(self, lang: str, words: list[bytes]) -> list[int]:
        key = utf8(lang)[:BOUND_BYTES]
        return [bisect_right(self.bounds, (key, word[:BOUND_BYTES])) for word in words]

    def is_heavy(self, number: int) -> bool:
        return number > 0 and self.heavy[number - 1]

    def paths(self, lang: str, words: list[bytes], numbers: np.ndarray) -> np.ndarray:
        """Prefix ranges of sequences (word numbers from 1 into ``words``)."""
        of_word = np.array([0, *self.of_words(lang, words)], dtype=np.int64)
        heavy = np.array([self.is_heavy(i) for i in of_word.tolist()])
        path = np.zeros(len(numbers), dtype=np.int64)
        deeper = np.ones(len(numbers), dtype=bool)
        for place in range(DEPTH):
            column = numbers[:, place]
            path = path * (MAX_RANGES + 2) + np.where(deeper & (column > 0), of_word[column] + 1, 0)
            deeper = deeper & heavy[column]
        return path


def range_automata(texts: DataFrame, ranges: Ranges) -> DataFrame:
    """(lang, path, automaton): the n-grams of a chunk within a prefix range."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, chunk in _chunks(batches):
            words, codes, counts = chunk.counted(DEPTH)
            if not len(codes):
                continue
            paths = ranges.paths(lang, words, words_of(codes))
            order = np.argsort(paths, kind="stable")
            starts = np.flatnonzero(np.diff(paths[order], prepend=-1))
            # Whole ranges, a block of them at once.
            blocks = np.flatnonzero(np.diff(starts // BLOCK_SEQUENCES, prepend=-1))
            for some in np.split(order, starts[blocks[1:]]):
                groups = np.cumsum(np.diff(paths[some], prepend=paths[some[0]]) != 0)
                built = of_groups(words, codes[some], counts[some], groups)
                found = paths[some[np.flatnonzero(np.diff(groups, prepend=-1))]]
                packed = [automaton.packed() for automaton in built]
                yield pd.DataFrame({"lang": lang, "path": found, "automaton": packed})

    return texts.mapInPandas(walk, "lang string, path long, automaton binary")


def united(automata: DataFrame, least: int) -> DataFrame:
    """One automaton per language and prefix range, weights summed."""

    def unite(found: pd.DataFrame) -> pd.DataFrame:
        whole = union([Transducer.unpacked(data) for data in found["automaton"]], least)
        if not whole.words:
            return found.iloc[:0]
        return found.iloc[:1].assign(automaton=[whole.packed()])

    return automata.groupBy("lang", "path").applyInPandas(
        unite, "lang string, path long, automaton binary"
    )


def candidate_parts(automata: DataFrame, ranges: Ranges) -> DataFrame:
    """(lang, phrase, a, cut, side, part, path): both parts of each cut of each phrase
    of two words or more, with the prefix range of the part."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, data in zip(batch["lang"], batch["automaton"], strict=True):
                yield _parts(lang, Transducer.unpacked(data), ranges)

    return automata.select("lang", "automaton").mapInPandas(
        walk, "lang string, phrase string, a long, cut int, side string, part string, path long"
    )


def _parts(lang: str, automaton: Transducer, ranges: Ranges) -> pd.DataFrame:
    codes, counts = automaton.entries()
    numbers = words_of(codes)
    long = numbers[:, 1] > 0
    numbers, counts = numbers[long], counts[long]
    names = np.array(
        ["", *(word.decode("utf-8", "replace") for word in automaton.words)], dtype=object
    )
    frames = []
    for size in range(2, DEPTH + 1):
        here = (numbers > 0).sum(axis=1) == size
        columns = numbers[here]
        phrase = _joined(names, columns[:, :size])
        for cut in range(1, size):
            for side, places in (("l", slice(0, cut)), ("r", slice(cut, size))):
                part = np.zeros_like(columns)
                width = places.stop - places.start
                part[:, :width] = columns[:, places]
                frames.append(
                    pd.DataFrame(
                        {
                            "lang": lang, "phrase": phrase, "a": counts[here], "cut": cut,
                            "side": side, "part": _joined(names, part[:, :width]),
                            "path": ranges.paths(lang, automaton.words, part),
                        }
                    )
                )
    return pd.concat(frames)


def _joined(names: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    text = names[numbers[:, 0]]
    for column in numbers.T[1:]:
        text = text + " " + names[column]
    return text


def composed(parts: DataFrame, automata: DataFrame) -> DataFrame:
    """``parts`` with ``f``, the count of each part, from the automaton of its range."""

    def look_up(asked: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        asked = asked.drop(columns="path")
        if not len(asked) or not len(found):
            return asked.iloc[:0].assign(f=0)
        automaton = Transducer.unpacked(found["automaton"].iloc[0])
        sequences = [tuple(utf8(part).split(b" ")) for part in asked["part"]]
        return asked.assign(f=automaton.weights_of(sequences))

    other = automata.select(F.col("lang").alias("of_lang"), F.col("path").alias("of_path"), "automaton")
    return parts.groupBy("lang", "path").cogroup(other.groupBy("of_lang", "of_path")).applyInPandas(
        look_up, "lang string, phrase string, a long, cut int, side string, part string, f long"
    )


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = LEAST_COUNT,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases."""
    scratch = Scratch(docs.sparkSession, "collocations")
    texts = _texts(docs, lang_col, text_col)
    words, words_path = scratch.write(word_counts(texts), "words")
    sizes, _ = scratch.write(words.groupBy("lang").agg(F.sum("f").alias("n")), "sizes")
    ranges = Ranges.of(words, scratch)
    scratch.drop(words_path)
    automata, _ = scratch.write(united(range_automata(texts, ranges), least), "automata")
    parts, _ = scratch.write(
        composed(candidate_parts(automata, ranges), automata), "parts"
    )
    # Exact up to 10**16 occurrences of a phrase.
    wide = "decimal(16,0)"
    score = F.expr(
        f"cast({SCALE} * (cast(a as {wide}) * cast(a as {wide})) div (cast(l as {wide}) * cast(r as {wide})) as bigint)"
    )

    def count(side: str):
        return F.max(F.when(F.col("side") == side, F.col("f"))).alias(side)

    cuts = (
        parts.groupBy("lang", "phrase", "cut")
        .agg(F.max("a").alias("a"), count("l"), count("r"))
        .withColumn("score", score)
    )
    lowest = cuts.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("low")
    )
    # Parts of two words or more are the shorter phrases within a longer candidate.
    covers = (
        parts.where("part like '% %'")
        .groupBy("lang", F.col("part").alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    found = lowest.join(covers, ["lang", "phrase"], "left").where(
        f"longer is null or 100 * longer < {COVERED_PERCENT} * a"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("low.score"), F.desc("a"), F.asc("phrase"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .join(sizes, "lang")
        .select(
            "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "low.l", "low.r", "n", "low.score"
        )
    )
