"""Secrets in texts, found by one automaton for all rules (``automata``).

The rules are compiled on the driver and travel as arrays; each text is read once,
byte by byte, whatever the number of rules. Nothing is shuffled, and a task holds
one batch of texts.

A match is leftmost, longest and does not overlap others of its kind. It counts if
its value, which is what follows the rule's head, has ``least`` characters; a match
that fails is dropped after it has taken its place, so that nothing inside it is
looked at again. Spans are in code points, the end exclusive, sorted by start, then
by the order of the rules.

Defined results: a null and an empty text have no spans. Repeated rows have equal
spans. Whole texts are read, whatever their length. An empty table gives an empty
table. Other columns pass through, null ids too; one called like the result is
replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from basketseq.llm.automata import Backward, Nfa, Scanner
from basketseq.llm.words import utf8


@dataclass(frozen=True)
class Rule:
    """``least`` is for the characters of ``value``; ``head`` comes before it."""

    kind: str
    head: str
    value: str
    least: int


# The base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        r"[A-Za-z0-9+/_.=-]+",
        12,
    ),
    Rule("access", "", r"AKIA[A-Z0-9]+", 18),
    # Runs of less than four characters are no matches at all: nearly every word has some.
    Rule("hex", "", r"[0-9a-f]{4,}", 16),
)
# Published formats of further credentials.
MORE_RULES = (
    Rule("github", "", r"gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("slack", "", r"xox[abeoprs]-[A-Za-z0-9-]+", 24),
    Rule("jwt", "", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("private", "", r"-----BEGIN\x20([A-Z0-9]+\x20)*PRIVATE\x20KEY-----", 27),
)
RULES = BASE_RULES + MORE_RULES
SPAN = "array<struct<kind string, start long, end long>>"


class SecretScan:
    """The compiled rules."""

    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = tuple(rules)
        self.scanner = Scanner([f"{rule.head}({rule.value})" for rule in self.rules])
        # Read backwards, a reversed head is the head itself.
        self.heads = [
            Backward(Nfa(rule.head).reversed()) if rule.head else None for rule in self.rules
        ]

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) of one text, in code points."""
        if not text:
            return []
        raw, kept = utf8(text), []
        for rule, start, end in self.scanner.spans(raw):
            size = end - start
            if self.heads[rule]:
                # The longest head leaves the value: none of the value's characters
                # can follow a head and belong to it.
                size -= self.heads[rule].longest(raw[start:end][::-1])
            if size >= self.rules[rule].least:
                kept.append((start, rule, end))
        kept.sort()
        if len(raw) == len(text):
            return [(self.rules[r].kind, start, end) for start, r, end in kept]
        # Bytes to code points: continuation bytes don't count.
        places = np.concatenate(
            [[0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)]
        )
        return [(self.rules[r].kind, int(places[s]), int(places[e])) for s, r, e in kept]


def with_secrets(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` plus ``secrets``: an array of (kind, start, end)."""
    scan = SecretScan(rules)

    @F.pandas_udf(SPAN)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(
                [
                    [{"kind": k, "start": s, "end": e} for k, s, e in scan.spans(text)]
                    for text in texts
                ],
                dtype=object,
            )

    return docs.withColumn("secrets", found(F.col(text_col)))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def span_digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans as text."""
    spans = F.col("secrets")
    kinds = [rule.kind for rule in BASE_RULES]
    base = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return scanned.select(
        id_col,
        *(
            F.expr(f"cast(size(filter(secrets, s -> s.kind = '{kind}')) as long) as n_{kind}")
            for kind in kinds
        ),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )
