r"""Chat formatting with loss masks aligned to token offsets.

A conversation is rendered as a whole, encoded once with character offsets, and
the sorted spans of its turns are intersected with the sorted token spans by
binary search: two searches over the token ends and starts find the tokens of
each turn. Tokens of assistant texts carry the loss.

Rendered form, with the two control strings ``<|turn|>`` and ``<|end|>``:

    <|turn|>ROLE\nTEXT<|end|>\n      per turn

Inside roles and texts ``\`` becomes ``\\`` and ``<|`` becomes ``<\|``, so no text
can contain a control string; a line break inside a role becomes ``\n``. Reading
back undoes this exactly. The control strings are special tokens of the encoder,
which never merges across them; the text after ROLE's line break may share a
token with it, so a mask is kept as token span and character span: ``loss_spans``
are the characters the masked tokens and the turns have in common.

Defined results: a null text is empty, a null role is the empty role. Turns are
ordered by turn (nulls first), then role, then text, so ties and repeated rows
have a fixed order and each stays a turn. An empty table gives an empty table.
Other columns do not take part. A conversation is one row of the result, so one
task holds one conversation; that is the only bound on its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

TURN, END = "<|turn|>", "<|end|>"
LOSS_ROLE = "assistant"
ENCODED_AT_ONCE = 64
SCHEMA = (
    "id string, formatted string, ids array<int>, loss_mask array<boolean>, "
    "loss_spans array<struct<begin: int, end: int>>"
)
_loaded: dict[str, Tokenizer] = {}


def encoder(path: str) -> Tokenizer:
    """The tokenizer with the control strings as special tokens; once per worker."""
    if path not in _loaded:
        _loaded[path] = Tokenizer.from_file(path)
        _loaded[path].add_special_tokens([TURN, END])
    return _loaded[path]


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def render(turns: Sequence[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the character span of each text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{TURN}{escaped(role).replace(chr(10), chr(92) + 'n')}\n"
        body = escaped(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((unescaped(role), unescaped(rest[: rest.rindex(END)])))
    return turns


def token_mask(
    offsets: np.ndarray, spans: Sequence[tuple[int, int]]
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens overlap a span, and the characters they share with it.

    ``offsets`` (n, 2) and ``spans`` are sorted and each free of overlaps, but
    for tokens that hold parts of one character and so share its offsets.
    """
    mask = np.zeros(len(offsets), dtype=bool)
    shared = []
    for begin, end in spans:
        if begin == end:
            continue
        first = int(np.searchsorted(offsets[:, 1], begin, side="right"))
        last = int(np.searchsorted(offsets[:, 0], end, side="left"))
        mask[first:last] = True
        if first < last:
            shared.append((max(begin, int(offsets[first, 0])), min(end, int(offsets[last - 1, 1]))))
    return mask, shared


def formatted_conversations(
    turns: DataFrame,
    tokenizer: str,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = LOSS_ROLE,
) -> DataFrame:
    """A row per conversation: rendered text, token ids, token mask, loss spans."""
    names = ["id", "formatted", "ids", "loss_mask", "loss_spans"]

    def formatted(part: pd.DataFrame, tool: Tokenizer) -> list[tuple]:
        rendered = [[(t["role"], t["text"]) for t in turns] for turns in part["turns"]]
        texts = [render(turns) for turns in rendered]
        codes = tool.encode_batch([text for text, _ in texts], add_special_tokens=False)
        rows = []
        for key, turns, (text, spans), code in zip(
            part["id"], rendered, texts, codes, strict=True
        ):
            wanted = [s for s, (role, _) in zip(spans, turns, strict=True) if role == loss_role]
            offsets = np.asarray(code.offsets, dtype=np.int64).reshape(-1, 2)
            mask, shared = token_mask(offsets, wanted)
            marks = [{"begin": b, "end": e} for b, e in shared]
            rows.append((key, text, code.ids, mask.tolist(), marks))
        return rows

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = encoder(tokenizer)
        for batch in batches:
            # Encodings with offsets are many times their text: some at a time.
            for start in range(0, len(batch), ENCODED_AT_ONCE):
                part = batch.iloc[start : start + ENCODED_AT_ONCE]
                yield pd.DataFrame(formatted(part, tool), columns=names)

    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    # Ids travel as text: pandas would make floats of integers beside nulls.
    whole = turns.groupBy(F.col(id_col).cast("string").alias("id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    out = whole.mapInPandas(encoded, SCHEMA)
    own_type = turns.schema[id_col].dataType
    return out.select(F.col("id").cast(own_type).alias(id_col), *out.columns[1:])
