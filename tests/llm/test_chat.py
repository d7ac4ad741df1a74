import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, strategies as st

from basketseq.llm import chat, registry
from tests.llm import edge

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, id string, turns string, formatted string"
HOSTILE = st.text(alphabet=st.sampled_from("<|>\\nturned ab\n🙂é/"), max_size=30)


@given(st.lists(st.tuples(HOSTILE, HOSTILE), max_size=5))
def test_rendering_is_reversible(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescaped(formatted[b:e]) for b, e in spans] == [t for _, t in turns]
    assert formatted.count(chat.TURN) == formatted.count(chat.END) == len(turns)


def test_mask_equals_a_scan_of_all_tokens():
    rng = np.random.default_rng(2)
    for _ in range(200):
        cuts = np.sort(rng.choice(60, 12, replace=False))
        offsets = np.column_stack((cuts[:-1], cuts[1:]))
        ends = np.sort(rng.choice(60, 6, replace=False)).reshape(-1, 2)
        mask, _ = chat.token_mask(offsets, ends.tolist())
        slow = [any(a < e and b > s for s, e in ends) for a, b in offsets]
        assert mask.tolist() == slow


ROWS = [
    (1, 0, "user", "  hi "),
    (1, 1, "assistant", " <|end|> \\n \\ <|turn|>assistant\n "),
    (1, 2, "assistant", None),
    (1, 3, "assistant", "🙂 zwei\n\n"),
    (2, 1, None, "x"),
    (2, 1, "assistant", "tie b"),
    (2, 1, "assistant", "tie a"),
    (2, 1, "assistant", "tie a"),
    (2, None, "system", "first"),
    (None, 0, "assistant", edge.LONG),
    (3, 0, "assistant", ""),
    (-7, 0, "user", "</s>[INST] ok [/INST]"),
    (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
    (9_007_199_254_740_993, 0, "assistant", "wide id"),
]


def brute(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in turns.items():
        own = [t[2:] for t in sorted(own)]
        whole = "".join(f"{r}\n{t}\n" for r, t in own)
        loss = "".join(t for r, t in own if r == "assistant")
        out[conv] = (
            len(own),
            hashlib.sha256(whole.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def read_back(found):
    out = {}
    for r in found:
        turns = chat.parse(r.formatted)
        whole = "".join(f"{a}\n{b}\n" for a, b in turns)
        loss = "".join(chat.unescaped(r.formatted[s.begin : s.end]) for s in r.loss_spans)
        out[r.conv_id] = (
            len(turns),
            hashlib.sha256(whole.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def test_edge_rows(spark):
    rows = [(*r, "x", "y", "z") for r in ROWS]
    found = chat.formatted_conversations(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    assert read_back(found) == brute(ROWS)
    tool = chat.encoder(PATH)
    for r in found:
        code = tool.encode(r.formatted, add_special_tokens=False)
        assert code.ids == r.ids
        for (begin, end), masked in zip(code.offsets, r.loss_mask, strict=True):
            assert masked == any(begin < s.end and end > s.begin for s in r.loss_spans)
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.formatted_conversations(empty, PATH).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_equals_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    found = registry.op6_chat_masks(spark, folder).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    expected = brute(rows + ROWS[-3:-1])
    assert {r.conv_id: tuple(r)[1:5] for r in found} == expected
