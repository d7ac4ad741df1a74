import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketseq.llm import packing
from tests.llm import edge

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, pieces, window=2048):
    tool = Tokenizer.from_file(PATH)
    wanted = collections.Counter()
    for r in rows:
        ids = tool.encode(r.text or "", add_special_tokens=False).ids + [1]
        wanted[r.doc_id, tuple(ids)] += 1
    # Pieces of equal documents can't be told apart; their parts have to add up.
    got = collections.Counter()
    for p in pieces:
        assert p.length == len(p.ids) and 0 < p.length <= window
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, dtype="<u4").tobytes())
        for i, x in enumerate(p.ids):
            got[p.doc_id, p.doc_tokens, p.start + i, x] += 1
    expected = collections.Counter()
    for (doc, ids), n in wanted.items():
        for i, x in enumerate(ids):
            expected[doc, len(ids), i, x] += n
    assert got == expected
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    fills = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        fills.append(at)
    return fills


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(3)
    fills = check(docs.collect(), packing.pack(docs, PATH).collect())
    assert sum(f < 2048 for f in fills) <= 3


def test_edge_rows(spark):
    docs = edge.frame(spark)
    check(docs.collect(), packing.pack(docs, PATH).collect())
    assert packing.pack(edge.empty(spark), PATH).count() == 0
    assert "ids" not in packing.pack(docs, PATH, with_ids=False).columns


@pytest.mark.parametrize(
    "text",
    ["<|endoftext|> a <|endoftext|>", "  lead", "tail \n\n ", "it's I'LL ñandú 你好 🙂", " " * 5000 + "x",
     "x" * 30_000, "\x00\x7f\xad\xa0", "ŀ1 2²"],
)
def test_both_encoders_agree(text):
    exact = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert packing.token_ids(text, PATH) == exact
    fast, _ = packing.encoders(PATH)
    if len(text) < 5000:
        assert fast.encode(text, allowed_special="all") == exact


def test_level_has_the_smallest_sum_of_squares():
    rng = np.random.default_rng(4)
    packer = packing.Packer(16, 0)
    for step in range(400):
        size = int(rng.integers(1, 16))
        counts = packer.counts.copy()

        def after(h, counts=counts, size=size):
            new = counts.copy()
            if h:
                new[h] -= 1
            if h + size < 16:
                new[h + size] += 1
            return int((new**2).sum())

        allowed = [h for h in range(16 - size + 1) if h == 0 or counts[h]]
        best = min(after(h) for h in allowed)
        level = packer.level_for(size)
        assert level == max(h for h in allowed if after(h) == best)
        packer.place(("doc", 0, [step] * size), size)
        assert all(len(packer.open[h]) == packer.counts[h] for h in range(16))


@pytest.mark.parametrize("seed", range(20))
def test_closing_cuts_into_gaps(seed):
    rng = np.random.default_rng(seed)
    packer, done, total = packing.Packer(16, 0), [], 0
    for doc in range(60):
        size = int(rng.integers(1, 17))
        total += size
        done += packer.place((doc, 0, list(range(size))), size)
    done += packer.close()
    fills = [sum(len(ids) for _, _, ids in pieces) for _, pieces in done]
    assert sum(fills) == total and max(fills) <= 16
    assert sum(f < 16 for f in fills) <= 1
    ids = collections.defaultdict(list)
    for _, pieces in done:
        for doc, start, part in pieces:
            ids[doc] += [start + i for i in range(len(part))]
            assert part == list(range(start, start + len(part)))
    assert all(sorted(v) == list(range(len(v))) for v in ids.values())
