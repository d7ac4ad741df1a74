import collections
import hashlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketseq.llm import alignment, registry
from tests.llm import edge

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "hi", "<|endoftext|> <s> </s> hi", "a▁b", "  two  spaces ", "ﬁ ligature",
    "tab\tx\n\ny", "日本語 text 🙂", "x" * 30_000, "\x00nul", "<0x41> <unk>", "naïve café", "hi", "hi",
]


def brute(text, a_model, b_model):
    """(a ids, b ids, groups as text, links)"""
    if not text:
        return [], [], [], []
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    raw = f" {text}".encode()
    a, b = a_model.encode(f" {text}", add_special_tokens=False).ids, b_model.encode(text)
    a_bytes = [bytes(byte[c] for c in a_model.id_to_token(i)) for i in a]
    b_bytes = [
        bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i)
        else b_model.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return [], [], [], []
    groups, links, i, j, a_end, b_end, a_from, b_from = [], [], 0, 0, 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if a_end <= b_end and i < len(a):
            a_end += len(a_bytes[i])
            i += 1
        else:
            b_end += len(b_bytes[j])
            j += 1
        if a_end == b_end:
            links.append((a[i - 1], b[j - 1]))
            groups.append(",".join(map(str, a[a_from:i])) + "|" + ",".join(map(str, b[b_from:j])))
            a_from, b_from = i, j
    return a, b, groups, links


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def check(found, source, models):
    """Rows by (doc_id, place of the text): every repeated row counts."""
    known = {text: brute(text, *models) for text in {t for _, t in source}}
    counts = collections.Counter(link for _, t in source for link in known[t][3])
    highest = collections.Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    want = []
    for key, text in source:
        a, b, groups, links = known[text]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(counts[link] == highest[link[1]] for link in links)
        total = sum(counts[link] for link in links)
        want.append((key, len(a), len(b), len(groups), len(links), best, total, digest))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


@pytest.mark.parametrize("chunk", [1 << 19, 40])
def test_equals_brute_force(spark, models, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "CHUNK_TOKENS", chunk)
    rows = [*enumerate(TEXTS), (None, "hi there"), (3, "hi there")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    registry.ship_package(spark)
    check(alignment.link_scores(docs, A, B).collect(), rows, models)


def test_query(spark, models):
    found = registry.op12_token_alignment(spark, "/root/testdata/sf0.001").collect()
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(found, [tuple(r) for r in source.collect()], models)


def test_overlaps_cover_what_is_shared(spark, models):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if t and len(t) < 99], "doc_id long, text string")
    both = alignment.Tokenizers(A, B)
    for r in alignment.aligned(docs, A, B).collect():
        a_end, b_end = (
            [sum(sizes[i] for i in ids[: k + 1]) for k in range(len(ids))]
            for ids, sizes in ((r.a_ids, both.a_sizes), (r.b_ids, both.b_sizes))
        )
        want = [
            (i, j, a_end[i] == b_end[j])
            for i in range(len(a_end)) for j in range(len(b_end))
            if max(([0] + a_end)[i], ([0] + b_end)[j]) < min(a_end[i], b_end[j])
        ]
        assert [tuple(o) for o in r.overlaps] == sorted(want)
        assert all(r.a_groups[i] == r.b_groups[j] for i, j, _ in want)
        assert len(set(r.a_groups)) == sum(e for _, _, e in want)


def test_edge_rows(spark, models):
    docs = edge.frame(spark)
    check(alignment.link_scores(docs, A, B).collect(), [(r[0], r[1]) for r in edge.ROWS], models)
    assert alignment.link_scores(edge.empty(spark), A, B).count() == 0
    assert alignment.aligned(docs.where(F.length("text") < 1000), A, B).count() > 5
