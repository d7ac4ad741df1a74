import collections
import random
import re

import duckdb
import numpy as np
import pytest

from basketseq.llm import collocations, registry, transducers
from tests.llm import edge


def brute(rows, least=10, top=2000):
    """rows: (lang, text)"""
    lower = {c: c + 32 for c in range(65, 91)}
    n, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    candidates = {key: a for key, a in f.items() if len(key) > 2 and a >= least}
    found = collections.defaultdict(list)
    for (lang, *words), a in candidates.items():
        longer = [
            b for (other, *more), b in candidates.items()
            if other == lang and len(more) > len(words) and words in (more[:2], more[1:])
        ] if len(words) == 2 else []
        if any(100 * b >= 50 * a for b in longer):
            continue
        score, k = min(
            (1_000_000 * a * a // (f[lang, *words[:k]] * f[lang, *words[k:]]), k)
            for k in range(1, len(words))
        )
        l, r = f[lang, *words[:k]], f[lang, *words[k:]]
        found[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, n[lang], -score)
        for lang, phrases in found.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(phrases)[:top], 1)
    )


def random_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "b", "é", "É", "the", "of", "x" * 50, "ÿ", "z\x1cz"]
    weights = [40, 10, 10, 5, 5, 20, 5, 1, 3, 1]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\x0b", "\r\n", "?", " ", "\x1f"]
    rows = [
        (rng.choice(["en", "fr", None, "und"]),
         "".join(w + rng.choice(gaps) for w in rng.choices(words, weights, k=rng.randint(0, 60))))
        for _ in range(n)
    ]
    return [*rows, ("en", None), (None, ""), ("solo", "only one, language here"), ("fr", " .,;\n ")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


@pytest.mark.parametrize(("seed", "chunk", "size"), [(1, 1 << 19, 1 << 20), (2, 50, 40), (3, 7, 15)])
def test_equals_brute_force(spark, monkeypatch, seed, chunk, size):
    """The last ones with hot words in ranges of their own, and long texts in chunks."""
    monkeypatch.setattr(collocations, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(collocations, "RANGE_WORDS", size)
    rows = random_rows(seed)
    found = collocations.collocations(frame(spark, rows).repartition(3), top=20)
    assert sorted(map(tuple, found.collect())) == brute(rows, top=20)


def test_heavy_ranges_go_deeper():
    ranges = collocations.Ranges([(b"en", b""), (b"en", b"b"), (b"en", b"c")], [False, True, False])
    words = [b"a", b"b", b"z"]
    numbers = np.array([[1, 0, 0], [1, 1, 0], [1, 3, 2], [2, 0, 0], [2, 1, 1], [2, 1, 2], [2, 2, 1], [2, 2, 3]])
    paths = ranges.paths("en", words, numbers).tolist()
    assert len(set(paths[:3])) == 1
    # Below the hot word "b": by the second word, and by the third below "b b".
    assert paths[4] == paths[5] and len(set(paths[2:])) == 5


def random_counts(rng):
    vocabulary = sorted({bytes(rng.choices(b"abcxyz", k=rng.randint(1, 3))) for _ in range(30)})
    counts = collections.Counter(
        tuple(rng.choices(vocabulary, k=rng.randint(1, 3))) for _ in range(rng.randint(0, 300))
    )
    return {k: v for k, v in counts.items()}


def automaton_of(counts):
    words = sorted({w for k in counts for w in k})
    number = {w: i for i, w in enumerate(words, 1)}
    keys = sorted(counts)
    columns = [np.array([number[k[p]] if p < len(k) else 0 for k in keys], dtype=np.int64) for p in range(3)]
    return transducers.Transducer(words, transducers.code_of(columns), np.array([counts[k] for k in keys], dtype=np.int64))


@pytest.mark.parametrize("seed", range(5))
def test_automata(seed):
    rng = random.Random(seed)
    tables = [random_counts(rng) for _ in range(4)]
    automata = [automaton_of(t) for t in tables]
    automata = [transducers.Transducer.unpacked(one.packed()) for one in automata]
    total = sum((collections.Counter(t) for t in tables), collections.Counter())
    for least in (1, 3):
        whole = transducers.union(automata, least)
        asked = [*total, (b"missing",), (b"a", b"missing")]
        want = [n if n >= least else 0 for n in (total[k] for k in asked)]
        assert whole.weights_of(asked) == want
        states = list(zip(whole.weight, [
            tuple(zip(whole.label[i:j], whole.target[i:j])) for i, j in zip(whole.first, whole.first[1:])
        ]))
        assert len(set(states)) == len(states), "equal states are one"


def test_states_of_equal_hashes_are_told_apart(monkeypatch):
    """States are grouped by hashes all at once; hashes that meet are tried anew."""
    salts, hashes = [], transducers._slice_hashes

    def meeting(pairs, first, fan, weights, salt):
        salts.append(salt)
        return hashes(pairs, first, fan, weights, salt) % np.uint64(2 if salt < 2 else 1 << 63)

    monkeypatch.setattr(transducers, "_slice_hashes", meeting)
    rng = random.Random(7)
    counts = random_counts(rng) or {(b"a", b"b"): 1}
    built = automaton_of(counts)
    assert max(salts) == 2
    assert built.weights_of(list(counts)) == list(counts.values())
    monkeypatch.undo()
    assert len(built.weight) == len(automaton_of(counts).weight)


def test_edge_rows(spark):
    docs = edge.frame(spark)
    want = brute([(r[2], r[1]) for r in edge.ROWS])
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == want
    assert any(r[2].startswith("la la") for r in want)
    assert collocations.collocations(edge.empty(spark)).count() == 0


def test_query_and_sql(spark, tmp_path):
    docs = frame(spark, random_rows(9, 300)).union(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text")
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = registry.op13_collocations(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == brute([tuple(r) for r in docs.collect()])
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    columns = ", ".join(found[0].__fields__)
    assert sorted(map(tuple, found)) == sorted(base.execute(f"SELECT {columns} FROM ({registry.OP13_SQL})").fetchall())


@pytest.mark.parametrize("seed", range(3))
def test_automata_of_groups_are_those_built_alone(seed):
    rng = random.Random(seed)
    tables = [random_counts(rng) or {(b"a",): 2} for _ in range(6)]
    words = sorted({w for table in tables for k in table for w in k})
    number = {w: i for i, w in enumerate(words, 1)}
    rows = [(g, [number[w] for w in k], table[k]) for g, table in enumerate(tables) for k in sorted(table)]
    columns = [np.array([k[p] if p < len(k) else 0 for _, k, _ in rows], dtype=np.int64) for p in range(3)]
    found = transducers.of_groups(
        words, transducers.code_of(columns), np.array([n for *_, n in rows]), np.array([g for g, *_ in rows])
    )
    assert [one.packed() for one in found] == [automaton_of(table).packed() for table in tables]
    assert [one.weights_of(list(t)) for one, t in zip(found, tables)] == [list(t.values()) for t in tables]


def test_full_languages_leave_the_others_to_grow(monkeypatch):
    """Each language's chunk goes when it is full; short ones were written with it."""
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 100)
    rows = [(lang, "a b c d e") for _ in range(40) for lang in ("de", "en", "en", "fr")]
    batches = [collocations.pd.DataFrame(rows, columns=["lang", "text"])]
    sizes = [(lang, chunk.size) for lang, chunk in collocations._chunks(iter(batches))]
    assert sorted(sizes) == [("de", 100)] * 2 + [("en", 100)] * 4 + [("fr", 100)] * 2
    # Words that all differ are held up to a chunk's worth of them.
    rows = [(f"l{i % 7}", " ".join(f"w{i}.{j}" for j in range(5))) for i in range(200)]
    batches = [collocations.pd.DataFrame(rows, columns=["lang", "text"])]
    chunks = list(collocations._chunks(iter(batches)))
    assert max(len(chunk.number) for _, chunk in chunks) <= 100
    assert sum(counted for _, chunk in chunks for _, counted in chunk.parts) == sum(
        len(collocations.tokens(text)) for _, text in rows
    )
