import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketseq.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>, row string, id string, leaf string, score string"


def brute(rows, k, step):
    """[(query row, [(score, id)])]: the nearest of each query, best first."""
    good = [
        (i, np.array(v, dtype=float))
        for i, v, *_ in rows
        if i is not None and v is not None and len(v) and None not in v
        and np.isfinite(np.array(v, dtype=float)).all() and np.any(v)
    ]
    out = []
    for key, query in good:
        if key % step:
            continue
        scored = [
            (-float((v * query).sum() / (math.sqrt((v * v).sum()) * math.sqrt((query * query).sum()))), i)
            for i, v in good
            if i != key and len(v) == len(query)
        ]
        out.append((key, [(-s, i) for s, i in sorted(scored)[:k]]))
    return out


def recall(found, expected):
    hits = total = 0
    for key, nearest in expected:
        got = {r.vec_id for r in found if r.query_id == key}
        hits += sum(i in got for _, i in nearest)
        total += len(nearest)
    return hits / total


@pytest.mark.parametrize("leaf_rows", [64, 2048])
def test_recall_on_the_tables(spark, monkeypatch, leaf_rows):
    monkeypatch.setattr(neighbours, "LEAF_ROWS", leaf_rows)
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = neighbours.nearest(vectors, F.col("id") % 50 == 0).collect()
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    expected = brute(rows, 5, 50)
    assert recall(found, expected) >= 0.9
    by_id = {i: np.array(v, dtype=float) for i, v in rows}
    for r in found:
        a, b = by_id[r.query_id], by_id[r.vec_id]
        exact = (a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum()))
        assert r.score == pytest.approx(exact, abs=1e-12)
    for key, _ in expected:
        own = sorted((r for r in found if r.query_id == key), key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert own == sorted(own, key=lambda r: (-r.score, r.vec_id))


def test_edge_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(30)]
    same = rng.standard_normal(4).tolist()
    rows += [(100 + i, same) for i in range(8)]  # ties
    rows += [(200, same), (200, same)]  # a repeated query
    rows += [
        (50, None), (150, []), (250, [0.0] * 4), (300, [1.0, float("nan"), 0.0, 0.0]),
        (350, [1.0, float("inf"), 0.0, 0.0]), (400, [1.0, None, 0.0, 0.0]), (None, same),
        (450, [1.0, 2.0]), (451, [2.0, 1.0]), (500, [1.0] * 7),
    ]
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    found = neighbours.nearest(df, F.col("id") % 50 == 0).collect()
    want = []
    for key, nearest in brute(rows, 5, 50):
        want += [(key, n + 1, i, round(s, 9)) for n, (s, i) in enumerate(nearest)]
    got = [(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in found]
    assert sorted(got) == sorted(want)
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), F.col("id") % 50 == 0).count() == 0


def test_chi_square():
    assert neighbours.chi_square_cdf(neighbours.chi_square_quantile(0.9)) == pytest.approx(0.9)
    assert neighbours.chi_square_quantile(0.95) == pytest.approx(15.507, abs=1e-3)
    draws = (np.random.default_rng(3).standard_normal((20_000, 8)) ** 2).sum(axis=1)
    assert np.mean(draws < 10) == pytest.approx(neighbours.chi_square_cdf(10), abs=0.02)
