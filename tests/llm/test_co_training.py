import numpy as np

from basketseq.llm import co_training
from tests.llm import edge

LABELS = "doc_id long, quality int, id string, text string"


def test_held_out_accuracy_and_whole_result(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    train = labels.where("doc_id % 4 <> 1")
    test = {r.doc_id: r.quality for r in labels.where("doc_id % 4 = 1").collect()}
    found = co_training.with_scores(docs, train).collect()
    assert len(found) == docs.count()
    right = [r.kept == bool(test[r.doc_id]) for r in found if r.doc_id in test]
    assert np.mean(right) > 0.97
    clean = [r.kept for r in found if test.get(r.doc_id) == 1]
    assert np.mean(clean) > 0.95
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in found)


def test_pseudo_labels_teach_the_other_view():
    rng = np.random.default_rng(0)
    x = np.hstack((np.ones((400, 1)), rng.standard_normal((400, 3))))
    y = (x @ [0.2, 2, -1, 0.5] + 0.3 * rng.standard_normal(400) > 0) * 1.0
    weights = np.zeros(4)
    halves = [
        co_training.newton_sums(x[i::2], y[i::2], weights) for i in range(2)
    ]
    whole = co_training.newton_sums(x, y, weights)
    assert np.allclose(sum(halves), whole)
    fitted = co_training.logistic(x, y)
    assert np.mean((x @ fitted > 0) == y) > 0.9


def test_edge_rows(spark):
    docs = edge.frame(spark)
    labels = spark.createDataFrame(
        [(i, q, "x", "y") for i, q in [(6, 1), (7, 1), (7, 1), (8, 1), (10, 0), (11, 0), (12, 1),
                                       (None, 1), (9, None), (4, 7), (5, 0), (1, 0), (2, 0)]],
        LABELS,
    )
    for known in (labels, labels.where("quality = 1"), labels.where("false")):
        found = co_training.with_scores(docs, known).collect()
        assert len(found) == len(edge.ROWS)
        assert {r.size for r in found} == {"x"} and "text" not in found[0].asDict()
        assert all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in found} == {0.5}
    empty = co_training.with_scores(edge.empty(spark), labels)
    assert empty.count() == 0
    narrow = docs.select("doc_id", "text")
    assert co_training.with_scores(narrow, labels).count() == len(edge.ROWS)
