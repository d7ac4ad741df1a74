"""The registered queries and the pipeline against brute force on the smallest tables."""

import collections
import pathlib

import duckdb
import pytest
import regex

import corpus_pipeline
from basketseq.llm import pii, registry
from tests.llm import edge, test_mixing, test_near_dedup, test_packing, test_pii, test_quality

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="needs the test tables")

HOW = {
    "email": test_pii.email,
    "credential": lambda v: test_pii.characters_moved("credential", v),
    "iban": test_pii.iban,
    "date": test_pii.date,
    "ipv4": test_pii.ipv4,
    "card": test_pii.card,
    "ssn": test_pii.ssn,
    "phone": test_pii.phone,
}


def rewritten(text):
    """The text with each finding moved by the Python network."""
    any_kind = regex.compile(
        "|".join(f"(?P<{kind}>{pattern})" for kind, pattern in pii.PATTERNS.items())
    )
    return any_kind.sub(lambda m: HOW[m.lastgroup](m.group()), text)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{k}")
        found = spark.read.parquet(f"{folder}/{k}")
        out.append((docs.collect(), found.collect(), found.columns))
        docs = found
    return out


def test_stages_return_documents(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near-duplicates", "pii", "mixing", "packing"]
    assert all(columns == list(corpus_pipeline.COLUMNS) for _, _, columns in stages[:-1])


def test_quality_stage(stages):
    given, kept, _ = stages[0]
    want = {r.doc_id for r in given if test_quality.brute(r.text)["kept"]}
    assert {r.doc_id for r in kept} == want and 0 < len(kept) < len(given)


def test_near_duplicate_stage(stages):
    given, kept, _ = stages[1]
    sets = test_near_dedup.sets_of([r.text for r in given], 5)
    least = collections.defaultdict(list)
    for r, group in zip(given, test_near_dedup.groups(sets, 80), strict=True):
        least[group].append(r.doc_id)
    assert sorted(r.doc_id for r in kept) == sorted(min(ids) for ids in least.values())


def test_pii_stage(stages):
    given, found, _ = stages[2]
    want = {r.doc_id: rewritten(r.text) for r in given}
    assert {r.doc_id: r.text for r in found} == want
    assert any(r.text != want[r.doc_id] for r in given)
    assert all(r.n_chars == len(r.text) for r in found)


def test_mixing_stage(stages):
    given, found, _ = stages[3]
    size, target = test_mixing.brute(given)
    source = {r.doc_id: r.source for r in given}
    texts = {r.doc_id: r.text for r in given}
    taken = collections.Counter()
    for r in found:
        assert texts[r.doc_id].startswith(r.text)
        taken[source[r.doc_id]] += len(test_mixing.words(r.text))
    assert all(abs(taken[s] - target[s]) <= 1 for s in size)


def test_packing_stage(stages):
    given, found, _ = stages[4]
    test_packing.check(given, found)


def test_run_equals_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.count() == len(stages[-1][1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_stands_edge_rows(spark, tmp_path):
    for name, rows in (("full", edge.ROWS), ("empty", [])):
        edge.frame(spark, rows).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{name}").count() >= (name == "full")


def test_queries_return_every_row(spark):
    whole = {"op1": "documents", "op3": "documents", "op5": "documents", "op7": "documents",
             "op8": "pages", "op9": "documents", "op10": "documents"}
    for name, query in registry.queries().items():
        table = whole.get(name.split("_")[0])
        if table:
            rows = spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
            assert query(spark, FOLDER).count() == rows, name


def test_sql(spark):
    database = duckdb.connect()
    for path in pathlib.Path(FOLDER).glob("*.parquet"):
        database.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    assert set(registry.oracle_sql()) <= set(registry.queries())
    for name, sql in registry.oracle_sql().items():
        df = registry.queries()[name](spark, FOLDER)
        columns = sorted(df.columns)
        cursor = database.execute(f"SELECT {', '.join(columns)} FROM ({sql})")
        expected = sorted(repr(tuple(r)) for r in cursor.fetchall())
        assert sorted(repr(tuple(r)) for r in df.select(columns).collect()) == expected
