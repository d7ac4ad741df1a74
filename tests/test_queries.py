"""Every registered query against its SQL on the smallest test tables."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as contract
from basketseq.plans import oracle
from basketseq.plans.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in pathlib.Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(REGISTRY) == set(oracle.oracle_sql())
    assert set(REGISTRY) <= set(contract.queries())
    assert set(oracle.oracle_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, database, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(columns).collect())
    assert got
    assert len(database.execute(contract.oracle_sql()[name]).description) == len(columns)
    cursor = database.execute(f"SELECT {', '.join(columns)} FROM ({contract.oracle_sql()[name]})")
    assert got == sorted(repr(tuple(r)) for r in cursor.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "user_id"
    assert df.count() > 0
