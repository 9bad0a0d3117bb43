"""Every registered query against its DuckDB statement, and the contract around them."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "conversations", "events", "labels", "pages", "benchmark")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def rounded(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    got = [tuple(rounded(r[c]) for c in names) for r in df.collect()]
    want = [tuple(map(rounded, r)) for r in result.fetchall()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert want


def test_only_the_seeded_draw_has_no_oracle():
    own = {q.__name__ for q in QUERIES}
    assert own - set(contract.oracle_sql()) == {"calibration_sample"}
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
