"""Every registered query against its DuckDB oracle on the smallest fixture
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as entry
from oracle_check import digest, duck
from ledgerloom import registry
from testpaths import SMALL

SLOW = {"csv_inbox_incremental"}
NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())


@pytest.mark.parametrize("name", [n for n in NAMES if n not in SLOW])
def test_matches_oracle(spark, con, name):
    sdf = registry.queries()[name](spark, SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(registry.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    assert digest(srows, sdf.columns)[0] == digest(orows, rel.columns)[0]


def test_streaming_inbox_matches_batch(spark):
    q = registry.queries()
    a = q["csv_inbox_incremental"](spark, SMALL)
    b = q["banking_csv_raw"](spark, SMALL)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["month", "category_id", "spend", "txn_count"]
