"""Every query of this subpackage that has SQL, against DuckDB on the smallest tables."""

import pytest

from ledgerloom.llm.queries import ORACLE_SQL, QUERIES
from oracle_check import digest, duck
from testpaths import SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    found = QUERIES[name](spark, SMALL)
    rows, rel = [tuple(r) for r in found.collect()], duck(SMALL).sql(ORACLE_SQL[name])
    assert sorted(found.columns) == sorted(rel.columns)
    assert digest(rows, found.columns)[0] == digest(rel.fetchall(), rel.columns)[0]
