"""Every registered query against its SQL on the smallest test tables."""

import pytest
from compare import connect, differences

from tidemark.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = QUERIES[name](spark, SF_DIR)
    if name not in ORACLES:
        assert result.count() > 0
        return
    found = [d for d in differences(result, con, ORACLES[name]) if d != "EMPTY"]
    assert not found, "\n".join(found)


def test_names_are_plain():
    for name in QUERIES:
        assert "pipeline" not in name and not name.startswith("op")
    assert ORACLES.keys() <= QUERIES.keys()


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns
    assert contract.queries().keys() >= QUERIES.keys()
