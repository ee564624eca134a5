"""Every query against its SQL, on the smallest tables."""

import pytest

import compare
from skeinwright import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    if name in ORACLES:
        assert compare.differences(spark, QUERIES[name], ORACLES[name], sf) == ""
    else:
        assert QUERIES[name](spark, sf).collect()


def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert len(rows) == 5
    assert set(ORACLES) <= set(__spark_entry__.queries())
