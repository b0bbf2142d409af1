"""Every checked query against its SQL, on the smallest tables."""

import pytest

from bazaar.checks import ORACLES, QUERIES
from tests.compare import compare


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    if name in ORACLES:
        assert compare(spark, sf, QUERIES[name], ORACLES[name]) in ("", "both sides empty")
    else:
        assert QUERIES[name](spark, sf).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["official_store", "n_days", "order_dates"]


def test_queries_read_whole_tables():
    for sql in ORACLES.values():
        assert "USING SAMPLE" not in sql.upper()
