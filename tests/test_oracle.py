"""Every registered query with an oracle, against DuckDB on the smallest tables."""

import pytest

from checks import ORACLES, QUERIES
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    verdict, rows = compare(spark, con, SF, QUERIES[name], ORACLES[name])
    assert verdict == "ok"


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.columns == ["cluster", "label", "n_cells"]
    assert out.count() > 0
