import pytest

from checks.compare import compare, connect


@pytest.mark.parametrize("name", ["op5_minhash_forest", "op8_substring_dedup"])
def test_matches_sql(spark, sf_small, name):
    from cellframe.llm.queries import ORACLES, QUERIES

    assert compare(spark, connect(sf_small), sf_small, QUERIES[name], ORACLES[name])[0] == "ok"
