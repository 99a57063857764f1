"""Every registered query against its DuckDB SQL twin at sf 0.01."""

import pytest

from conftest import SF_ORACLE
from roadlens.plans.catalog import load_all
from roadlens.plans.check import compare, duck_connect

NAMES = list(load_all())


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_ORACLE, con)
    if r.get("oracle", True) is None:
        assert r["spark_rows"] > 0
        return
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r.get("exact"), r
