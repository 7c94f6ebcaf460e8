"""Every key with a SQL oracle matches DuckDB on the same driver tables (the correctness gate)."""

import pytest

from autoprice.plans import registry
from autoprice.plans.oracle_check import compare, duck_connect
from conftest import SF_SMALL

registry.load_all()
# the full parameter search fits 72 forests; test_reworked covers it with a small grid
KEYS = sorted(set(registry.ORACLES) - {"random_search"})


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, SF_SMALL, key, con)
    assert r["status"] == "match", r


def test_every_key_registered_in_entry():
    import __spark_entry__ as e
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 120
