"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

from oracle_compare import compare, duck
from conftest import SF01
from tidemark.registry import ORACLE, QUERIES

_con = None


def _duck():
    global _con
    if _con is None:
        _con = duck(SF01)
    return _con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF01, _duck())
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF01)
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
