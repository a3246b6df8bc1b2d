"""Every query of the package's own registry against its DuckDB oracle at sf0.01 (the driver's
correctness gate). An optional subpackage tests the queries that it adds."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
import oracle_sql as O
from tests.compare import compare, duck_connection
from tests.conftest import SF01


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF01)


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) == set(O.oracle_queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(E._QUERIES))
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(E._QUERIES[key](spark, SF01), con, O.oracle_queries()[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "LoanNumber"
    assert df.count() > 0
