"""The operators' queries against their DuckDB SQL at sf0.01."""

from __future__ import annotations

import pytest

from disclosure.llm.queries import ORACLES, QUERIES
from tests.compare import compare, duck_connection
from tests.conftest import SF01


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF01)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(QUERIES[key](spark, SF01), con, ORACLES[key])
    assert ok, msg
