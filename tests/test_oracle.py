"""Every registered query against its DuckDB oracle (rows-only keys: runs and
returns rows), at sf0.01 as the driver does."""

from __future__ import annotations

import pytest

from blotter.plans.catalog import ORACLE, QUERIES
from tests.conftest import SF_MID
from tests.oracle_harness import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_MID)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, QUERIES[key], ORACLE.get(key), SF_MID)
    assert r["status"] in ("match", "rows-only"), r
