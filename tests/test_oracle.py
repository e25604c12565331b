"""Differential test: every registered query against its DuckDB oracle at sf 0.01."""

from __future__ import annotations

import os

import pytest

from conftest import SF001

from __spark_entry__ import oracle_sql, queries
from customer360.catalog import QUERIES

KEYS = sorted(QUERIES)


def test_every_report_query_is_registered_with_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def duck_con():
    from oracle_check import duck

    return duck(SF001)


@pytest.mark.skipif(not os.path.isdir(SF001), reason="test data missing")
@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck_con, key):
    from oracle_check import compare

    ok, msg = compare(spark, SF001, key, duck_con)
    assert ok, msg
    assert "APPROX" not in msg, msg
