from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from customer360.plans.settings import local_session

    s = local_session("*", 8, app="customer360-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def asof():
    return dt.date(2001, 8, 1)


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of some columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
