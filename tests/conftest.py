from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    from candlewick.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app="candlewick-tests", spark__driver__memory="16g")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="candlewick-test-")


@pytest.fixture(scope="session")
def g01(spark):
    from candlewick.plans.models import FixtureGraph

    return FixtureGraph(spark, SF01)


@pytest.fixture(scope="session")
def g1(spark):
    from candlewick.plans.models import FixtureGraph

    return FixtureGraph(spark, SF1)
