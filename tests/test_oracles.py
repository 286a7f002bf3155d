"""Every query with an oracle agrees with it on the smallest tables."""

import os

import pytest

from quillmere.plans import catalogue

from .oracle import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalogue.oracles()))
def test_agrees(spark, con, name):
    assert difference(catalogue.queries()[name](spark, FOLDER), catalogue.oracles()[name], con) == ""


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracles())))
def test_runs(spark, name):
    df = catalogue.queries()[name](spark, FOLDER)
    assert df.columns and df.count() >= 0
