"""Every registered query against its SQL on the small tables."""

import os

import pytest

from chronovault.suite import ORACLES, QUERIES
from tools.check_oracles import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, SF_DIR) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
