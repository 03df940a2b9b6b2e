"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    line = compare(spark, duck, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert line.endswith("  ok"), line
