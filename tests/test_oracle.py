"""Every query against its SQL, at the smallest scale."""

from __future__ import annotations

import os

import pytest

from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_its_sql(spark, con, name):
    assert difference(spark, con, name, SF) is None
