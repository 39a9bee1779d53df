"""Every registered query against its SQL on the smallest tables."""

import pytest
from sqlcheck import compare, connect

from readloom.plans import registry

SF = "/root/testdata/sf0.001"
registry.load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF, may_be_empty=True) is None


def test_every_query_has_sql():
    assert sorted(registry.QUERIES) == sorted(registry.ORACLE)
