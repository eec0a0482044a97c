import os

import pytest

import __spark_entry__ as contract
from checks.compare import compare
from checks.queries import REGISTERED

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def test_every_query_has_its_sql():
    assert REGISTERED.keys() <= contract.queries().keys()
    assert REGISTERED.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "l_orderkey" and df.count() > 0


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_matches_its_sql(spark, name):
    assert compare(spark, SF_DIR, name) is None
