import pytest

from __spark_entry__ import entry, oracle_sql
from plantlake.queries import all_queries
from verify_queries import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_its_sql(spark, duck, name):
    assert name in oracle_sql()
    verdict = compare(spark, duck, name, SF)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry(spark).count() > 0
