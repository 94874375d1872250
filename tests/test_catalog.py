import pytest

import __spark_entry__ as entry
from tools.check_oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    assert differences(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).columns == ["mob", "bad_rate"]
    assert entry.entry(spark).count() == 7


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
