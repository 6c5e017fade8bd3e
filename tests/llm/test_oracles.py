import pytest

from tests.compare import database, difference
from textloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert difference(QUERIES[name](spark, sf), database(sf), ORACLES[name]) is None
