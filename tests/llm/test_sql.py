import pytest
from check_oracle import connect, difference

from brokerhouse.llm.oracle import ORACLE_SQL
from brokerhouse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE_SQL[name]) is None
