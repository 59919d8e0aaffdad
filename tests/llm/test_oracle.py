import pytest

from telemill.llm.queries import QUERIES, SQL
from tests.oracle import DATA, compare


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    assert compare(QUERIES[name](spark, DATA), SQL[name]) > 0
