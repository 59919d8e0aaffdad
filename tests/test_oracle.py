import pytest

from telemill.acceptance import QUERIES, SQL
from tests.oracle import DATA, compare


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, name):
    frame = QUERIES[name](spark, DATA)
    if name in SQL:
        assert compare(frame, SQL[name]) > 0
    else:
        assert frame.count() > 0
