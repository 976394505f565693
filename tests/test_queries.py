import pytest
from helpers import DATA, same_rows

from lexmill.plans.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert name in SQL
    same_rows(QUERIES[name](spark, DATA), duck, SQL[name])


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["unit_id", "verdict", "codes"] and df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
