"""Queries whose results SQL can express, over the whole tables."""

import pytest
from helpers import DATA, same_rows

from lexmill.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", ["op6_jaccard", "op9_decontaminate", "op11_turns", "op12_centroids", "op13_minhash"])
def test_query_equals_sql(spark, duck, name):
    same_rows(QUERIES[name](spark, DATA), duck, ORACLE_SQL[name])
