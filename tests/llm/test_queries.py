"""Registered queries against their SQL, over whole tables."""

import pytest
from compare import connect, duck_rows, spark_rows

from starloom.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    out = queries.QUERIES[name](spark, FOLDER)
    if name in queries.SQL:
        assert spark_rows(out) == duck_rows(connect(FOLDER), queries.SQL[name])
    else:
        assert out.count() > 0
