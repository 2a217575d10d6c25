"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import importlib.util
from pathlib import Path

import pytest
from compare import connect, duck_rows, spark_rows

from starloom import registry

FOLDER = "/root/testdata/sf0.001"

_spec = importlib.util.spec_from_file_location("entry", Path(__file__).resolve().parents[1] / "__spark_entry__.py")
entry = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(entry)

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="benchmark tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", registry.queries())
def test_query_equals_its_sql(spark, duck, name):
    columns, rows = spark_rows(entry.queries()[name](spark, FOLDER))
    expected_columns, expected = duck_rows(duck, entry.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
