"""Every registered query against DuckDB. ``LARDER_TEST_DIR`` picks the tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, duck_result, duck_types, spark_result
from larder.catalogue import QUERIES, Report

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(tiny):
    with connect(tiny) as con:
        yield con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches(spark, duck, tiny, stored, name):
    query = queries()[name]
    # reports run on the stored clean tables, which the clean_ queries check from the raw ones
    on_stored = isinstance(query, Report) and not name.startswith("clean_")
    df = query.on(stored) if on_stored else query(spark, tiny)
    sql = oracle_sql()[name]
    assert spark_result(df) == duck_result(duck, sql)
    spark_types = {f.name: TYPES.get(t := f.dataType.simpleString(), t.upper()) for f in df.schema}
    assert spark_types == duck_types(duck, sql)


def test_entry(spark):
    assert entry(spark).count() == 2
