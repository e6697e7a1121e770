"""Every query of the package that has SQL, against DuckDB."""

import pytest

from compare import connect, duck_result, duck_types, spark_result
from larder.llm.queries import QUERIES
from larder.llm.statements import ORACLE_SQL

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(tiny):
    with connect(tiny) as con:
        yield con


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_matches(spark, duck, tiny, name):
    df = QUERIES[name](spark, tiny)
    assert spark_result(df) == duck_result(duck, ORACLE_SQL[name])
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == duck_types(duck, ORACLE_SQL[name])
