"""Every registered query against its DuckDB text, row by row."""

import math
from datetime import datetime

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def scale(request):
    folder = f"{DATA}/{request.param}"
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return folder, con


def family(type_name: str) -> str:
    return {"integer": "int", "varchar": "string", "timestamp": "timestamp_ntz"}.get(type_name.lower(), type_name.lower())


def comparable(rows):
    def value(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v.isoformat() if isinstance(v, datetime) else repr(v)

    return sorted(tuple(value(v) for v in row) for row in rows)


# Queries of the corpus subpackage have tests of their own.
OWN = [name for name in registry.queries() if registry.llm is None or name not in registry.llm.queries()]


def test_every_query_has_a_text():
    assert set(OWN) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, scale, name):
    folder, con = scale
    result = registry.queries()[name](spark, folder)
    columns = sorted(result.columns)
    cursor = con.execute(registry.oracle_sql()[name])
    types = {d[0]: family(str(d[1])) for d in cursor.description}
    listed = [d[0] for d in cursor.description]
    expected = [tuple(row[listed.index(c)] for c in columns) for row in cursor.fetchall()]
    assert {f.name: f.dataType.simpleString() for f in result.schema} == types
    actual = [tuple(row) for row in result.select(*columns).collect()]
    assert len(actual) > 0
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert comparable(actual) == comparable(expected)
