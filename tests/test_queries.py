"""Every query that has SQL gives the same rows as that SQL in DuckDB."""

import math
from datetime import datetime
from pathlib import Path

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


SPARK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return value.isoformat() if isinstance(value, datetime) else repr(value)


def normalised(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def own(names):
    """Without the queries of the training-text operators, which have tests of their own."""
    return sorted(n for n in names if n.startswith("q"))


@pytest.mark.parametrize("name", own(contract.oracle_sql()))
def test_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF)
    expected = duck.sql(contract.oracle_sql()[name])
    types = {column: SPARK_TYPES[kind] for column, kind in result.dtypes}
    assert types == dict(zip(expected.columns, map(str, expected.types)))
    rows = [tuple(r) for r in result.collect()]
    assert normalised(result.columns, rows) == normalised(expected.columns, expected.fetchall())
    assert rows
    plan = result._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_every_query_has_sql():
    assert own(contract.queries()) == own(contract.oracle_sql())


def test_shuffled_lookup_is_shuffled(spark):
    result = contract.queries()["q29_ordinal_transform_shuffled"](spark, SF)
    result.collect()
    assert result._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") >= 3


def test_entry_is_yesterday(spark):
    result = contract.entry(spark)
    assert result.columns == ["visit_id", *contract.VISITS.raw_features]
    assert result.count() == 40
