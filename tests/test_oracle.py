"""Every registered query against its SQL text in DuckDB."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from stationlake.plans import oracle, registry
from stationlake.schemas import gold_schema

QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()

# integer widths may differ between the engines; nothing else may
FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int",
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int",
    "string": "text", "VARCHAR": "text", "double": "double", "DOUBLE": "double",
    "date": "date", "DATE": "date", "timestamp_ntz": "time", "TIMESTAMP": "time",
    "boolean": "bool", "BOOLEAN": "bool",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_the_flagship_has_gold_rows(spark):
    df = contract.entry(spark)
    assert df.columns == spark.createDataFrame([], gold_schema()).columns
    assert df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(name, spark, duck, sf_dir):
    ours = QUERIES[name](spark, sf_dir)
    columns = sorted(ours.columns)
    theirs = duck.sql(ORACLE[name])
    assert columns == sorted(theirs.columns)

    types = dict(zip(theirs.columns, map(str, theirs.types), strict=True))
    for field in ours.schema:
        assert FAMILY[field.dataType.simpleString()] == FAMILY[types[field.name]], field.name

    left = Counter(tuple(r) for r in ours.select(*columns).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    right = Counter(theirs.project(quoted).fetchall())
    assert sum(left.values()) > 0
    assert left == right
