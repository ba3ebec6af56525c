"""Every query with a SQL statement gives the same rows, names and types in both engines."""

import duckdb
import pytest

from stockweave.catalog import QUERIES
from stockweave.oracle import ROWS_ONLY, oracle_statements
from stockweave.sources.landing import GIVEN, LANDING_SQL, landing_table
from stockweave.sources.tables import TABLES

STATEMENTS = oracle_statements()
SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in GIVEN:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(df, con, statement):
    result = con.execute(statement)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    types = {d[0]: SPARK_TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    assert {f.name: f.dataType.simpleString() for f in df.schema} == types
    actual = by_name(df.columns, [tuple(r) for r in df.collect()])
    assert actual == by_name(names, expected)


@pytest.mark.parametrize("table", sorted(LANDING_SQL))
def test_landing(spark, duck, sf_dir, table):
    df = landing_table(spark, sf_dir, table)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in TABLES[table].schema
    ]
    compare(df, duck, LANDING_SQL[table].format(**{t: t for t in GIVEN}))


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query(spark, duck, sf_dir, name):
    compare(QUERIES[name](spark, sf_dir), duck, STATEMENTS[name])


def test_only_models_lack_sql():
    assert set(QUERIES) - set(STATEMENTS) == set(ROWS_ONLY)
