"""Every registered query against its SQL in DuckDB: names, types and rows."""

import pytest

import __spark_entry__ as contract
import suite
from conftest import SMALL

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


@pytest.mark.parametrize("name", sorted(suite.QUERIES))
def test_matches_duckdb(spark, duck, name):
    frame = contract.queries()[name](spark, SMALL)
    sql = contract.oracle_sql()[name]
    types = {row[0]: TYPES.get(row[1], row[1]) for row in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert dict(frame.dtypes) == types
    names = sorted(frame.columns)
    expected = duck.execute(f"SELECT {', '.join(names)} FROM ({sql}) q").fetchall()
    got = [tuple(r) for r in frame.select(*names).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert suite.QUERIES.keys() == suite.ORACLES.keys()
    assert contract.queries().keys() >= suite.QUERIES.keys()
