"""Every registered query against its SQL on the same parquet tables."""

import datetime
import math

import duckdb
import pytest

from beatmetrics.catalog import ORACLES, QUERIES
from beatmetrics.sources.derived import TABLES

KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'"
        )
    yield connection
    connection.close()


def _comparable(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        value = value.date()
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_comparable(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    kinds = {c[0]: str(c[1]) for c in result.description}
    assert sorted(kinds) == sorted(df.columns)
    for field in df.schema:
        assert kinds[field.name] == KINDS[field.dataType.simpleString()], field.name
    expected = _rows([c[0] for c in result.description], result.fetchall())
    assert len(expected) > 0
    assert _rows(df.columns, df.collect()) == expected


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
