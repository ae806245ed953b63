"""Every registered query against its SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as registry
from ridegauge.sources import tables

SF = "/root/testdata/sf0.001"
TABLES = ("part", "lineitem", "orders", "events")
# the text operators have tests of their own, which go with them
REPORTS = {**registry.STATE_QUERIES, **registry.CHANGELOG_QUERIES, **registry.STREAM_QUERIES}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", TABLES)
def test_declared_schemas(spark, name):
    found = spark.read.parquet(f"{SF}/{name}.parquet").schema
    assert tables.table(spark, SF, name).schema == found


def test_every_query_has_its_sql():
    assert set(REPORTS) <= set(registry.oracle_sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_query(spark, database, name):
    found = registry.queries()[name](spark, SF)
    columns = sorted(found.columns)
    cursor = database.execute(registry.oracle_sql()[name])
    places = {column[0]: i for i, column in enumerate(cursor.description)}
    assert sorted(places) == columns
    expected = sorted(
        (tuple(row[places[c]] for c in columns) for row in cursor.fetchall()), key=repr
    )
    assert sorted((tuple(row[c] for c in columns) for row in found.collect()), key=repr) == expected
    assert expected


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert rows
    assert all(math.isfinite(row["occupancyPercentage"]) for row in rows)
