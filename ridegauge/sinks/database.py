"""Upsert into a database table by key, creating and widening the table as needed.

Spark's JDBC writer appends; the upsert statement is sent from the tasks over connections that
the caller's ``connect`` function opens, so any database with ``ON CONFLICT`` will do.
"""

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T

# Column types of the created tables.
COLUMN_TYPES = {
    T.StringType(): "text",
    T.IntegerType(): "integer",
    T.LongType(): "bigint",
    T.FloatType(): "real",
    T.DoubleType(): "double precision",
    T.BooleanType(): "boolean",
    T.TimestampType(): "timestamp with time zone",
    T.TimestampNTZType(): "timestamp",
}


def _column(field: T.StructField) -> str:
    return f'"{field.name}" {COLUMN_TYPES.get(field.dataType, "text")}'


def create_statement(table: str, schema: T.StructType, keys: list[str]) -> str:
    columns = ", ".join(_column(field) for field in schema)
    quoted = ", ".join(f'"{key}"' for key in keys)
    return f'CREATE TABLE IF NOT EXISTS "{table}" ({columns}, PRIMARY KEY ({quoted}))'


def widen_statements(table: str, schema: T.StructType) -> list[str]:
    return [f'ALTER TABLE "{table}" ADD COLUMN IF NOT EXISTS {_column(field)}' for field in schema]


def upsert_statement(table: str, columns: list[str], keys: list[str], mark: str = "%s") -> str:
    names = ", ".join(f'"{c}"' for c in columns)
    marks = ", ".join(mark for _ in columns)
    target = ", ".join(f'"{key}"' for key in keys)
    changes = ", ".join(f'"{c}" = excluded."{c}"' for c in columns if c not in keys)
    action = f"DO UPDATE SET {changes}" if changes else "DO NOTHING"
    return f'INSERT INTO "{table}" ({names}) VALUES ({marks}) ON CONFLICT ({target}) {action}'


def prepare(connect: Callable, table: str, schema: T.StructType, keys: list[str]) -> None:
    """Create the table, or add the columns it lacks."""
    connection = connect()
    try:
        cursor = connection.cursor()
        cursor.execute(create_statement(table, schema, keys))
        for statement in widen_statements(table, schema):
            cursor.execute(statement)
        connection.commit()
    finally:
        connection.close()


def upsert(
    rows: DataFrame,
    connect: Callable,
    table: str,
    keys: list[str],
    chunk: int = 1000,
    mark: str = "%s",
    connections: int = 32,
) -> None:
    """Send ``rows``, one per key, over at most ``connections`` connections in parallel.

    The rows are dealt to that many tasks by a shuffle, so what computes them keeps its own tasks.
    Rows carry full values, so a task that runs twice leaves the same table.
    """
    prepare(connect, table, rows.schema, keys)
    statement = upsert_statement(table, rows.columns, keys, mark)

    def send(part: Iterator[Row]) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            while batch := [tuple(row) for row in islice(part, chunk)]:
                cursor.executemany(statement, batch)
                connection.commit()
        finally:
            connection.close()

    rows.repartition(connections).foreachPartition(send)


def append(rows: DataFrame, url: str, table: str, **properties: str) -> None:
    """Plain insert through the JDBC writer, for tables without a key."""
    rows.write.jdbc(url, table, mode="append", properties=properties)
