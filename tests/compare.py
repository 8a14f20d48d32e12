"""Exact, order-insensitive comparison of a Spark result with the expected SQL result."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Type names of the checking engine by Spark type name.
TYPE_NAMES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _bag(rows) -> Counter:
    return Counter(tuple(repr(value) for value in row) for row in rows)


def assert_same(df, connection, sql: str) -> int:
    names = sorted(df.columns)
    expected = connection.sql(sql)
    assert sorted(expected.columns) == names
    spark_types = {f.name: TYPE_NAMES[f.dataType.simpleString()] for f in df.schema.fields}
    expected_types = {n: str(t) for n, t in zip(expected.columns, expected.types)}
    differing = {
        n: (spark_types[n], expected_types[n])
        for n in names
        if spark_types[n] != expected_types[n]
    }
    quoted = ", ".join(f'"{name}"' for name in names)
    found = _bag(tuple(row) for row in df.select(*names).collect())
    wanted = _bag(expected.select(quoted).fetchall())
    assert found == wanted, (
        f"only in Spark: {list((found - wanted).items())[:3]}, "
        f"only expected: {list((wanted - found).items())[:3]}"
    )
    assert not differing, f"types differ: {differing}"
    return found.total()
