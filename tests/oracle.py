"""Runs a query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
import os

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_rows(sql: str, sf_dir: str = DATA):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    return names, kinds, result.fetchall()


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _key(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0)
                 for value in row)


def normalise(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=_key)


# Spark types and the DuckDB types that hold the same values.
KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN", "tinyint": "TINYINT"}


def compare(frame, sql, sf_dir: str = DATA) -> int:
    names, kinds, expected = duck_rows(sql, sf_dir)
    assert sorted(names) == sorted(frame.columns)
    for name, kind in frame.dtypes:
        assert KINDS[kind] == kinds[name], f"{name}: {kind} against {kinds[name]}"
    actual = [tuple(row) for row in frame.collect()]
    assert len(actual) == len(expected), f"{len(actual)} rows against {len(expected)}"
    assert normalise(frame.columns, actual) == normalise(names, expected)
    return len(actual)
