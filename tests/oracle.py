"""Compare a query with its SQL: same columns, same rows in any order."""

import math
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value.isoformat() if isinstance(value, (date, datetime)) else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_plain(row[i]) for i in order] for row in rows), key=repr)


def assert_same(df, con, sql):
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    assert {name: TYPES[dtype] for name, dtype in df.dtypes} == types
    expected = _rows(names, result.fetchall())
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    assert len(actual) == len(expected)
    assert actual == expected
