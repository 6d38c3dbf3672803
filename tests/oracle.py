"""Compare a Spark result with the same query in DuckDB: names, types, values."""

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Spark type -> DuckDB type.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def run_sql(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    return columns, types, cursor.fetchall()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "" if value is None else f"{type(value).__name__}:{value}"


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(df, con, sql):
    """Equal column names, types and rows, in any row order. Returns the row count."""
    columns, types, expected = run_sql(con, sql)
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(expected)
    assert _sorted_rows(df.columns, rows) == _sorted_rows(columns, expected)
    return len(rows)
