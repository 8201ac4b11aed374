"""Order-insensitive comparison of a Spark result with DuckDB."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    return sorted(columns), rows_of(columns, cur.fetchall()), types


# Spark type -> DuckDB type name.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "float": "FLOAT", "timestamp": "TIMESTAMP",
}


def difference(df, con, sql) -> str | None:
    columns, ours = spark_rows(df)
    duck_columns, theirs, types = duck_rows(con, sql)
    if columns != duck_columns:
        return f"columns differ: {columns} / {duck_columns}"
    for name, spark_type in df.dtypes:
        expected = TYPES.get(spark_type)
        if expected and not types[name].startswith(expected):
            return f"type of {name}: {spark_type} / {types[name]}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows / {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ; {columns}\n" + "\n".join(f"  spark {a}\n  duck  {b}" for a, b in wrong[:3])
    return None
