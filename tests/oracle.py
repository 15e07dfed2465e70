"""Runs a registered query in Spark and its SQL in DuckDB and compares rows, column names and types."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# DuckDB type of each Spark type that the queries return.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _clean(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def spark_rows(df):
    columns = sorted(df.columns)
    types = {f.name: TYPES.get(f.dataType.simpleString().split("(")[0], f.dataType.simpleString()) for f in df.schema}
    rows = Counter(tuple(_clean(v) for v in row) for row in df.select(*(f"`{c}`" for c in columns)).collect())
    return columns, [types[c] for c in columns], rows


def duck_rows(con, sql):
    described = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    columns = sorted(described)
    select = ", ".join(f'"{c}"' for c in columns)
    rows = Counter(tuple(_clean(v) for v in row) for row in con.execute(f"SELECT {select} FROM ({sql})").fetchall())
    return columns, [described[c] for c in columns], rows


def difference(df, con, sql):
    """None if both give the same, else a short text."""
    s_columns, s_types, s_rows = spark_rows(df)
    d_columns, d_types, d_rows = duck_rows(con, sql)
    if s_columns != d_columns:
        return f"columns {s_columns} and {d_columns}"
    if s_types != d_types:
        return f"types of {s_columns}: {s_types} and {d_types}"
    if s_rows != d_rows:
        only_s, only_d = list((s_rows - d_rows).items())[:3], list((d_rows - s_rows).items())[:3]
        return f"{s_rows.total()} and {d_rows.total()} rows; only Spark {only_s}; only DuckDB {only_d}"
    return None
