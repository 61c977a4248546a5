"""Run a query and its SQL on the same files and compare names, types and values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
            benchmark labels conversations""".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


# How Spark's types are called in DuckDB.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE",
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def outcome(spark_df, con, sql):
    """(problem or None, rows)."""
    columns = sorted(spark_df.columns)
    types = dict(spark_df.dtypes)
    relation = con.sql(sql)
    want_types = dict(zip(relation.columns, map(str, relation.types)))
    if columns != sorted(want_types):
        return f"columns {columns} against {sorted(want_types)}", 0
    off = {c: (types[c], want_types[c]) for c in columns if TYPES.get(types[c]) != want_types[c]}
    if off:
        return f"types {off}", 0
    got = sorted(tuple(plain(v) for v in row) for row in spark_df.select(*[f"`{c}`" for c in columns]).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = sorted(tuple(plain(v) for v in row) for row in con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    if got != want:
        only = [r for r in got if r not in set(want)][:3], [r for r in want if r not in set(got)][:3]
        return f"{len(got)} against {len(want)} rows, such as {only}", len(got)
    return None, len(got)
