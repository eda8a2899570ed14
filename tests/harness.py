"""Compare a Spark result with the checking SQL: names, row counts and values."""

import math
import os

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
DATA = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


def connect(folder=DATA):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def rows_of(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in data)


def compare(con, spark_df, sql):
    """Empty string when equal, else a short report."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(names, result.fetchall())
    collected = [tuple(r) for r in spark_df.collect()]
    actual = rows_of(spark_df.columns, collected)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    types = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER", "double": "DOUBLE"}
    odd = [
        f"{c}:{t}/{kinds[c]}" for c, t in spark_df.dtypes if types.get(t, t.upper()) != kinds[c]
    ]
    note = f" types {odd}" if odd else ""
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}" + note
    if actual != expected:
        pair = next((a, e) for a, e in zip(actual, expected) if a != e)
        return f"values differ, e.g. {pair[0]} != {pair[1]}" + note
    return f"ok{note}" if odd else f"ok {len(actual)}"
