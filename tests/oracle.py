"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    got = spark_df.collect()
    names = spark_df.columns
    cursor = con.execute(sql)
    expected_names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(expected_names):
        return f"columns {sorted(names)} against {sorted(expected_names)}"
    a, b = rows_of(names, [tuple(r) for r in got]), rows_of(expected_names, expected)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}; first {a[:2]} / {b[:2]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ; first {sorted(names)} {bad[0]}"
    return None
