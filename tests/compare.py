"""Comparison of a Spark frame with a DuckDB result, regardless of row order."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sortable(row):
    return tuple((v is not None, str(v)) for v in row)


def _same(a, b):
    return a == b and type(a) is type(b)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=_sortable)


def differences(df, con, sql: str) -> list[str]:
    """What is different, shortest possible; empty if nothing is."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return [f"{len(actual)} rows against {len(expected)}"]
    bad = [
        (a, e)
        for a, e in zip(actual, expected)
        if not all(_same(x, y) for x, y in zip(a, e))
    ]
    return [f"{a} against {e}" for a, e in bad[:3]]
