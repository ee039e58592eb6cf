"""Compare a Spark result with the same question asked in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the two results; types and values must be equal, not close."""
    theirs = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in theirs.description}
    expected = rows_of(list(kinds), theirs.fetchall())
    mine = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema}
    if mine != kinds:
        return [f"types {mine} against {kinds}"]
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return [f"{len(got)} rows against {len(expected)}"]
    return [f"{sorted(kinds)}: {a} against {b}" for a, b in zip(got, expected) if a != b]
