"""Compares a query's rows with those of its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Spark type -> DuckDB type
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _row(values) -> tuple:
    return tuple(0.0 if isinstance(v, float) and v == 0 else v for v in values)


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def differences(df, sql: str, con) -> list[str]:
    """Empty if names, types and rows agree."""
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    rel = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in names)} FROM ({sql}) q")
    described = {d[0]: str(d[1]) for d in rel.description}
    want = _sorted([_row(r) for r in rel.fetchall()])
    got = _sorted([_row(r) for r in df.select(*names).collect()])
    out = []
    for c in names:
        if TYPES.get(kinds[c]) != described[c]:
            out.append(f"type of {c}: {kinds[c]} / {described[c]}")
    if len(got) != len(want):
        out.append(f"rows: {len(got)} / {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if not _same(g, w)]
    if bad:
        out.append(f"{len(bad)} rows differ in {names}, first: {bad[0]}")
    return out


def _same(a: tuple, b: tuple) -> bool:
    return all(x == y or _both_nan(x, y) for x, y in zip(a, b))


def _both_nan(x, y) -> bool:
    return isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)
