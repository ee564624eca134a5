"""Runs queries and their SQL on the same tables and compares rows, in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    if isinstance(x, bool) or x is None:
        return str(x)
    return str(x)


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, query, sql: str, sf_dir: str) -> str:
    """Empty if both give the same."""
    mine = query(spark, sf_dir)
    con = duck(sf_dir)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    own = rows_of(mine.columns, [tuple(r) for r in mine.collect()])
    if sorted(names) != sorted(mine.columns):
        return f"columns {sorted(mine.columns)} and {sorted(names)}"
    if own != theirs:
        odd = [(a, b) for a, b in zip(own, theirs, strict=False) if a != b][:3]
        return f"{len(own)} and {len(theirs)} rows, e.g. {odd}"
    return ""
