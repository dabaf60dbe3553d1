"""Comparison of registered queries with DuckDB on the same files."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def kind(dtype: str) -> str:
    d = dtype.lower()
    if "decimal" in d:
        return "decimal"
    if any(k in d for k in ("int", "long", "short")):
        return "integer"
    if "double" in d or "float" in d:
        return "double"
    if "bool" in d:
        return "boolean"
    if "varchar" in d or "string" in d:
        return "string"
    return d


def canonical(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r))


def compare(con, df, sql: str) -> list[str]:
    """Differences between a Spark result and the SQL's; empty when they agree exactly."""
    cur = con.execute(sql)
    want_types = {d[0]: kind(str(d[1])) for d in cur.description}
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    got_types = {n: kind(t) for n, t in df.dtypes}
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if got_types != want_types:
        problems.append(f"schema {got_types} != {want_types}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        problems.append(f"{len(bad)} values differ, first: {bad[:3]}")
    return problems
