"""Run a registered query and its SQL on the same tables and compare rows, columns and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


def differences(spark, query, sql: str, sf_dir: str, con) -> str | None:
    """None when equal, else what differs."""
    frame = query(spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for join in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        if join in plan:
            return f"{join} in the plan"
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    kinds = dict(frame.dtypes)
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in [(d[0], str(d[1])) for d in cursor.description]:
        if same.get(kinds[name]) != kind:
            return f"type of {name}: {kinds[name]} against {kind}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference: {g} against {w}"
    return None
