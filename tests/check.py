"""Side-by-side run of a catalog query and its check statement."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, int(value))
    if isinstance(value, float):
        if math.isnan(value):
            return (3, "nan")
        return (1, float(f"{value:.10g}") + 0.0)
    if isinstance(value, int):
        return (1, value)
    if isinstance(value, (dt.datetime, dt.date)):
        return (2, value.isoformat())
    return (2, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    left_cols, left = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    right_cols, right = _rows([d[0] for d in cur.description], cur.fetchall())
    if left_cols != right_cols:
        return f"columns: {sorted(set(left_cols) ^ set(right_cols))}"
    if len(left) != len(right):
        return f"rows: {len(left)} vs {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        a, b = bad[0]
        cols = [c for c, x, y in zip(left_cols, a, b) if x != y]
        return f"{len(bad)}/{len(left)} rows differ in {cols}: {a} vs {b}"
    kinds = {c: t for c, t in df.dtypes}
    for d in con.execute(f"DESCRIBE {sql}").fetchall():
        name, duck, spark_type = d[0], str(d[1]), kinds[d[0]]
        if "HUGEINT" in duck or duck.startswith("DECIMAL"):
            return f"type of {name}: {spark_type} vs {duck}"
        family = {"string": "VARCHAR", "double": "DOUBLE"}.get(spark_type)
        if family and duck != family:
            return f"type of {name}: {spark_type} vs {duck}"
        if spark_type in ("int", "bigint") and duck not in ("INTEGER", "BIGINT"):
            return f"type of {name}: {spark_type} vs {duck}"
    return None
