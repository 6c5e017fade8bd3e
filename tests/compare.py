"""Run a registered query and its SQL on the same tables and compare the results."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql) -> str | None:
    """None when both agree; otherwise the first thing that does not."""
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    cols = [c[0] for c in res.description]
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(cols)}"
    names = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
    want_types = {c[0]: names.get(str(c[1]), str(c[1])) for c in res.description}
    if dict(df.dtypes) != want_types:
        return f"types {dict(df.dtypes)} against {want_types}"
    want = _rows(cols, res.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{str(g)[:600]} against {str(w)[:600]}"
    return None
