"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want_columns, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    spark_kinds = dict(df.dtypes)
    families = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}
    for name, kind in spark_kinds.items():
        if families.get(kind, kind).upper() not in kinds[name].upper() and kinds[name].upper() not in ("STRING", "BOOL", "NUMBER"):
            return f"type of {name}: {kind} != {kinds[name]}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} rows differ, first: {wrong[0][0]} != {wrong[0][1]}"
    return None
