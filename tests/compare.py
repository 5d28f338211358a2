"""Run a query in Spark and its counterpart in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    return round(value, 6) if isinstance(value, float) else value


def difference(spark, con, build, sql: str | None, sf_dir: str):
    """(rows, None) when equal, else (rows, description)."""
    df = build(spark, sf_dir)
    names = sorted(df.columns)
    got = Counter(tuple(_cell(r[n]) for n in names) for r in df.collect())
    rows = sum(got.values())
    if sql is None:
        return rows, None
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    if sorted(cols) != names:
        return rows, f"columns {names} vs {sorted(cols)}"
    order = [cols.index(n) for n in names]
    want = Counter(tuple(_cell(r[i]) for i in order) for r in cur.fetchall())
    if got != want:
        extra, missing = got - want, want - got
        return rows, (f"{names}: {rows} vs {sum(want.values())} rows; only Spark "
                      f"{list(extra.items())[:2]}; only DuckDB {list(missing.items())[:2]}")
    kinds = {n: (type(next((k[i] for k in got if k[i] is not None), None)),
                 type(next((k[i] for k in want if k[i] is not None), None)))
             for i, n in enumerate(names)}
    bad = {n: t for n, t in kinds.items() if t[0] is not t[1]}
    return rows, (f"types differ: {bad}" if bad else None)
