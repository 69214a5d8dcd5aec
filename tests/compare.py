"""Runs a registered query and its SQL on the same tables and compares all rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    got = _bag(df.columns, df.collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    want = _bag(names, result.fetchall())
    if got == want:
        return []
    only_got, only_want = got - want, want - got
    return [
        f"columns {sorted(names)}",
        f"rows {sum(got.values())} vs {sum(want.values())}; differing {sum(only_got.values())}/{sum(only_want.values())}",
        *[f"spark {r}" for r in sorted(only_got)[:3]],
        *[f"sql   {r}" for r in sorted(only_want)[:3]],
    ]
