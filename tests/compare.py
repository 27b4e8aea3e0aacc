"""Run registered queries beside their SQL and compare them value by value."""

from __future__ import annotations

import math
import os

TABLES = "region nation customer supplier part orders lineitem events".split()


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf, t)}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "-"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(round(float(value), 9) + 0.0)
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, sf: str, query, sql: str) -> str | None:
    df = query(spark, sf)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = normal([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if got[1] != want[1]:
        a, b = set(got[1]), set(want[1])
        return f"rows {len(got[1])} / {len(want[1])}; only here {list(a - b)[:2]}; only there {list(b - a)[:2]}"
    return None
