"""Small helpers shared by the tests."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb


def norm(v):
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def bag(rows, cols, want=None):
    want = list(want or sorted(cols))
    idx = [cols.index(c) for c in want]
    return sorted((tuple(norm(r[i]) for i in idx) for r in rows), key=_key)


def spark_bag(df, want=None):
    return bag([tuple(r) for r in df.collect()], df.columns, want)


def duck_bag(con, sql, want=None):
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return bag(res.fetchall(), cols, want)


def duck_with(frames: dict):
    con = duckdb.connect()
    for name, pdf in frames.items():
        con.register(name, pdf)
    return con


def with_sql(ctes, final):
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + final
