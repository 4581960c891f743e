"""Compare a Spark result with the oracle's, ignoring row order."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

from causalgrid.workload.fixtures import TABLES


def oracle(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item"):
        return v.item()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(_plain(r[n]) for n in names) for r in df.collect()]


def oracle_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], [tuple(_plain(r[i]) for i in order) for r in cur.fetchall()]


def _key(row):
    return tuple((v is None, str(type(v).__name__ not in ("int", "float", "bool")), v if v is not None else 0) if not isinstance(v, tuple) else (False, "t", str(v)) for v in row)


def differences(got, want, limit=5):
    (gn, g), (wn, w) = got, want
    if gn != wn:
        return [f"columns {gn} != {wn}"]
    out = []
    if len(g) != len(w):
        out.append(f"rows {len(g)} != {len(w)}")
    from collections import Counter

    a, b = Counter(g), Counter(w)
    if a != b:
        only_a, only_b = list((a - b).elements()), list((b - a).elements())
        out.append(f"{len(only_a)} rows only in spark, {len(only_b)} only in oracle")
        for side, rows in (("spark ", only_a), ("oracle", only_b)):
            for r in sorted(rows, key=str)[:limit]:
                out.append(f"{side} {dict(zip(gn, r))}")
    else:
        for n, i in zip(gn, range(len(gn))):
            ta = {type(r[i]).__name__ for r in g if r[i] is not None}
            tb = {type(r[i]).__name__ for r in w if r[i] is not None}
            if ta != tb:
                out.append(f"types of {n}: {ta} != {tb}")
    return out
